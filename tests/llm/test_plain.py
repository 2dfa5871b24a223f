"""Decoder, vote and subword score against plain versions, and cases that several operators share."""

import math
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from llm_cases import ODD, sentence
from pyspark.sql import functions as F

from featherstack.llm import bpe, decontaminate, embeddings, language, lines, minhash, passages, quality, toxicity
from featherstack.llm.queries import QUERIES


def sample(rng, n=60):
    return [" ".join(sentence(rng, rng.randrange(1, 30), 80)).replace("w", rng.choice(["w", "Wé", "ing "])).encode() for _ in range(n)]


def test_decoder_weighs_the_loss_of_every_bit(rng):
    texts = sample(rng)
    model = language.fit([["en", "de", "fr", "es", "it"][i % 5] for i in range(len(texts))], language.features(texts))
    got, score, unsure = model.predict([*texts, b"", None, b"12 34"])
    x = language.features(texts)
    for i in range(len(texts)):
        loss = []
        for code, trust in zip(model.codes, model.trust, strict=True):
            out = [float(x[i] @ model.weights[:, b] + model.bias[b]) for b in range(len(code))]
            loss.append(sum(t * math.log1p(math.exp(-f * c)) if -f * c < 30 else t * -f * c for f, c, t in zip(out, code, trust, strict=True)))
        share = [math.exp(min(loss) - v) for v in loss]
        share = [s / sum(share) for s in share]
        best = max(range(5), key=lambda k: share[k])
        assert got[i] == model.languages[best] and score[i] == pytest.approx(share[best], rel=1e-4)
        assert unsure[i] == (share[best] - sorted(share)[-2] < model.margin) or abs(share[best] - sorted(share)[-2] - model.margin) < 1e-4
    assert got[-3:] == ["und"] * 3 and score[-3:].tolist() == [0, 0, 0]


def test_votes_are_of_the_nearest_by_exact_cosine(rng):
    texts = sample(rng, 120)
    model = quality.fit([i % 2 for i in range(100)], quality.features(texts[:100]), 0.5)
    got = model.score(texts[100:])
    for text, score in zip(texts[100:], got, strict=True):
        x = (quality.features([text])[0] * model.idf) @ model.space
        cosine = [max(0.0, float(x @ v) / float(np.linalg.norm(x))) for v in model.vectors]
        near = sorted(range(100), key=lambda k: -cosine[k])[:quality.NEIGHBOURS]
        vote = [cosine[k] ** quality.SHARPNESS for k in near]
        assert score == pytest.approx(sum(v * model.labels[k] for v, k in zip(vote, near, strict=True)) / sum(vote), abs=1e-4)


def test_subword_score_is_the_softmax_of_the_average(rng):
    texts = sample(rng)
    model = toxicity.fit([i % 2 for i in range(len(texts))], toxicity.features(texts), 0.5)
    got = toxicity.Scorer(model).score([*texts, b"", None])
    for text, score in zip(texts, got, strict=False):
        total, size = np.zeros(toxicity.DIM), 0.0
        for word, n in Counter(text.translate(toxicity._LETTERS).split()).items():
            _, buckets = toxicity._bags([word])
            total += n ** toxicity.DAMP * model.vectors[buckets].sum(axis=0)
            size += n ** toxicity.DAMP * len(buckets)
        z = total / (size + toxicity.SMOOTH) @ model.softmax + model.bias
        e = np.exp(z - z.max())
        assert score == pytest.approx(float(e[1] / e.sum()), rel=1e-4)
    assert got[-2:].tolist() == [0.5, 0.5]


def clashing(docs):
    return docs.withColumns({c: F.lit("kept") for c in ("__text", "__dropped", "h", "id", "words", "keys", "n", "__TEXT_", "label", "at")})


@pytest.mark.parametrize("name", ["bpe", "lines", "language", "quality", "toxicity", "decontaminate", "minhash", "passages"])
def test_clashing_columns_repeated_and_missing_ids(make_docs, spark, rng, name):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    text = " ".join(sentence(rng, 80))
    docs = make_docs([*(t for t in ODD if t is None or len(t) < 1000), text, text, text])
    docs = clashing(docs.withColumn("doc_id", F.when(F.col("doc_id") % 5 == 1, F.lit(None)).otherwise(F.col("doc_id") % 7)))
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 1), (2, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([("a", text), ("a", text), (None, text), ("b", None)], "item_id string, text string")
    run = {"bpe": lambda d: bpe.encode(d, path, public_tokenizers.PATTERN), "lines": lambda d: lines.drop_common_lines(d, min_docs=3),
           "language": lambda d: language.predict(d, language.train(docs, docs)),
           "quality": lambda d: quality.predict(d, quality.train(docs, labels)), "toxicity": lambda d: toxicity.predict(d, toxicity.train(docs, labels)),
           "decontaminate": lambda d: decontaminate.find_contamination(d, items), "minhash": lambda d: minhash.near_duplicates(d, shingle=3),
           "passages": lambda d: passages.repeated_passages(d)}[name]
    rows = run(docs).collect()
    if name != "passages":
        assert len(rows) == docs.count()
    if "__text" in rows[0].asDict():
        assert {r["__text"] for r in rows} == {"kept"}
    assert run(docs.limit(0)).count() == 0


def test_embeddings_of_any_size_and_repeated_ids(spark):
    rows = [(1, [1e200, 1e200], 0), (2, [1e200, 1.0000001e200], 1), (3, [1e-200, 1e-200], 0), (4, [1e-200, -1e-200], 0),
            (5, [5e-324, 5e-324], 0), (6, [1.7e308, 1.7e308], 0), (1, [1.0, 1.0], 0), (None, [1.0, 1.0], 0)]
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in embeddings.find_links(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), cosine=0.9).collect() if r["id"] is not None}
    assert {got[i][1] for i in (1, 2, 3, 5, 6)} == {1} and got[4] == (0, 4)


def test_held_out_of_a_missing_id(spark, tmp_path):
    docs = spark.createDataFrame([(i if i else None, f"word{i} and some more words here", ["en", "de"][i % 2], "s", 9) for i in range(40)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op2_language_id", "op4_quality_classifier", "op9_toxicity", "op13_lm_score"):
        rows = QUERIES[name](spark, str(tmp_path)).collect()
        assert len(rows) == 40 and all(r["held_out"] is not None for r in rows), name
