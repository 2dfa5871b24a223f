"""Classifiers on held-out rows, the URL filter and the pipeline."""

import os
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import ODD, sentence
from pyspark.sql import functions as F

from featherstack.llm import bpe, decontaminate, language, lines, quality, toxicity, urls
from featherstack.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def crc(i, mod):
    return zlib.crc32(str(i).encode()) % mod


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


@pytest.mark.parametrize(("query", "label", "threshold", "least"), [
    ("op4_quality_classifier", "quality", 0.3, 0.95), ("op9_toxicity", "toxic", 0.5, 0.9)])
def test_labelled_classifiers(spark, labels, query, label, threshold, least):
    rows = QUERIES[query](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= threshold) for r in rows)
    judged = [r["predicted"] == labels[r["doc_id"]][label] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean(judged) >= least


def test_language_of_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op2_language_id"](spark, SF).collect()
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]) >= 0.98


def test_codewords_are_far_apart():
    for n in (1, 2, 4, 5, 17):
        codes = language.codewords(n)
        far = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
        assert len(codes) == n and len(set(far)) <= 1 and all(f >= 4 for f in far)


def test_unseen_misspelling_shares_subwords(make_docs, spark):
    rng = __import__("random").Random(3)
    texts = [" ".join([*sentence(rng, 30), *(["horridly", "beastly"] if i % 2 else [])]) for i in range(400)]
    texts += ["horidly " + " ".join(sentence(rng, 12)), " ".join(sentence(rng, 12))] * 5
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    docs = make_docs(texts)
    got = [r["score"] for r in toxicity.predict(docs, toxicity.train(docs, labels)).orderBy("doc_id").collect()][400:]
    assert min(got[::2]) > max(got[1::2])


@pytest.mark.parametrize("method", [quality, toxicity])
def test_classifier_cases(make_docs, spark, method):
    label = {quality: "quality", toxicity: "toxic"}[method]
    docs = make_docs(ODD).withColumn("score", F.lit("clash"))
    empty = spark.createDataFrame([], f"doc_id long, {label} int")
    assert {r["score"] for r in method.predict(docs, method.train(docs, empty)).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1), (5, 1), (None, 0), (4, None)], f"doc_id long, {label} int")
    scores = [r["score"] for r in method.predict(docs, method.train(docs, one)).collect()]
    assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    both = spark.createDataFrame([(3, 1), (3, 1), (5, 0), (7, 0), (8, 1), (99, 1)], f"doc_id long, {label} int")
    model = method.train(docs, both)
    rows = method.predict(docs, model).orderBy("doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows) and rows[0]["score"] == pytest.approx(4 / 6)
    assert method.predict(docs.limit(0), model).count() == 0


def test_language_cases(make_docs, spark):
    docs = make_docs(ODD)
    rows = language.predict(docs, language.train(docs, docs.limit(0))).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}
    rows = language.predict(docs, language.train(docs, docs)).orderBy("doc_id").collect()
    lettered = [t is not None and any(c.isalpha() for c in t) for t in ODD]
    assert [r["lang_pred"] for r in rows] == ["en" if k else "und" for k in lettered]


def test_url_parts_and_rules(spark):
    cases = {None: ("", ""), "": ("", ""), "no-scheme/x": ("", ""), "http://A.Net": ("a.net", ""), "http://a.net/": ("a.net", "/"),
             "https://X.example.NET/en/1?q#f": ("x.example.net", "/en/1"), "x://example.net/fr/#a": ("example.net", "/fr/"),
             "http://badexample.com/de/": ("badexample.com", "/de/"), "http://w.example.com/de/1": ("w.example.com", "/de/1"),
             "a://b://c/d": ("b:", "//c/d"), "http://é.org/fr/x": ("é.org", "/fr/x"), "http://h.org?x/fr/": ("h.org", "")}
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    want = {"http://a.net/": "net/", "https://X.example.NET/en/1?q#f": "example.net/en/", "x://example.net/fr/#a": "net/",
            "http://w.example.com/de/1": "example.com/de/", "http://é.org/fr/x": "org/fr/"}
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases)], "page_id long, url string, rule string")
    got = {r["url"]: r for r in urls.judge(pages, rules).collect()}
    assert {u: (r["host"], r["path"]) for u, r in got.items()} == cases
    assert {u: r["rule"] for u, r in got.items() if r["rule"]} == want
    assert {r["verdict"] for r in got.values()} == {"allow", "block"}
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_reputation_shrinks_towards_the_domain(spark):
    rows = [(f"h{i}.good.example", 1) for i in range(30) for _ in range(20)] + [(f"h{i}.bad.example", int(j % 10 == 0)) for i in range(30) for j in range(20)]
    rows += [("new.good.example", None), ("new.bad.example", None), ("one.good.example", 0), ("one.bad.example", 1)]
    got = {r["host"]: r for r in urls.host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert got["new.good.example"]["mean"] > 0.8 > 0.3 > got["new.bad.example"]["mean"]
    assert got["one.good.example"]["mean"] > 0.7 and got["one.bad.example"]["mean"] < 0.4
    assert got["new.good.example"]["bound"] < got["h1.good.example"]["bound"]


def test_pipeline_stages_take_effect(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline as P
    from test_exact import brute_cut, brute_hits, brute_lines
    from test_pairs import grams
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    table, seen = docs, []
    for name, stage in P.STAGES:
        out = P.stage_table(stage(spark, table, SF))
        seen.append((name, table, out))
        if name != "byte_bpe":
            assert out.schema.names == docs.schema.names
        table = out
    text = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before, after = ([text(x[k]) for x in seen] for k in (1, 2))
    quality_of = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(before[0]) - set(after[0])
    assert gone and np.mean([quality_of[i] == 0 for i in gone if i in quality_of]) > 0.95
    assert np.mean([i in after[0] for i, q in quality_of.items() if q == 1]) > 0.99
    ids = sorted(before[1])
    assert [after[1][i] or "" for i in ids] == [x[2] for x in brute_lines([before[1][i] for i in ids], 10)]
    kept, sets = set(after[2]), {i: grams(t, 5) for i, t in before[2].items()}
    similar = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert not [1 for a in kept for b in kept if a < b and sets[a] and sets[b] and similar(sets[a], sets[b])]
    dropped = set(before[2]) - kept
    assert dropped and all(any(similar(sets[i], sets[j]) for j in sets if j != i) for i in dropped)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, t in before[3].items():
        n, hit, _ = brute_hits(t, items[:8], 10) if t != after[3][i] else (0, 0, [])
        assert (t == after[3][i]) or len(decontaminate.words((after[3][i] or "").encode())) <= len(decontaminate.words(t.encode())) - hit
    assert after[3] == {i: t and brute_cut(t, items, 10) for i, t in before[3].items()} != before[3]
    ranks = dict(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in seen[4][2].collect():
        t = before[4][r["doc_id"]] or ""
        assert r["text"] == t and bytes(r["token_ids"]) == np.array(encoder.encode_ordinary(t), dtype="<u4").tobytes()


def test_lines_are_counted_by_documents_not_places(make_docs):
    assert lines.drop_common_lines(make_docs(["again\nagain"] * 9), min_docs=10).where("n_dropped > 0").count() == 0
