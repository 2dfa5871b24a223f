"""The n-gram model against a plain version of the same formulas."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import ODD, sentence
from pyspark.sql import functions as F

from featherstack.llm import kneserney, tokens

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [*re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]


class Plain:
    def __init__(self, texts, order):
        self.order, self.counts = order, {n: Counter() for n in range(1, order + 1)}
        self.uni = Counter(w for t in texts for w in words(t))
        for t in texts:
            w = ["\t", *words(t)]
            for i in range(1, len(w)):
                n = min(order, i + 1)
                self.counts[n][tuple(w[i - n + 1:i + 1])] += 1
        for n in range(order - 1, 0, -1):
            for g in self.counts[n + 1]:
                self.counts[n][g[1:]] += 1
        self.after = {n: defaultdict(list) for n in self.counts}
        self.d = {}
        for n, c in self.counts.items():
            for g, k in c.items():
                self.after[n][g[:-1]].append(k)
            self.d[n] = kneserney.discounts(*[sum(k == x for k in c.values()) for x in (1, 2, 3, 4)])

    def p(self, context, w):
        p = 1 / (len(self.uni) + 1)
        for n in range(1, min(self.order, len(context) + 1) + 1):
            h = tuple(context[len(context) - n + 1:])
            if self.after[n][h]:
                d = (0, *self.d[n])
                k, total = self.counts[n][(*h, w)], sum(self.after[n][h])
                p = max(k - d[min(k, 3)], 0) / total + sum(d[min(x, 3)] for x in self.after[n][h]) / total * p
        return p

    def score(self, text):
        w = ["\t", *words(text)]
        return sum(math.log10(self.p(w[max(0, i - self.order + 1):i], w[i])) for i in range(1, len(w)))


def corpus(rng):
    zipf = [f"W{i}" if i % 5 == 0 else f"é{i}" for i in range(40) for _ in range(40 // (i + 1))]
    texts = [" ".join(rng.choice(zipf) for _ in range(rng.randrange(1, 40))) for _ in range(120)]
    return texts + [t for t in ODD if t is None or len(t) < 1000] + texts[:3]


@pytest.mark.parametrize(("order", "entries"), [(2, 4_000_000), (2, 200), (3, 300), (1, 200)])  # few entries: many shards, split contexts
def test_scores_equal_the_plain_version(make_docs, rng, order, entries):
    texts = corpus(rng)
    held = [" ".join(sentence(rng, 20)), "W0 é1 unknown W0", "", None, "é1 " * 50]
    plain = Plain(texts, order)
    model = kneserney.train(make_docs(texts), order=order, entries=entries)
    assert (model.tokens, model.words) == (sum(plain.uni.values()), len(plain.uni))
    rows = make_docs(texts + held).withColumns({"score": F.lit("clash"), "__text": F.lit("clash"), "n_known": F.lit("clash")})
    got = kneserney.score(rows, model).orderBy("doc_id").collect()
    for r, t in zip(got, texts + held, strict=True):
        assert r["n_tokens"] == len(words(t)) and r["n_known"] == sum(w in plain.uni for w in words(t)) and r["train_tokens"] == model.tokens
        assert r["base_score"] == pytest.approx(sum(math.log10((plain.uni[w] + 1) / (model.tokens + model.words + 1)) for w in words(t)), rel=1e-12)
        assert r["score"] == pytest.approx(plain.score(t), rel=1e-9) and r["__text"] == "clash"


def test_probabilities_add_up_to_one(rng):
    plain = Plain(corpus(rng), 3)
    for context in (["\t"], ["\t", "w0"], ["w0", "é1"], ["é1", "never"], ["never", "w0"]):
        total = sum(plain.p(context, w) for w in plain.uni) + plain.p(context, "an unknown word")
        assert total == pytest.approx(1, abs=1e-9)


def test_no_training_text(make_docs):
    model = kneserney.train(make_docs([]))
    r = kneserney.score(make_docs(["a b"]), model).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
    assert kneserney.score(make_docs([]), model).count() == 0


@pytest.mark.parametrize("size", [1 << 20, 64, 7])
def test_tokens_of_slices(monkeypatch, size):
    monkeypatch.setattr(tokens, "SLICE", size)
    texts = [(t or "").encode() for t in ODD if t is None or len(t) < 1000] + [b" " * 300 + b"A bc  " * 40 + b"x" * 200 + b" y", b"A bc", b"ab", b"ba"]
    known, ids = {}, []
    for part in tokens.slices(texts):
        ids += zip(part.doc.tolist(), part.hashes.tolist(), strict=True)
    want = [(i, w) for i, t in enumerate(texts) for w in [*t.translate(tokens.SPACED).split(), b"\n"]]
    assert [d for d, _ in ids] == [d for d, _ in want]
    for (_, h), (_, w) in zip(ids, want, strict=True):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_hashes_of_many_words_differ():
    r = np.random.default_rng(0)
    text = b" ".join({bytes(r.integers(97, 123, int(r.integers(1, 9)), dtype=np.uint8)) for _ in range(200_000)})
    found = np.concatenate([p.hashes for p in tokens.slices([text])])
    assert len(np.unique(found)) == len(text.split()) + 1


def test_texts_go_to_workers_once_and_some_megabytes_at_a_time(spark, make_docs, monkeypatch):
    texts = [f"w{i % 7} w{i % 5} common" for i in range(300)]
    model = kneserney.train(make_docs(texts))
    whole = kneserney.score(make_docs(texts), model)
    alone = kneserney.score(make_docs(texts), model, keep_text=False)
    assert "text" in whole.columns and "text" not in alone.columns
    assert whole.drop("text").orderBy("doc_id").collect() == alone.orderBy("doc_id").collect()
    monkeypatch.setattr(kneserney, "BATCH_BYTES", 1000)
    batch = pa.RecordBatch.from_pydict({"text": [b"x" * 300] * 20})
    assert max(b.num_rows for b in kneserney._some(iter([batch]))) <= 3 and sum(b.num_rows for b in kneserney._some(iter([batch]))) == 20
