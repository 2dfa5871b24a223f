"""Line dedup, decontamination and BPE against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import ODD, sentence
from pyspark.sql import functions as F

from featherstack.llm import bpe, decontaminate, lines
from featherstack.llm.fmindex import FMIndex, suffix_order
from featherstack.llm.mphf import PerfectHash

WHITE = " \t\n\x0b\x0c\r"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(texts, min_docs, min_chars=1):
    key = lambda x: x.strip(WHITE).translate(ASCII_LOWER)
    count = defaultdict(set)
    for i, t in enumerate(texts):
        for x in (t or "").split("\n"):
            count[key(x)].add(i)
    common = {k for k, s in count.items() if len(k) >= min_chars and len(s) >= min_docs}
    out = []
    for t in texts:
        part = (t or "").split("\n")
        kept = [x for x in part if key(x) not in common]
        out.append((len(part), len(part) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 30, 1000])
def test_lines_against_brute_force(make_docs, rng, shard_bytes):
    common = [" ".join(sentence(rng, 4)) for _ in range(20)]
    texts = ODD + ["\n".join(rng.choice([f"  {rng.choice(common).upper()}\r", rng.choice(common), " ".join(sentence(rng, 5)), ""])
                             for _ in range(rng.randrange(1, 9))) for _ in range(120)]
    docs = make_docs(texts).withColumns({"n_lines": F.lit("clash"), "__text": F.lit("clash"), "__dropped": F.lit("clash"), "shard": F.lit(1)})
    got = lines.drop_common_lines(docs, min_docs=10, shard_bytes=shard_bytes).orderBy("doc_id").collect()
    want = brute_lines(texts, 10)
    assert any(w[1] for w in want)
    assert [(r["n_lines"], r["n_dropped"], r["text"] or "") for r in got] == want
    assert lines.drop_common_lines(docs.limit(0)).count() == 0


def test_rows_of_one_id_are_documents(spark):
    docs = spark.createDataFrame([(1, "same\nown")] * 10 + [(None, "same\nother"), (2, "Same \n")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"], r["n_dropped"]) for r in lines.drop_common_lines(docs, min_docs=10).collect()), key=str)
    assert got == sorted([(1, "", 2)] * 10 + [(None, "other", 1), (2, "", 1)], key=str)
    got = lines.drop_common_lines(docs, min_docs=300).collect()  # counts of two bytes and more
    assert all(r["n_dropped"] == 0 for r in got)


def test_lines_min_chars_counts_code_points(make_docs):
    texts = ["éé\nlong enough"] * 12
    got = lines.drop_common_lines(make_docs(texts), min_docs=10, min_chars=3).first()
    assert (got["text"], got["n_dropped"]) == ("éé", 1)


def test_perfect_hash_is_minimal_and_keeps_strangers_apart():
    r = np.random.default_rng(1)
    lo, hi = r.integers(0, 2**63, (2, 20_000), dtype=np.uint64)
    table = PerfectHash.build(lo, hi)
    assert sorted(table.index(lo, hi).tolist()) == list(range(20_000))
    prints = np.empty(20_000, np.uint64)
    prints[table.index(lo, hi)] = hi
    at = table.index(hi, lo)
    assert not (prints[at[at >= 0]] == lo[at >= 0]).any()


def test_suffix_order_and_search_against_brute_force():
    r = np.random.default_rng(2)
    text = np.concatenate([r.integers(1, 4, n).tolist() + [0] for n in (1, 30, 30, 7, 200)] * 2).astype(np.int64)
    ends = np.flatnonzero(text == 0)
    def suffix(i):  # noqa: E306
        end = ends[np.searchsorted(ends, i)]
        return [*(text[i:end] + len(text)).tolist(), int(np.searchsorted(ends, i))]
    assert suffix_order(text).tolist() == sorted(range(len(text)), key=suffix)
    index = FMIndex(text, 4)
    for size in (1, 2, 5, 9):
        patterns = np.array([text[i:i + size] for i in range(0, len(text) - size, 3) if (text[i:i + size] > 0).all()])
        low, high = index.search(patterns, np.full(len(patterns), size))
        for p, a, b in zip(patterns, low, high, strict=True):
            want = [i for i in range(len(text) - size + 1) if (text[i:i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def brute_hits(text, items, window):
    find = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall
    w = find((text or "").translate(ASCII_LOWER))
    hit, ids = set(), set()
    for item, t in items:
        v = find((t or "").translate(ASCII_LOWER))
        for p in {tuple(v[i:i + window]) for i in range(max(1, len(v) - window + 1))} if v else ():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    ids.add(str(item))
    return len(w), len(hit), sorted(ids)


def brute_cut(text, items, window):
    """The text without the words of the items' windows and what stands between them."""
    find = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    phrases = set()
    for _, t in items:
        v = find.findall((t or "").translate(ASCII_LOWER))
        phrases |= {tuple(v[i:i + window]) for i in range(max(1, len(v) - window + 1))} if v else set()
    at = [m.span() for m in find.finditer(text.translate(ASCII_LOWER))]
    w = [text[a:b].translate(ASCII_LOWER) for a, b in at]
    hit = set()
    for size in {len(p) for p in phrases}:
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in phrases:
                hit.update(range(i, i + size))
    out, last = [], 0
    for i in sorted(hit):
        begin = at[i - 1][1] if i - 1 in hit else at[i][0]
        out.append(text[last:begin])
        last = at[i][1]
    return "".join([*out, text[last:]])


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_against_brute_force(spark, make_docs, rng, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 300)
    items = [(i, " ".join(sentence(rng, n, 60))) for i, n in enumerate([10, 11, 25, 3, 1, 9, 40])] + [(20, None), (21, "..."), (7, "One, TWO")]
    items.append((22, items[2][1]))
    texts = ODD[:5] + ODD[6:]
    for _ in range(60):
        w = sentence(rng, rng.randrange(5, 40), 60)
        if rng.random() < 0.6:
            v = rng.choice(items)[1] or ""
            w[3:3] = v.upper().replace(" ", ", ").split(" ")[rng.randrange(3):]
        texts.append(" ".join(w))
    docs = make_docs(texts).withColumn("items", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, window=10, block_bytes=block_bytes)
    rows = got.orderBy("doc_id").collect()
    want = [brute_hits(t, items, 10) for t in texts]
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in rows] == want
    cut = {r["doc_id"]: r["text"] for r in decontaminate.cut_spans(got).collect()}
    for r, t in zip(rows, texts, strict=True):
        assert len(decontaminate.words((cut[r["doc_id"]] or "").encode())) == r["n_words"] - r["n_hit"]
        assert r["n_hit"] or cut[r["doc_id"]] == t
    assert decontaminate.find_contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0


def test_bpe_against_tiktoken(make_docs, rng):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = dict(bpe.read_ranks(path))
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = ["the", "ing", " ", "\n", "é", "日本", "😀", "'s", "12", ".", "zq", "x" * 40, "<|endoftext|>", " ", "ñandú"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(150)] + ["qzx" * 3000]
    coded = bpe.encode(make_docs(texts).withColumn("token_ids", F.lit(1)), path, public_tokenizers.PATTERN)
    rows = bpe.decode(coded, path).orderBy("doc_id").collect()
    both = bpe.encode(make_docs(texts), path, public_tokenizers.PATTERN, decoded=True).orderBy("doc_id").collect()
    assert [(r["token_ids"], r["decoded"]) for r in both] == [(r["token_ids"], r["decoded"]) for r in rows]
    for r, t in zip(rows, texts, strict=True):
        want = np.array(encoder.encode_ordinary(t or ""), dtype="<u4")
        assert bytes(r["token_ids"]) == want.tobytes() and r["n_tokens"] == len(want)
        assert hashlib.sha256(r["decoded"]).digest() == hashlib.sha256((t or "").encode()).digest()
    assert bpe.encode(make_docs([]), path, public_tokenizers.PATTERN).count() == 0
