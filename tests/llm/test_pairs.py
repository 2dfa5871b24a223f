"""Near-duplicates, embeddings, components and passages against brute force."""

import itertools

import numpy as np
import pytest
from llm_cases import ODD, sentence
from pyspark.sql import functions as F

from featherstack.llm import embeddings, minhash, passages
from featherstack.llm.components import connected_components


def roots(ids, links):
    part = {i: i for i in ids}
    def find(x):  # noqa: E306
        while part[x] != x:
            x = part[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_against_union_find(spark, rng):
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(2000, i) for i in range(2001, 2200)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    ids = {x for a, b in edges if a != b for x in (a, b)}
    assert got == roots(ids, [e for e in edges if e[0] != e[1]])
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def grams(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_texts(rng):
    texts = list(ODD)
    for _ in range(12):
        base = sentence(rng, rng.randrange(60, 300))
        for _ in range(rng.randrange(2, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 8)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
            texts.append(" ".join(w))
        texts.append(" ".join(base[:len(base) * 3 // 4]))
    return texts + [" ".join(sentence(rng, 50)) for _ in range(30)]


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_minhash_against_brute_force(make_docs, rng, monkeypatch, k, percent):
    monkeypatch.setattr(minhash, "CHUNK", 3)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "FAMILY_BLOCK", 4)
    texts = near_texts(rng)
    sets = [grams(t, k) for t in texts]
    links = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = roots(range(len(texts)), links)
    got = minhash.near_duplicates(make_docs(texts).withColumn("n", F.lit("clash")), shingle=k, percent=percent).collect()
    assert {r["id"]: r["component_id"] for r in got} == want
    assert {r["id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in enumerate(sets)}
    assert {r["id"] for r in got if r["kept"]} == {i for i, c in want.items() if i == c}
    assert len(links) > 50


def test_minhash_ids_that_repeat_or_are_null(spark):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (4, "q r s t u v"), (None, "a b c d e f"), (3, "A  B c D e f"), (9, None)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3, percent=85).collect()
    assert len(got) == 6
    assert {(r["id"], r["component_id"]) for r in got} == {(1, 1), (4, 1), (3, 1), (None, None), (9, 9)}
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    r = np.random.default_rng(3)
    rows = []
    for c in range(25):
        centre = r.normal(size=16)
        rows += [(centre + r.normal(size=16) * s).tolist() for s in r.uniform(0, 0.5, 12)] + [centre.tolist()] * 2
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [1e308] * 16, rows[0][:15], [None] + [1.0] * 15, [1.0]]
    data = [(i, v, i % 3) for i, v in enumerate(rows)] + [(None, rows[0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, n_links int")
    got = {x["id"]: x for x in embeddings.find_links(df, recall=0.99999).collect()}
    usable = [i for i, v in enumerate(rows) if v and None not in v and np.isfinite(np.linalg.norm(v)) and np.linalg.norm(v) > 0]
    links = [(a, b) for a, b in itertools.combinations(usable, 2) if len(rows[a]) == len(rows[b])
             and np.dot(rows[a], rows[b]) / np.linalg.norm(rows[a]) / np.linalg.norm(rows[b]) >= 0.9]
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    want = roots(range(len(rows)), links)
    assert len(got) == len(rows) + 1 and got[None]["n_links"] == 0
    assert all(got[i]["n_links"] == count[i] and got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i) for i in range(len(rows)))
    assert embeddings.find_links(df.limit(0)).count() == 0


def test_embedding_recall_at_the_threshold(spark):
    """Pairs of a cosine just above 0.9, at the registered recall parameter."""
    r = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        a, b = r.normal(size=(2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.901 * a + np.sqrt(1 - 0.901**2) * b).tolist())]
    got = embeddings.find_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.where("n_links > 0").count() / 3000 >= 0.97


def passage_docs(rng):
    shared = sentence(rng, 70, 10**6)
    fuzzy = sentence(rng, 90, 10**6)
    texts = []
    for i in range(40):
        w = sentence(rng, 120, 10**6)
        at = rng.randrange(100)
        if i % 4 == 0:
            w[at:at] = shared
        if i % 4 == 1:
            f = list(fuzzy)
            for j in range(5 + i % 7, 90, 14):
                f[j] = f"z{rng.randrange(10**6)}"
            if i % 8 == 1:
                del f[40]
            w[at:at] = f
        if i % 4 == 2:
            w[at:at] = shared[:20]  # too short to count
        texts.append(" ".join(w))
    return ODD[:5] + ODD[6:] + texts, shared, fuzzy


def test_passages_planted(make_docs, rng):
    texts, shared, fuzzy = passage_docs(rng)
    first = len(texts) - 40
    got = {r["id"]: r for r in passages.repeated_passages(make_docs(texts).withColumn("start", F.lit(0))).collect()}
    assert set(got) == {first + i for i in range(40) if i % 4 in (0, 1)}
    for i, r in got.items():
        kind = shared if (i - first) % 4 == 0 else fuzzy
        low = first if kind is shared else first + 1
        assert r["component_id"] == low
        assert abs(r["n_repeated"] - len(kind)) <= 4
        assert r["n_dropped"] == (0 if i == low else r["n_repeated"])
        w = texts[i].split()
        covered = {x for s in r["spans"] for x in w[s["start"]:s["end"]]}
        assert len(covered & set(kind)) >= len(set(kind) & set(w)) - 2


def edited(rng, words, n):
    """The words with ``n`` edits inside, of which two in three put another word in."""
    out = list(words)
    for j in sorted(rng.sample(range(1, len(words) - 1), n), reverse=True):
        kind = rng.randrange(6)
        out[j:j + 1] = [] if kind == 0 else [out[j], f"z{rng.randrange(10**6)}"] if kind == 1 else [f"z{rng.randrange(10**6)}"]
    return out


def planted_pairs(rng, n, length, identity, shadows=False):
    """Texts of which the last 2 n hold n passages, each whole and then edited; with
    ``shadows`` every six words of a passage occur in an unrelated smaller id too."""
    whole = [sentence(rng, length, 10**6) for _ in range(n)]
    texts = [" ".join(w for p in whole for w in p[i:i + 6] + sentence(rng, 10, 10**6)) for i in range(length - 5)] if shadows else []
    other = [edited(rng, p, round((1 - identity) * length)) for p in whole]
    return texts + [" ".join(sentence(rng, 60, 10**6) + p + sentence(rng, 60, 10**6)) for p in whole + other]


def pair_recall(make_docs, texts, n):
    first = len(texts) - 2 * n
    part = {r["id"]: r["component_id"] for r in passages.repeated_passages(make_docs(texts)).collect()}
    assert not [i for i in part if i < first]
    return np.mean([part.get(first + i) == part.get(first + n + i) == first + i for i in range(n)])


@pytest.mark.parametrize(("length", "identity", "least"), [(60, 0.9, 0.95), (75, 0.85, 0.95), (75, 0.8, 0.95), (100, 0.8, 0.98)])
def test_edited_passages_down_to_the_identity(make_docs, rng, length, identity, least):
    assert pair_recall(make_docs, planted_pairs(rng, 200, length, identity), 200) >= least


@pytest.mark.parametrize(("length", "identity", "least"), [(60, 1, 1), (60, 0.9, 0.95), (75, 0.85, 0.95)])
def test_passages_whose_seeds_have_unrelated_smaller_holders(make_docs, rng, length, identity, least):
    assert pair_recall(make_docs, planted_pairs(rng, 200, length, identity, shadows=True), 200) >= least


def test_holders_of_a_long_run_meet_across_blocks(make_docs, rng, monkeypatch):
    monkeypatch.setattr(passages, "RUN_ROWS", 16)
    texts = planted_pairs(rng, 40, 60, 1, shadows=True)
    assert pair_recall(make_docs, texts, 40) == 1


def test_passages_of_one_repeated_word_and_empty(make_docs):
    texts = [" ".join(["of"] * 300), "start " + " ".join(["of"] * 200), "unique words only here"]
    got = {r["id"]: r["n_repeated"] for r in passages.repeated_passages(make_docs(texts)).collect()}
    assert set(got) == {0, 1} and got[1] >= 190 and got[0] >= 50  # the first holder shows the run once
    assert passages.repeated_passages(make_docs([])).count() == 0


def test_chain_is_the_best_collinear_sequence(rng):
    for _ in range(60):
        n = rng.randrange(2, 9)
        x = np.array(sorted(rng.sample(range(60), n)))
        y = np.array([rng.randrange(60) for _ in range(n)])
        def value(c):  # noqa: E306
            steps = zip(c, c[1:], strict=False)
            return passages.K * len(c) - passages.GAP * sum(x[b] - x[a] + y[b] - y[a] for a, b in steps)
        fits = [c for size in range(1, n + 1) for c in itertools.combinations(range(n), size)
                if all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:], strict=False))]
        got = passages._chains(x.tolist(), y.tolist())
        assert value(got[0].tolist()) == pytest.approx(max(map(value, fits)))


def test_edits_against_full_table(rng):
    for _ in range(300):
        a, b = (np.array([rng.randrange(4) for _ in range(rng.randrange(9))], dtype=int) for _ in range(2))
        d = np.zeros((len(a) + 1, len(b) + 1), int)
        d[:, 0], d[0] = range(len(a) + 1), range(len(b) + 1)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            d[i + 1, j + 1] = min(d[i, j + 1] + 1, d[i + 1, j] + 1, d[i, j] + (a[i] != b[j]))
        assert passages.edits(a, b) == d[-1, -1]


def test_chains_left_out_have_no_passage(rng):
    """The shared pairs of neighbouring words of an edited passage are never fewer than asked for."""
    for _ in range(2000):
        a = [rng.randrange(10**6) for _ in range(rng.randrange(50, 90))]
        b, errors = list(a), 0
        while True:
            kind, at = rng.randrange(3), rng.randrange(len(b))
            longest = max(len(a), len(b) + (kind == 1))
            if errors + 1 > 0.2 * longest or len(b) - (kind == 2) < 50:
                break
            b[at:at + (kind != 1)] = [rng.randrange(10**6)] * (kind != 2)
            errors += 1
        pairs = set(zip(b, b[1:], strict=False))
        assert sum(p in pairs for p in zip(a, a[1:], strict=False)) >= passages.shared_pairs(50, 0.8)
    assert passages.shared_pairs(50, 0.8) == 29
