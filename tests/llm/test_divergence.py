"""Source divergence against brute force."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import ODD, sentence
from pyspark.sql import functions as F

from featherstack.llm import divergence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    docs = [(la or "", so or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))) for t, la, so in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        held, counts, all_n = Counter(), defaultdict(Counter), Counter()
        for la, so, w in docs:
            if la == lang:
                held.update(set(w))
                counts[so].update(w)
                all_n.update(w)
        kept = sorted(t for t, c in held.items() if c >= min_docs)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        q = shares(all_n)
        p = {s: shares(c) for s, c in counts.items()}
        for s in counts:
            values = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o != s]
            above = [(p[s][t] - q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", values, len(values)), ("term", above, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, r) for r, (v, item) in enumerate(items[:most], 1)}
    return out


@pytest.mark.parametrize(("group_block", "term_block"), [(64, 8192), (2, 3)])
def test_divergence_against_brute_force(spark, rng, group_block, term_block):
    rows = [(t, rng.choice(["de", None]), rng.choice(["a", "b", "c"])) for t in ODD]
    for _ in range(150):
        lang = rng.choice(["en", "de", "é"])
        rows.append((" ".join(sentence(rng, rng.randrange(1, 30), 60)).replace("w", rng.choice(["W", "w", "ü"])).translate(str.maketrans("0123456789", "abcdefghij")),
                     lang, rng.choice(["a", "A", "b", "ß", "", None]) if rng.random() < 0.6 else "hot"))
    rows += [("", "en", "no terms"), ("once only", "xx", "alone"), ("other words", "xx", "beside")] + rows[:5]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"value": F.lit("clash"), "rank": F.lit(1), "term": F.lit("x"), "__text": F.lit("y")})
    got = [tuple(r) for r in divergence.audit(docs, min_docs=4, top_terms=6, group_block=group_block, term_block=term_block).select(
        "lang", "source", "part", "item", "value", "rank").collect()]
    want = brute(rows, 4, 6)
    assert len(got) == len(want) and set(got) == want
    assert {p for _, _, p, *_ in want} == {"pair", "term"}
    assert divergence.audit(docs.limit(0)).count() == 0


def test_hot_source_is_one_row_a_term(spark):
    docs = spark.createDataFrame([("a b c a", "en", "hot")] * 3000, "text string, lang string, source string")
    found = divergence.count_terms(docs).orderBy("term").collect()
    assert [(r["term"], r["n"], r["docs"]) for r in found] == [(None, 0, 0), ("a", 6000, 3000), ("b", 3000, 3000), ("c", 3000, 3000)]


def test_shares_stay_exact_beyond_64_bits():
    counts = np.array([0, 3, 2 * 10**12], np.int64)
    below = np.full(3, 3 * 10**13, np.int64)
    assert divergence.shares(counts, below).tolist() == [1 + 10**9 * (c + 5) // (3 * 10**13) for c in counts.tolist()]


def test_cells_meet_each_pair_of_groups_once(spark, rng):
    docs = spark.createDataFrame([(f"t{'abcdefgh'[i % 8]} u", "en", f"s{i % 7}") for i in range(70)], "text string, lang string, source string")
    got = divergence.audit(docs, min_docs=1, group_block=2, term_block=2).where("part = 'pair'").collect()
    assert {(r["source"], r["item"]) for r in got} == set(itertools.permutations([f"s{i}" for i in range(7)], 2))
    assert len(got) == 42
