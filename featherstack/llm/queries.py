"""The registered ``opN_*`` queries over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, divergence, embeddings, kneserney, language, lines, minhash, negatives, passages, quality, toxicity, urls
from ..catalog.common import finalize, oracle_wrap
from .common import crc_mod

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@register("op10_line_dedup", f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
line AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM doc),
keyed AS (SELECT *, translate(trim(line, {_WHITE}), '{_UPPER}', '{_LOWER}') AS key FROM line),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (SELECT key FROM common)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE key NOT IN (SELECT key FROM common)), '')) AS kept_sha256
FROM keyed GROUP BY r, doc_id""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose key is in 10 documents or more go from every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_common_lines(docs, min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@register("op7_benchmark_decontamination", f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
phrase AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(list_slice(w, i, i + 9), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT size FROM phrase),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, size WHERE len(w) >= size)),
found AS (SELECT doc_id, i, size, item_id FROM win JOIN phrase USING (size, phrase)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM found) GROUP BY doc_id),
item_list AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN item_list USING (doc_id)""")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of benchmark items in whole documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of whole documents, and the ids decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    return done.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of whole texts, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    model = language.train(docs, docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


@register("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of whole texts, learned from labels that are not held out."""
    return _labelled(spark, sf_dir, quality, 0.3)


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of whole texts, learned from labels that are not held out."""
    return _labelled(spark, sf_dir, toxicity, 0.5)


def _labelled(spark: SparkSession, sf_dir: str, method, threshold: float) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 5) == 0
    model = method.train(docs, table(spark, sf_dir, "labels").where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return method.predict(rows, model, threshold=threshold).select("doc_id", "held_out", "score", "predicted")


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _level(name: str, source: str) -> str:
    """SQL for the posterior of a level from its counts ``n``, ``k`` and prior mean ``mean``."""
    low, high = urls.RHO
    return f"""{name}_fit AS (SELECT 1.0 / least(greatest(coalesce(
  sum(CASE WHEN n > 0 THEN (k - n * mean) * (k - n * mean) / n - mean * (1 - mean) END)
    / nullif(sum(CASE WHEN n > 0 THEN mean * (1 - mean) * (n - 1) END), 0), {low}), {low}), {high}) - 1 AS strength FROM {source}),
{name} AS (SELECT *, k + mean * strength AS a, n - k + (1 - mean) * strength AS b FROM {source}, {name}_fit)"""


_SQL_RULES = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{v} {h}/{p}'"
    for v, (h, _, p) in sorted(((v, r.partition("/")) for v, r in RULES), key=lambda x: -len("".join(x[1]))))


@register("op3_url_filter", f"""
WITH page AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(html, '{urls.MARKUP}', '', 'g') AS body FROM pages),
outcome AS (SELECT host, CASE WHEN length(body) > 0 THEN CAST(
    length(regexp_replace(body, '[^\\p{{L}}\\p{{N}} \\t\\n\\r.,;:''"()-]', '', 'g')) * 100 >= length(body) * 90 AS INT) END AS good FROM page),
hosts AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k,
  array_to_string(list_slice(string_split(host, '.'), greatest(1, len(string_split(host, '.')) - 1), len(string_split(host, '.'))), '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM outcome GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
suffix_prior AS (SELECT *, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM suffixes) AS mean FROM suffixes),
{_level('suffix_post', 'suffix_prior')},
domain_prior AS (SELECT d.*, a / (a + b) AS mean FROM domains d JOIN suffix_post s USING (suffix)),
{_level('domain_post', 'domain_prior')},
host_prior AS (SELECT h.*, a / (a + b) AS mean FROM hosts h JOIN domain_post d USING (domain)),
{_level('host_post', 'host_prior')},
bound AS (SELECT host, a / (a + b) - {urls.Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM host_post),
judged AS (SELECT page_id, host, path, bound, CASE {_SQL_RULES} END AS hit FROM page JOIN bound USING (host))
SELECT page_id, host, path, split_part(hit, ' ', 2) AS rule,
  coalesce(split_part(hit, ' ', 1), CASE WHEN bound >= {urls.THRESHOLD} THEN 'allow' ELSE 'block' END) AS verdict FROM judged""")
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by its host's reputation;
    a page's outcome is whether its visible text is readable."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    judged = urls.judge(pages, RULES, good=urls.readable(F.col("html")))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@register("op5_embedding_dedup")
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.9 or more among all vectors, and their components."""
    found = embeddings.find_links(table(spark, sf_dir, "embeddings"), cosine=0.9)
    return found.withColumnRenamed("id", "vec_id")


@register("op1_minhash_dedup")
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of three-word shingles have a Jaccard similarity of 0.85 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=3, percent=85).withColumnRenamed("id", "doc_id")


@register("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of 50 words or more that repeat, exactly or with edits, in other documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.repeated_passages(docs, min_words=50).withColumnRenamed("id", "doc_id")


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@register("op11_source_divergence", f"""
WITH doc AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
word AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM doc),
used AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM grp LEFT JOIN used USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(u.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(u.n, 0) + 5)) // (t.total + 5 * l.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM totals t JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN used u ON u.lang = t.lang AND u.source = t.source AND u.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y USING (lang, term)
    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term)
  FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""")
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the other sources of its language, and the terms that set it apart."""
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, top_terms=50)


@register("op12_hard_negatives", """
WITH row_ AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM row_ a JOIN row_ r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0),
positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negative AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 5""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector and its five best positives, five negatives from the window below."""
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    rows = negatives.quantised(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding", scale=256.0)
    return negatives.mine(rows, F.col("id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


#: crc32 of a doc_id written as text, by table, as SQL has no such function
_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda h, b: xor(h >> 8, crc_table.t[(xor(h, b) & 255) + 1]))"""


def _discounts(name: str, counts: str, column: str) -> str:
    """SQL for the discounts d1, d2, d3 of a table's counts."""
    return f"""{name}_n AS (SELECT count(*) FILTER (WHERE {column} = 1)::DOUBLE AS n1, count(*) FILTER (WHERE {column} = 2)::DOUBLE AS n2,
    count(*) FILTER (WHERE {column} = 3)::DOUBLE AS n3, count(*) FILTER (WHERE {column} = 4)::DOUBLE AS n4 FROM {counts}),
{name}_y AS (SELECT 1 - 2 * y * n2 / n1 AS e1, 2 - 3 * y * n3 / n2 AS e2, 3 - 4 * y * n4 / n3 AS e3
  FROM (SELECT *, n1 / (n1 + 2 * n2) AS y FROM {name}_n) WHERE n1 > 0 AND n2 > 0 AND n3 > 0),
{name} AS (SELECT CASE WHEN ok THEN e1 ELSE 0.5::DOUBLE END AS d1, CASE WHEN ok THEN e2 ELSE 1.0::DOUBLE END AS d2, CASE WHEN ok THEN e3 ELSE 1.5::DOUBLE END AS d3
  FROM (SELECT 1) LEFT JOIN (SELECT *, e1 BETWEEN 0 AND 1 AND e2 BETWEEN 0 AND 2 AND e3 BETWEEN 0 AND 3 AS ok FROM {name}_y) ON true)"""


_D = "CASE least({c}, 3) WHEN 1 THEN {d}.d1 WHEN 2 THEN {d}.d2 ELSE {d}.d3 END"


@register("op13_lm_score", oracle_wrap(f"""
WITH crc_table AS (SELECT list(t ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i::BIGINT], range(8)),
    lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS t FROM range(256) r(i))),
doc AS (SELECT doc_id, xor({_CRC}, 4294967295) % 7 = 2 AS held_out,
    list_concat(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+'), [chr(10)]) AS w FROM documents, crc_table),
tok AS (SELECT doc_id, held_out, unnest(w) AS w, unnest(list_concat([chr(9)], w[:-2])) AS u FROM doc),
uni AS (SELECT w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY w),
size AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM uni),
bi AS (SELECT u, w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY u, w),
low AS (SELECT w, count(*) AS a FROM bi GROUP BY w),
{_discounts('e', 'bi', 'c')},
{_discounts('f', 'low', 'a')},
ctx AS (SELECT u, sum(c) AS total, sum({_D.format(c='c', d='e')}) / sum(c) AS back FROM bi, e GROUP BY u),
bottom AS (SELECT sum(a) AS total, sum({_D.format(c='a', d='f')}) / sum(a) AS back FROM low, f),
p1 AS (SELECT w, (a - {_D.format(c='a', d='f')}) / bottom.total + bottom.back / (size.v + 1) AS p FROM low, f, bottom, size),
p AS (SELECT t.doc_id, t.held_out, coalesce(uni.c, 0) AS c, coalesce(p1.p, bottom.back / (size.v + 1), 1.0 / (size.v + 1)) AS low,
    ctx.back, CASE WHEN bi.c > 0 THEN (bi.c - {_D.format(c='bi.c', d='e')}) / ctx.total ELSE 0 END AS share
  FROM tok t CROSS JOIN size CROSS JOIN bottom CROSS JOIN e LEFT JOIN uni ON uni.w = t.w LEFT JOIN p1 ON p1.w = t.w
    LEFT JOIN ctx ON ctx.u = t.u LEFT JOIN bi ON bi.u = t.u AND bi.w = t.w)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (WHERE c > 0) AS n_known, CAST(any_value(size.n) AS BIGINT) AS train_tokens,
  sum(log10((c + 1) / (size.n + size.v + 1))) AS base_score, sum(log10(share + coalesce(back, 1) * low)) AS score
FROM p, size GROUP BY doc_id, held_out""", exact=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"], sig=9))
def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every whole text under a model of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod("doc_id", 7) == 2
    model = kneserney.train(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    done = kneserney.score(rows, model, keep_text=False).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return finalize(done, sig=9)
