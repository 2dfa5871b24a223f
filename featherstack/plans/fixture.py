"""Stand-in mapping from the driver's tables to the credit-risk roles.

| role                         | stand-in                         |
|------------------------------|----------------------------------|
| application (entity key)     | customer ⟕ nation, key c_custkey |
| previous application         | orders (F approved, P refused)   |
| bureau → bureau balance      | orders → lineitem                |
| instalment payments          | lineitem ⋈ orders                |
| monthly POS / card balance   | events (user_id, ts, value)      |
| target with features         | labels ⋈ documents               |

Day columns are relative integers (negative = past), like the reference's
``DAYS_*`` columns.  Each Spark view has a matching SQL text used by the
DuckDB oracles; both are written independently from the same mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import relative_day

ORDER_ANCHOR = "2001-08-01"
EVENT_ANCHOR = "2024-01-31"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity table: one row per customer, nation attributes joined, train/test
    flag.  The nation scan's size is known from its files, so the planner's
    own size threshold broadcasts it (and would fall back to a shuffle join
    beyond it) without an extra job."""
    cust = _t(spark, sf_dir, "customer")
    nation = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    out = cust.join(nation, "c_nationkey", "left")
    return out.withColumn("is_train", (F.col("c_custkey") % 5) != 0)


APPLICATION_SQL = """(SELECT c.*, n.n_name, n.n_regionkey, (c.c_custkey % 5) <> 0 AS is_train
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                    relative_day("o_orderdate", ORDER_ANCHOR).alias("day"))


PREVIOUS_SQL = f"""(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  CAST(date_diff('day', DATE '{ORDER_ANCHOR}', CAST(o_orderdate AS DATE)) AS INTEGER) AS day FROM orders)"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     relative_day("l_shipdate", ORDER_ANCHOR).alias("ship_day"))


LINES_SQL = f"""(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus,
  CAST(date_diff('day', DATE '{ORDER_ANCHOR}', CAST(l_shipdate AS DATE)) AS INTEGER) AS ship_day FROM lineitem)"""


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instalments: due on the order day, paid on the ship day."""
    li = lines(spark, sf_dir)
    o = previous(spark, sf_dir).select("o_orderkey", "o_custkey", F.col("day").alias("due_day"))
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select("o_custkey", "l_orderkey", "l_linenumber", "l_partkey",
                    F.col("l_extendedprice").alias("instalment"),
                    (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment"),
                    "due_day", F.col("ship_day").alias("paid_day"))


INSTALLMENTS_SQL = f"""(SELECT o.o_custkey, l.l_orderkey, l.l_linenumber, l.l_partkey,
  l.l_extendedprice AS instalment, l.l_extendedprice * (1 - l.l_discount) AS payment,
  o.day AS due_day, l.ship_day AS paid_day
  FROM {LINES_SQL} l JOIN {PREVIOUS_SQL} o ON l.l_orderkey = o.o_orderkey)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", "ts",
                    relative_day("ts", EVENT_ANCHOR).alias("day"))


EVENTS_SQL = f"""(SELECT event_id, user_id, event_type, value, ts,
  CAST(date_diff('day', DATE '{EVENT_ANCHOR}', CAST(ts AS DATE)) AS INTEGER) AS day FROM events)"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = _t(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "inner")


LABELLED_SQL = """(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
