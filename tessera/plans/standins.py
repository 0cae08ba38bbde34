"""Stand-in inputs built from the driver's tables (see FIXTURES.md part C).

Each builder has a SQL twin (``*_SQL``) used inside the oracle statements, so
the oracle derives its inputs from the raw tables on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import table


#: A table of more rows is merged, whatever the planner makes of its file: a small one may hold many.
LOOKUP_ROWS = 200_000


def _lookup(df: DataFrame) -> DataFrame:
    """``df`` as a side of an equi-join: sent whole to the tasks only if it has few rows (counted from the file's footer)."""
    return df.hint("merge") if df.select().count() > LOOKUP_ROWS else df


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """user = customer, item = part, rating = mean quantity the customer ordered of the part."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
              .agg(F.avg("l_quantity").alias("rating")))


RATINGS_SQL = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, avg(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""


def click_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Impression-like rows: one per line item, label = returned, score = fixed formula in [0, 1].

    The score uses only + - * / so both engines produce identical doubles.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    od = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    cu = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    pa = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    # orders meet their customers first: lines are many, and travel twice instead of three times
    oc = od.join(_lookup(cu), F.col("o_custkey") == F.col("c_custkey"))
    oc = oc.hint("merge") if od.select().count() > LOOKUP_ROWS else oc
    j = (li.join(oc, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(_lookup(pa), F.col("l_partkey") == F.col("p_partkey")))
    score = ((F.col("l_discount") * 5 + F.col("l_tax") * 4 + F.col("l_quantity") / 100
              + F.col("p_size") / 125) / 1.75)
    # (l_orderkey, l_linenumber) is not unique in these tables: the row id is a 60-bit md5 of the
    # line's integer-valued fields, unique for distinct lines and equal in both engines
    rid = F.conv(F.substring(F.md5(F.concat_ws(
        "|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.col("l_quantity").cast("long").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"))), 1, 15), 16, 10).cast("long")
    return j.select(
        rid.alias("row_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        score.alias("score"),
        ((F.col("p_retailprice") / 2000 + F.col("l_discount") * 5) / 2).alias("score2"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice", "c_acctbal",
        "c_mktsegment", "p_brand", "p_type", "o_orderpriority", "c_nationkey")


CLICK_SQL = """clicks AS (
  SELECT CAST(('0x' || substring(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT),
                                                CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15))::BIGINT AS BIGINT) AS row_id,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         (l_discount * 5 + l_tax * 4 + l_quantity / 100 + p_size / 125) / 1.75 AS score,
         (p_retailprice / 2000 + l_discount * 5) / 2 AS score2,
         l_quantity, l_extendedprice, l_discount, l_tax, p_size, p_retailprice, c_acctbal,
         c_mktsegment, p_brand, p_type, o_orderpriority, c_nationkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey)"""


def listings(spark: SparkSession, sf: str) -> DataFrame:
    """Listings from ``part``: title = name brand type, group = (name, brand), hash from md5(name)."""
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("posting_id"),
                    F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("title"),
                    F.concat_ws("|", "p_name", "p_brand").alias("label_group"),
                    F.substring(F.md5("p_name"), 1, 16).alias("image_phash"),
                    "p_type", "p_brand", "p_retailprice")


LISTINGS_SQL = """listings AS (
  SELECT p_partkey AS posting_id, concat_ws(' ', p_name, p_brand, p_type) AS title,
         concat_ws('|', p_name, p_brand) AS label_group, substring(md5(p_name), 1, 16) AS image_phash,
         p_type, p_brand, p_retailprice
  FROM part)"""
