"""Helpers shared by the training-data operators: safe column picking, shared-folder tables, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.skew import salted_self_join
from tessera.session import checkpoint_dir

#: Fixed value: the six whitespace characters of the word rule ``[^\x20\x09-\x0D]+``.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _positions(columns: list[str], names: list[str]) -> list[int]:
    out = []
    for n in names:
        exact = [i for i, x in enumerate(columns) if x == n]
        loose = [i for i, x in enumerate(columns) if x.lower() == n.lower()]
        if not (exact or loose):
            raise ValueError(f"input has no column {n!r}; it has {columns}")
        out.append((exact or loose)[0])
    return out


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Only the named columns, safe against extra columns whose names clash.

    A name is matched exactly first, then case-insensitively; the first match
    wins. Extra columns (``Text`` beside ``text``, repeated names) are ignored.
    ``new=old`` pairs rename.
    """
    want = [(n, n) for n in names] + [(new, old) for new, old in renamed.items()]
    pos = _positions(df.columns, [old for _, old in want])
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(new) for i, (new, _) in zip(pos, want)])


class Wide:
    """A table whose own columns are kept whole under neutral names while an operator adds its own.

    ``Wide(df).frame`` holds every column as ``c0..cn`` (so no operator column
    can clash with them); ``col('text')`` names the wanted one; ``restore``
    drops whatever was added and gives the original names back.
    """

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.frame = df.toDF(*[f"c{i}" for i in range(len(self.names))])

    def col(self, name: str) -> Column:
        return F.col(f"c{_positions(self.names, [name])[0]}")

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*[f"c{i}" for i in range(len(self.names))]).toDF(*self.names)


def materialise(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet (with the writer's ``options``) into the cluster's shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation of what came
    before), keeps column pruning for later readers, and gives the planner a
    true file size, so that it broadcasts the table only when it is small.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may copy the definition of a column into an expression that
    uses it, inside lambdas too, where it would run again per element; a value
    that is bound as a lambda's own variable cannot be copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def unit_draw(seed, *cols: Column) -> Column:
    """Uniform [0, 1) from the first 13 hex digits of ``md5('seed|c1|..')``; any SQL engine can state it."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(16 ** 13))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected edge list ``(a, b)``: one row ``(node, root)`` per node.

    ``root`` is the smallest node of the component. Alternates large-star and
    small-star steps until the edge set stops changing, which is certain to
    happen (after O(log^2 n) rounds); there is no round limit. Every step is a
    partial aggregate plus an equi-join in which a hub's neighbours are dealt
    over salted tasks; the driver only sees one count and one hash per round.
    """
    def state(e: DataFrame):
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    # invariant: a > b, b is the smaller end
    e = materialise(edges.where(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = state(e)
    while seen[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (salted_self_join(both.where(F.col("v") > F.col("u")), low, "u", "v")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (salted_self_join(large, low, "a", "b").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")))
        e = materialise(small.distinct())
        now = state(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
