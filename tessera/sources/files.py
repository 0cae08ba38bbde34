"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["read_csv", "read_json_documents", "read_splits", "file_inventory",
           "write_dataset", "write_embeddings_csv", "write_report", "parse_json_col"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headed CSV with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_csv_quoted(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S01 for files with quoted JSON cells (the counterpart of ``write_embeddings_csv``)."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_json_documents(spark: SparkSession, glob: str, id_col: str, lines: bool = False) -> DataFrame:
    """A folder of JSON documents keyed by an id *inside* each document.

    Each file is one JSON object ``{id_col: .., "<section>": str | object}``, or,
    with ``lines``, each line of each file is one (large corpora come in few
    files; those are split and read in parallel).
    Output is flat: ``(doc_key string, section string, text string)`` where an
    object-valued section is flattened to its scalar / array values joined by
    a space (the grounding text of a section).
    """
    raw = spark.read.text(glob, wholetext=not lines)
    m = F.from_json(F.col("value"), "map<string,string>")
    doc = raw.select(m.alias("m"))
    exploded = doc.select(F.col("m")[id_col].alias("doc_key"),
                          F.explode(F.map_filter("m", lambda k, v: k != F.lit(id_col))).alias("section", "raw"))
    # A section value is either plain text or a JSON object of strings / arrays.
    as_obj = F.from_json(F.col("raw"), "map<string,string>")
    flat = F.when(F.col("raw").startswith("{"),
                  F.array_join(F.transform(F.map_values(as_obj), lambda v: F.when(
                      v.startswith("["), F.array_join(F.from_json(v, "array<string>"), " ")).otherwise(v)), " ")
                  ).otherwise(F.col("raw"))
    return exploded.select("doc_key", "section", F.coalesce(flat, F.lit("")).alias("text"))


def read_splits(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Union of published splits with a literal ``split`` column."""
    out = None
    for name, p in paths.items():
        d = spark.read.format(fmt).load(p).withColumn("split", F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def file_inventory(spark: SparkSession, root: str, n: int = 5) -> DataFrame:
    """Per directory, the number of files and the first ``n`` names.

    Reads only file metadata (``binaryFile`` with ``content`` pruned).
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path"))
    parts = files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("directory"),
                         F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    from tessera.functions.skew import top_k_per_key
    counts = parts.groupBy("directory").agg(F.count(F.lit(1)).alias("n_files"))
    # only the first n names of a directory are ever gathered into one row
    first = top_k_per_key(parts, "directory", [F.col("name")], n).groupBy("directory").agg(
        F.array_sort(F.collect_list("name")).alias("first_names"))
    return counts.join(first, "directory")


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Write prepared examples as Parquet for a later stage."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_embeddings_csv(df: DataFrame, path: str, vec_col: str = "embedding") -> None:
    """Chunk vectors as CSV; the vector column becomes a JSON array string."""
    (df.withColumn(vec_col, F.to_json(F.col(vec_col)))
       .write.mode("overwrite").option("header", True)
       .option("quote", '"').option("escape", '"').csv(path))


def write_report(df: DataFrame, path: str, key: str, metrics: list[str]) -> None:
    """Per-row report plus one trailing average row (key = 'AVERAGE')."""
    avg_row = df.agg(*[F.avg(m).alias(m) for m in metrics]).withColumn(key, F.lit("AVERAGE"))
    out = df.select(F.col(key).cast("string").alias(key), *metrics).unionByName(avg_row)
    out.write.mode("overwrite").option("header", True).csv(path)


def parse_json_col(df: DataFrame, col: str, schema: T.StructType | str, alias: str | None = None) -> DataFrame:
    """Parse a JSON string column into a typed struct column."""
    return df.withColumn(alias or f"{col}_parsed", F.from_json(F.col(col), schema))
