"""Sinks (S13-S16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.functions.ids import blob_path, content_hash
from sifterra.session import materialize, path_exists


def write_jsonl(df: DataFrame, path: str) -> None:
    """S13."""
    df.write.mode("overwrite").json(path)


def append_new(df: DataFrame, path: str, key: str) -> DataFrame:
    """Appends rows whose key the log doesn't hold yet; gives the rows appended."""
    spark = df.sparkSession
    fresh = df
    if path_exists(spark, path):  # a failed read raises, so nothing is appended twice
        fresh = df.join(spark.read.schema(df.schema).json(path).select(key).distinct(), key, "left_anti")
    fresh = materialize(fresh, "appended")
    fresh.write.mode("append").json(path)
    return fresh


def content_addressed(df: DataFrame, source: str, content: str, extension: str) -> DataFrame:
    """A path from each content's hash; equal contents have one row."""
    h = content_hash(F.col(content))
    return df.select(F.col(source), F.col(content), h.alias("content_hash"), blob_path(F.col(source), h, F.lit(extension)).alias("path")).dropDuplicates(["path"])


def export_release(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Tables as Parquet and a manifest of rows and an order-free checksum each."""
    spark = next(iter(tables.values())).sparkSession
    manifest = None
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        back = spark.read.parquet(f"{folder}/{name}")
        row = back.select(F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in back.columns]))).alias("h")).agg(F.lit(name).alias("table"), F.count("*").alias("rows"), F.sum((F.col("h") % 1_000_000_007).cast("decimal(38,0)")).cast("string").alias("checksum"))
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.json(f"{folder}/manifest")
