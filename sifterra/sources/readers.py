"""Scans (S1-S12, S17, S18): tolerant and strict JSON lines, manifests, compressed lines, text lists, binary files, schema changes."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

CORRUPT = "_corrupt"


def read_jsonl(spark: SparkSession, path: str, schema: StructType, strict: bool = False, recursive: bool = False) -> DataFrame:
    """JSON lines. Blank lines are skipped; a malformed line fails a strict read and lands in ``_corrupt`` otherwise."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if strict:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def scan_report(df: DataFrame, required: list[str]) -> DataFrame:
    """One row of counts: lines, malformed ones, those that lack a required key, good ones."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    bad = F.col(CORRUPT).isNotNull()
    return df.agg(F.count("*").alias("lines"), F.count_if(bad).alias("malformed"), F.count_if(~bad & missing).alias("missing_key"), F.count_if(~bad & ~missing).alias("good"))


def read_manifests(spark: SparkSession, glob: str, schema: StructType) -> DataFrame:
    """S3: one JSON-lines manifest per source; the file's stem is ``manifest``."""
    return read_jsonl(spark, glob, schema).withColumn("manifest", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.[^.]+$", 1))


def reject_reason(known: Column) -> Column:
    """why a manifest line isn't taken: malformed, error, no_hash, unknown_source; null for good ones."""
    return F.when(F.col(CORRUPT).isNotNull(), "malformed").when(F.col("error").isNotNull(), "error").when(F.coalesce(F.col("content_hash"), F.lit("")) == "", "no_hash").when(~known, "unknown_source")


def read_zst_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Zstandard-compressed JSON lines, one task a file, streamed; malformed lines are skipped."""
    names = [f.split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for pdf in batches:
            for content in pdf["content"]:
                rows = []
                with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content)) as stream:
                    for line in io.TextIOWrapper(stream, encoding="utf-8", errors="replace"):
                        try:
                            x = json.loads(line)
                        except ValueError:
                            continue
                        if isinstance(x, dict):
                            rows.append(tuple(x.get(n) for n in names))
                        if len(rows) >= 5000:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                yield pd.DataFrame(rows, columns=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """One address a line; blank lines and # comments are skipped."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))


def read_binaries(spark: SparkSession, folder: str, extension: str) -> DataFrame:
    """Files of an extension below a folder, with a check of a PDF's first bytes."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}").option("recursiveFileLookup", "true").load(folder)
    return df.withColumn("magic_ok", F.substring("content", 1, 5) == F.unhex(F.lit("255044462D")))


def with_defaults(df: DataFrame, defaults: dict[str, object], bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Defaults where a setting is missing, then limits."""
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value))
    for name, (low, high) in (bounds or {}).items():
        df = df.withColumn(name, F.least(F.greatest(F.col(name), F.lit(low)), F.lit(high)))
    return df


def migrate(df: DataFrame, target: StructType) -> DataFrame:
    """The columns of a newer schema, absent ones as null, in its order; types are cast."""
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields])
