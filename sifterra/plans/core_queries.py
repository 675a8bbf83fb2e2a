"""Queries of the general operators over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sifterra.operators.timestamps import normalise_timestamps
from sifterra.plans import corpus, extras, operations, tables  # noqa: F401  (registers their queries)
from sifterra.plans.registry import ORACLES, QUERIES
from sifterra.session import load


def _instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "crawl_documents").select("doc_id", "source_id", "fetched_at", "date_published")
    return normalise_timestamps(docs, load(spark, sf_dir, "source_registry"), ["fetched_at", "date_published"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instants(spark, sf_dir).where("status = 'resolved'").select("doc_id", "field_name", "epoch_s").distinct()


def p6_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its instant, format, posterior and status."""
    return _instants(spark, sf_dir).distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p6_found, p6_instants)} | QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
