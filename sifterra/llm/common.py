"""Shared pieces: Arrow batch mapping, words, bounded memos."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


SLICE = 512


class Memo(dict):
    """A dict that computes what it lacks and empties itself at ``limit`` entries, so that memory stays bounded whatever the vocabulary."""

    def __init__(self, make: Callable, limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def map_rows(df: DataFrame, make: Callable[[], Callable[..., Iterator[tuple]]], schema: str) -> DataFrame:
    """Arrow batches in, Arrow batches out. ``make()`` runs once a task and returns a function from one row's values to output rows."""

    def make_slices():
        one = make()

        def some(rows):
            for row in rows:
                yield from one(*row)

        return some

    return map_slices(df, make_slices, schema)


def map_slices(df: DataFrame, make: Callable[[], Callable[[list[tuple]], Iterator[tuple]]], schema: str) -> DataFrame:
    """As ``map_rows``, for functions that take some rows at a time, so that their work can be done on arrays."""
    struct = _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    arrow = to_arrow_schema(struct)

    def run(batches):
        some = make()
        for batch in batches:
            out: list[tuple] = []
            # A few rows at a time become Python objects, so long texts don't stand in memory twice.
            for start in range(0, batch.num_rows, SLICE):
                out.extend(some(list(zip(*[c.to_pylist() for c in batch.slice(start, SLICE).columns]))))
                if len(out) >= 20_000:
                    yield _batch(out, arrow)
                    out = []
            if out:
                yield _batch(out, arrow)

    return df.mapInArrow(run, struct)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_HOLDS = Memo(lambda token: any(c.isalnum() for c in token))


def is_word(token: str) -> bool:
    """A blank-separated token that holds a letter or a digit."""
    return _HOLDS[token]


def count_words(text: str) -> int:
    return sum(map(_HOLDS.__getitem__, text.split()))


def save_model(spark: SparkSession, model, path: str) -> None:
    """A fitted model as a table of one row, in any storage that the session reaches; an older one there is replaced."""
    spark.createDataFrame([(pickle.dumps(model),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str):
    """What ``save_model`` wrote. Load only models of your own: unpickling runs code."""
    return pickle.loads(bytes(spark.read.parquet(path).first()[0]))


_FITTED: dict[tuple, object] = {}


def fitted(spark: SparkSession, name: str, folder: str, fit: Callable[[], object]):
    """The model of that name for the tables of a folder: fitted once a session, whichever queries use it. Fits are deterministic, so a second one would be equal."""
    key = (spark.sparkContext.applicationId, name, folder)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]
