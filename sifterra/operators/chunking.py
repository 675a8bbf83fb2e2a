"""Splitting texts into overlapping chunks (T-2, T-3)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifterra.functions.ids import chunk_id

TARGET, OVERLAP, LEAST, SNAP = 1800, 180, 200, 120


def chunk_spans(text: Column, target: int = TARGET, overlap: int = OVERLAP, least: int = LEAST, snap: int = SNAP) -> Column:
    """Array of structs (chunk_index, char_start, char_end). Starts are arithmetic: 0, target - overlap, ...

    An end is the wanted end, or the first sentence end within ``snap`` characters after it. Texts under
    ``least`` characters are one chunk; an empty text has none. A pure expression: no shuffle, no Python.
    """
    step, n = target - overlap, F.length(text)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step))

    def end_of(s: Column) -> Column:
        want = F.least(s + target, n)
        ahead = F.substring(text, want + 1, F.lit(snap + 1))
        hit = F.length(F.regexp_extract(ahead, rf"(?sU)^(.{{0,{snap - 1}}}?(?:[।?!]|\.(?=\s)|\n\n))", 1))
        # The second of two line ends may lie one beyond the window, other marks may not.
        return F.when((want < n) & (hit > 0) & ((hit <= snap) | F.substring(ahead, snap, 2).eqNullSafe("\n\n")), want + hit).otherwise(want)

    spans = F.transform(starts, lambda s, i: F.struct(i.alias("chunk_index"), s.alias("char_start"), end_of(s).alias("char_end")))
    # The first chunk that reaches the end is the last.
    kept = F.filter(spans, lambda x: (x["char_start"] == 0) | (F.least(x["char_start"] - step + target, n) < n) & (end_of(x["char_start"] - step) < n))
    whole = F.array(F.struct(F.lit(0).alias("chunk_index"), F.lit(0).alias("char_start"), n.alias("char_end")))
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.array().cast("array<struct<chunk_index:int,char_start:int,char_end:int>>")).when(n < least, whole).otherwise(kept)


def chunk_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", **sizes: int) -> DataFrame:
    """One row per chunk with its id, place and text."""
    d = docs.select(F.col(key), F.col(text).alias("_t"), F.explode(chunk_spans(F.col(text), **sizes)).alias("s"))
    piece = F.substring(F.col("_t"), F.col("s.char_start") + 1, F.col("s.char_end") - F.col("s.char_start"))
    d = d.select(key, F.col("s.chunk_index").alias("chunk_index"), F.col("s.char_start").alias("char_start"), F.col("s.char_end").alias("char_end"), piece.alias("text"))
    return d.withColumn("chunk_id", chunk_id(F.col(key).cast("string"), F.col("chunk_index"), F.col("text")))


def backward_chunks(text: str, target: int = 600, overlap: int = 80, least_bytes: int = 100) -> Iterator[tuple[int, int, str]]:
    """T-3: ends snap back to the last terminator in the window's last quarter; the next start depends on the end."""
    start, n = 0, len(text)
    while start < n:
        end = hard = min(start + target, n)
        if hard < n:
            low = max(hard - target // 4, start + least_bytes)
            cut = max((text.rfind(c, low, hard) for c in ".।!?\n"), default=-1)
            if cut >= low:
                end = cut + 1
        piece = text[start:end].strip()
        if len(piece.encode()) >= least_bytes:
            yield start, end, piece
        if end >= n:
            return
        start = max(end - overlap, start + 1)


def chunk_backward(docs: DataFrame, key: str = "doc_id", text: str = "text", target: int = 600, overlap: int = 80) -> DataFrame:
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, i, a, b, piece) for k, t in zip(pdf[key], pdf[text]) if t for i, (a, b, piece) in enumerate(backward_chunks(t, target, overlap))]
            yield pd.DataFrame(rows, columns=[key, "chunk_index", "char_start", "char_end", "text"])

    return docs.select(key, text).mapInPandas(run, f"{key} {kind}, chunk_index int, char_start int, char_end int, text string")
