"""Mix sources to target shares of all tokens, with a cap on repetition."""

from __future__ import annotations

import base64
import os
import re

from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import Memo, map_rows
from sifterra.session import broadcast_if_small, materialize, spread

TOKENIZER_DIR = os.environ.get("SIFTERRA_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_multi_50k.tiktoken"

#: The public split pattern of byte-level BPE.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_PIECE = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")


def _vocabulary(folder: str, name: str) -> str:
    """The vocabulary file: in its folder, or where Spark has put the copy that the driver sent."""
    path = os.path.join(folder, name)
    return path if os.path.exists(path) else SparkFiles.get(name)


class TokenCounter:
    """Counts of a byte-level BPE vocabulary.

    The split pattern never joins what stands before blanks with what stands after them, so a text's
    count is the sum over its pieces (blanks and the run after them), and pieces are memoised.
    """

    def __init__(self, folder: str = TOKENIZER_DIR, name: str = TOKENIZER):
        import tiktoken

        with open(_vocabulary(folder, name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(name, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.pieces = Memo(lambda p: len(self.encoding.encode_ordinary(p)), 400_000)

    def count(self, text: str | None) -> int:
        return sum(map(self.pieces.__getitem__, _PIECE.findall(text))) if text else 0


def token_counts(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", folder: str = TOKENIZER_DIR, name: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, tokens``: null and empty texts have 0 tokens. Repeated rows are counted again, other columns are ignored, an empty table gives an empty result."""

    path = os.path.join(folder, name)
    if not docs.sparkSession.sparkContext.master.startswith("local") and os.path.exists(path):
        docs.sparkSession.sparkContext.addFile(path)  # executors needn't have the folder

    def make():
        counter = TokenCounter(folder, name)

        def one(k, s, t):
            yield k, s, counter.count(t)

        return one

    return map_rows(spread(docs).select(key, F.col(source).alias("source"), text), make, f"{key} {dict(docs.dtypes)[key]}, source string, tokens bigint")


def source_rates(counts: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """Repetition rate of each source: ``source, target_share, max_repeats, available_tokens, rate, planned_tokens``.

    Shares are taken over the sources that have tokens. Without ``total_tokens`` the total is the largest at
    which no cap binds, so every share is met in expectation. With it, rates are ``min(max_repeats, t * share /
    tokens)`` and ``t`` is set so that the capped sources' lack goes to the others in proportion.
    Sources without a target, or with a share or cap of 0 or null, get no row.
    """
    have = counts.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
    want = targets.where("target_share > 0 and max_repeats > 0").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    table = materialize(want.join(have, "source"), "rates")
    s = table.agg(F.sum("target_share").alias("s"), F.min(F.col("max_repeats") * F.col("available_tokens") / F.col("target_share")).alias("t"), F.sum(F.col("max_repeats") * F.col("available_tokens")).alias("cap")).first()
    if s.s is None:
        t = 0.0
    elif total_tokens is None:
        t = s.t * s.s
    elif total_tokens >= s.cap:
        t = float("inf")
    else:
        low, high = 0.0, float(total_tokens)
        planned = lambda t: table.agg(F.sum(F.least(F.col("max_repeats") * F.col("available_tokens"), F.lit(t) * F.col("target_share") / F.lit(s.s)))).first()[0]
        while planned(high) < total_tokens:
            high *= 2
        for _ in range(40):
            mid = (low + high) / 2
            low, high = (mid, high) if planned(mid) < total_tokens else (low, mid)
        t = high
    rate = F.least(F.col("max_repeats").cast("double"), F.lit(t) * F.col("target_share") / F.lit(s.s or 1.0) / F.col("available_tokens")) if t != float("inf") else F.col("max_repeats").cast("double")
    # Where the cap binds, rounding errors must not turn it into a fraction.
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    return table.withColumn("rate", rate).withColumn("planned_tokens", F.col("rate") * F.col("available_tokens"))


def mix(counts: DataFrame, rates: DataFrame, key: str = "doc_id", seed: int = 11) -> DataFrame:
    """One row per copy: ``doc_id, source, copy_no, tokens``. Each document is emitted floor(rate) times and once more with the fraction's probability, drawn from the hash of its key.

    Documents without tokens and sources without a rate give no row, null sources among them. Equal keys draw alike,
    so a result depends on nothing but keys, rates and seed. No group is gathered: rates are joined and rows exploded.
    """
    r = rates.select("source", "rate")
    joined = counts.where("tokens > 0").join(broadcast_if_small(r), "source")
    # 52 bits of an MD5, which any engine can repeat.
    draw = F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.lit(13)), 16, 10).cast("bigint") / F.lit(float(1 << 52))
    copies = (F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    return joined.withColumn("n", copies).where("n > 0").select(key, "source", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy_no"), "tokens")


def mix_report(counts: DataFrame, rates: DataFrame, mixed: DataFrame) -> DataFrame:
    """Target and actual share by source, from the copies emitted; a source without copies shows 0."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("mixed_tokens"), F.count("*").alias("copies"), F.max("copy_no").alias("most_copies"))
    total = got.agg(F.sum("mixed_tokens").alias("all_tokens"))
    return (
        rates.join(got, "source", "left")
        .crossJoin(F.broadcast(total))  # one row
        .select(
            "source", "target_share", "max_repeats", "available_tokens", "rate",
            F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
            (F.coalesce("mixed_tokens", F.lit(0)) / F.col("all_tokens")).alias("actual_share"),
        )
    )
