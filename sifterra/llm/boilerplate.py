"""Lines repeated across one source's documents: a weighted graph of consecutive lines, its components, and the texts without them."""

from __future__ import annotations

import unicodedata

import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifterra.llm.common import Memo, map_rows
from sifterra.session import broadcast_if_small, materialize, release, spread

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def line_form(line: str) -> str:
    """Letters and combining marks in order, in NFC, without case."""
    if not unicodedata.is_normalized("NFC", line):
        line = unicodedata.normalize("NFC", line)
    return _OTHER.sub("", line).casefold()


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def _line_key(line: str) -> tuple[int, int] | None:
    form = line_form(line)
    if not form:
        return None
    n = xxhash.xxh3_128_intdigest(form.encode())
    return _signed(n >> 64), _signed(n & ((1 << 64) - 1))


def line_table(chunks: DataFrame, doc_sources: DataFrame) -> DataFrame:
    """One row per line with letters: ``source_id, doc_id, chunk_id, line_no, h1, h2`` (a 128-bit hash of the line's form).

    Only hashes are shuffled, never texts. Documents without a source are left out; one listed under
    several sources counts in each. Rows are not distinct: equal chunks give equal rows.
    """

    def make():
        keys = Memo(_line_key, 20_000)

        def one(c, d, text):
            if text:
                h1, h2, no = [], [], []
                for i, line in enumerate(text.split("\n"), 1):
                    k = keys[line] if len(line) < 200 else _line_key(line)
                    if k:
                        h1.append(k[0])
                        h2.append(k[1])
                        no.append(i)
                if no:
                    yield c, d, no, h1, h2

        return one

    lines = map_rows(spread(chunks.select("chunk_id", "doc_id", "text")), make, "chunk_id string, doc_id string, nos array<int>, h1s array<bigint>, h2s array<bigint>")
    sources = doc_sources.select("doc_id", "source_id").where("doc_id is not null and source_id is not null").distinct()
    joined = lines.join(sources, "doc_id")
    return joined.select("source_id", "doc_id", "chunk_id", F.explode(F.arrays_zip("nos", "h1s", "h2s")).alias("x")).select(
        "source_id", "doc_id", "chunk_id", F.col("x.nos").alias("line_no"), F.col("x.h1s").alias("h1"), F.col("x.h2s").alias("h2")
    )


def frequent_lines(lines: DataFrame, least_docs: int = 8) -> DataFrame:
    """Nodes of high support: lines in at least ``least_docs`` different documents of one source, with their support.

    Distinct (source, line, document) first, so both shuffles are spread by line and pre-aggregated; a
    source that holds a third of all rows is no group of any stage.
    """
    once = lines.select("source_id", "h1", "h2", F.xxhash64("doc_id").alias("d")).distinct()
    return once.groupBy("source_id", "h1", "h2").agg(F.count("*").alias("support")).where(F.col("support") >= least_docs)


def occurrences(lines: DataFrame, nodes: DataFrame, salts: int = 16) -> DataFrame:
    """Every occurrence of a frequent line. Broadcast while the nodes are small; else a join on the line, salted, since one line may be in a third of all documents."""
    small = broadcast_if_small(nodes, 32 << 20)
    if small is not nodes:
        return lines.join(small, ["source_id", "h1", "h2"])
    left = lines.withColumn("salt", F.pmod(F.xxhash64("chunk_id", "line_no"), F.lit(salts)))
    right = nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return left.join(right, ["source_id", "h1", "h2", "salt"]).drop("salt")


def line_edges(found: DataFrame, least_docs: int = 8) -> DataFrame:
    """Edges of high support: two frequent lines on consecutive lines of a text, with the number of documents."""
    a = found.select("source_id", "chunk_id", "doc_id", "line_no", F.col("h1").alias("a1"), F.col("h2").alias("a2")).distinct()
    b = found.select("source_id", "chunk_id", (F.col("line_no") - 1).alias("line_no"), F.col("h1").alias("b1"), F.col("h2").alias("b2")).distinct()
    pairs = a.join(b, ["source_id", "chunk_id", "line_no"])
    once = pairs.select("source_id", "a1", "a2", "b1", "b2", F.xxhash64("doc_id").alias("d")).distinct()
    return once.groupBy("source_id", "a1", "a2", "b1", "b2").agg(F.count("*").alias("weight")).where(F.col("weight") >= least_docs)


def line_blocks(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components of the frequent lines: ``source_id, h1, h2, support, block``. Labels pass along edges until none changes.

    A label is a line of the same component. Each round a line and the line that its label names take the
    least label that their neighbours' labels have, and every label is replaced by its own, so rounds
    grow with the logarithm of a chain. The graph holds frequent lines only, so it is far smaller than the
    corpus; it stays distributed and every round's labels are written to the shared folder.
    """
    ident = lambda a, b: F.format_string("%016x%016x", a, b)
    pair = edges.select("source_id", ident("a1", "a2").alias("id"), ident("b1", "b2").alias("other"))
    both = materialize(pair.unionByName(pair.select("source_id", F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "edges")
    labels = materialize(nodes.withColumn("id", ident("h1", "h2")).select("*", F.col("id").alias("block"), F.lit(True).alias("moved")), "blocks")
    while labels.where("moved").limit(1).count():
        named = labels.select("source_id", F.col("id").alias("block"), F.col("block").alias("next"))
        now = materialize(labels.drop("moved").join(named, ["source_id", "block"]), "blocks")
        sent = both.join(now.select("source_id", F.col("id").alias("other"), "next"), ["source_id", "other"]).groupBy("source_id", "id").agg(F.min("next").alias("sent"))
        up = now.join(sent, ["source_id", "id"]).select("source_id", "block", "sent")
        least = sent.unionByName(up.select("source_id", F.col("block").alias("id"), "sent")).groupBy("source_id", "id").agg(F.min("sent").alias("sent"))
        new = now.join(least, ["source_id", "id"], "left").withColumn("new", F.least("block", "next", "sent"))
        after = materialize(new.select("source_id", "h1", "h2", "support", "id", F.col("new").alias("block"), (F.col("new") < F.col("block")).alias("moved")), "blocks")
        # What no later round reads goes at once.
        release(now)
        release(labels)
        labels = after
    release(both)
    return labels.drop("moved", "id")


def repeated_lines(chunks: DataFrame, doc_sources: DataFrame, least_docs: int = 8) -> DataFrame:
    """Every occurrence of a boilerplate line: ``chunk_id, doc_id, source_id, line_no, support, block``.

    Nodes are lines in at least ``least_docs`` documents of a source, edges join consecutive ones, blocks are
    components; a frequent line without frequent neighbours is a block of its own. Null texts and lines
    without letters are no lines; repeated chunks count once; an empty table gives an empty result.
    """
    lines = materialize(line_table(chunks, doc_sources), "lines")
    nodes = materialize(frequent_lines(lines, least_docs), "nodes")
    found = materialize(occurrences(lines, nodes).drop("support"), "found")
    release(lines)
    blocks = line_blocks(nodes, line_edges(found, least_docs))
    return occurrences(found, blocks).select("chunk_id", "doc_id", "source_id", "line_no", "support", "block").distinct()


def strip_lines(chunks: DataFrame, repeated: DataFrame) -> DataFrame:
    """Chunks with ``clean_text``: the text without the given lines. Null texts stay null."""
    drop = repeated.groupBy("chunk_id").agg(F.collect_set("line_no").alias("_drop_nos"))
    j = chunks.join(drop, "chunk_id", "left")
    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.when(~F.array_contains(F.coalesce("_drop_nos", F.array().cast("array<int>")), i + 1), line))
    return j.withColumn("clean_text", F.when(F.col("text").isNotNull(), F.array_join(F.array_compact(numbered), "\n"))).drop("_drop_nos")
