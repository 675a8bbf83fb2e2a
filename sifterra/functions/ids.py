"""Content hashes and ids (I)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _nul() -> Column:
    return F.unhex(F.lit("00"))


def content_hash(text: Column) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.left(F.sha2(text.cast("binary"), 256), F.lit(16))


def document_id(source: Column, url: Column, hash_: Column) -> Column:
    """First 24 hex digits over NUL-separated parts."""
    return F.left(F.sha2(F.concat(source.cast("binary"), _nul(), url.cast("binary"), _nul(), hash_.cast("binary")), 256), F.lit(24))


def chunk_id(doc: Column, index: Column, text: Column) -> Column:
    """First 24 hex digits over the document id, the index as a little-endian 32-bit number and the text, NUL-separated."""
    h = F.lpad(F.hex(index.cast("bigint")), 8, "0")
    little = F.unhex(F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)]))
    return F.lower(F.left(F.sha2(F.concat(doc.cast("binary"), _nul(), little, _nul(), text.cast("binary")), 256), F.lit(24)))


def blob_path(source: Column, hash_: Column, extension: Column) -> Column:
    """Content-addressed path."""
    return F.concat_ws("/", F.lit("blobs"), source, F.left(hash_, F.lit(2)), F.concat(hash_, F.lit("."), extension))
