"""Queries of this subpackage's operators over the driver's tables. Each runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifterra.llm import boilerplate, encoding, language, leaks, mixing, pages, pairs, reading
from sifterra.llm.common import fitted, map_rows, map_slices
from sifterra.session import load, materialize, spread


def _tagger(spark: SparkSession, sf_dir: str) -> pages.PageTagger:
    return fitted(spark, "pages", sf_dir, lambda: pages.fit_page_tagger(load(spark, sf_dir, "parsed_pages")))


def _language(spark: SparkSession, sf_dir: str) -> language.LanguageModel:
    return fitted(spark, "language", sf_dir, lambda: language.fit_language_model(load(spark, sf_dir, "documents")))


def _reading(spark: SparkSession, sf_dir: str) -> reading.ReadingModel:
    return fitted(spark, "reading", sf_dir, lambda: reading.fit_from_table(load(spark, sf_dir, "graded_samples")))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "parsed_pages")
    blocks = pages.page_blocks(table, _tagger(spark, sf_dir))
    return blocks.where("not is_body and not shell").select("page_id", "line_no").distinct()


def p1_main_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main-body text of every page."""
    table = load(spark, sf_dir, "parsed_pages")
    return pages.main_text(table, _tagger(spark, sf_dir)).distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "parsed_pages")
    return pages.shell_pages(table, _tagger(spark, sf_dir)).select("page_id").distinct()


def p2_kept_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that stay once those without content are dropped, with the hints beside them."""
    table = load(spark, sf_dir, "parsed_pages")
    shells = pages.shell_pages(table, _tagger(spark, sf_dir)).select("page_id").distinct()
    hints = load(spark, sf_dir, "poll_cycles").groupBy("cycle_id").agg(F.bool_or("shell_flagged").alias("shell_flagged"))
    kept = table.select("page_id", "source_id", "cycle_id", "script_count").distinct().join(shells, "page_id", "left_anti")
    return kept.join(hints, "cycle_id", "left").select("page_id", "source_id", "script_count", "shell_flagged")


def _garbled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.garbled_fields(encoding.field_table(load(spark, sf_dir, "converter_validation")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _garbled(spark, sf_dir).select("cv_id", "field_name").distinct()


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged fields with the wrong encodings that were undone and the text restored."""
    return _garbled(spark, sf_dir).distinct()


def _all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.smoke_pairs(load(spark, sf_dir, "smoke_results")).unionByName(pairs.chat_pairs(load(spark, sf_dir, "chat_turns")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _language(spark, sf_dir)
    return pairs.pair_defects(_all_pairs(spark, sf_dir), model).where("defect is not null").distinct()


def p4_defect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs by origin and defect, sound ones as 'none'."""
    model = _language(spark, sf_dir)
    found = pairs.pair_defects(_all_pairs(spark, sf_dir), model).distinct()
    return found.groupBy(F.substring_index("pair_key", ":", 1).alias("origin"), F.coalesce("defect", F.lit("none")).alias("defect")).agg(F.count("*").alias("pairs"))


_COUNTED = "rec_key string, seg_no int, lang string, confidence double, doc_id string, words bigint, label_ok boolean"


def language_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record and mixed segment with language, confidence and whether its label names the language.

    Documents and chunks in one Arrow pass each; pages by the main body that the page tagger leaves; crawl
    documents by the words of their distinct chunks, from the same pass over the chunks.
    """
    docs = load(spark, sf_dir, "documents")
    model = _language(spark, sf_dir)
    out = language.label_records(docs, model, "doc", "doc_id", "text", "lang").select("rec_key", "seg_no", "lang", "confidence", "label_ok")

    def make_chunks():
        def one(chunk, doc, text, label):
            if chunk is None or text is None:
                return
            words, weight, lines = language.text_segments(model, text)
            main = language.main_language(words, weight)
            if main is None:
                return
            rec = f"chunk:{chunk}"
            yield rec, 0, main[0], main[1], None, None, language.named_language(label) == main[0]
            if len({x[1] for x in lines}) > 1:
                for no, lang, conf in lines:
                    yield rec, no, lang, conf, None, None, False
            if doc is not None:
                for lang, n in words.items():
                    yield rec, -1, lang, weight[lang] / n, doc, n, None

        return one

    chunks = spread(load(spark, sf_dir, "chunks").select("chunk_id", "doc_id", "text", "language"))
    seen = materialize(map_rows(chunks, make_chunks, _COUNTED), "chunk_languages")
    out = out.unionByName(seen.where("seg_no >= 0").select("rec_key", "seg_no", "lang", "confidence", "label_ok"))

    table = load(spark, sf_dir, "parsed_pages")
    tagger, residue = _tagger(spark, sf_dir), pages.ResidueMatcher()

    def make_pages():
        def some(rows):
            for (page, _, _, label), (lines, labels, shell, _, _) in zip(rows, pages.read_pages([r[1:3] for r in rows], tagger, residue)):
                if page is None or shell or not lines:
                    continue
                words, weight, _ = language.text_segments(model, "\n".join(x for x, lab in zip(lines, labels) if lab == 0))
                main = language.main_language(words, weight)
                if main is not None:
                    yield f"page:{page}", 0, main[0], main[1], language.named_language(label) == main[0]

        return some

    out = out.unionByName(map_slices(spread(table).select("page_id", "title", "extracted_text", "lang"), make_pages, "rec_key string, seg_no int, lang string, confidence double, label_ok boolean"))

    # A chunk counts once however often its row is repeated.
    per_chunk = seen.where("seg_no = -1").groupBy("rec_key", "doc_id", "lang").agg(F.max("words").alias("words"), F.max("confidence").alias("confidence"))
    per_doc = per_chunk.groupBy("doc_id", "lang").agg(F.sum("words").alias("words"), F.sum(F.col("words") * F.col("confidence")).alias("weight"))
    main = per_doc.groupBy("doc_id").agg(F.max_by("lang", F.struct("words", "weight", "lang")).alias("lang"), F.max(F.struct("words", "weight", "lang")).alias("top"))
    labels = load(spark, sf_dir, "crawl_documents").select("doc_id", "language").distinct()
    named = _named(F.col("language"))
    crawl = labels.join(main, "doc_id").select(
        F.concat(F.lit("crawl:"), "doc_id").alias("rec_key"), F.lit(0).alias("seg_no"), "lang", (F.col("top.weight") / F.col("top.words")).alias("confidence"), F.coalesce(named == F.col("lang"), F.lit(False)).alias("label_ok")
    )
    return out.unionByName(crawl)


def _named(label):
    """``named_language`` as an expression."""
    low = F.lower(F.trim(label))
    head = F.regexp_replace(low, r"[-_]([a-z]{2}|\d{3})$", "")
    names = F.create_map(*[F.lit(x) for pair in language.NAMES.items() for x in pair])
    return F.when(low == "ne-latn", "ne-Latn").otherwise(F.try_element_at(names, head))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_table(spark, sf_dir).where("seg_no > 0 or not label_ok").select("rec_key", "seg_no", "lang").distinct()


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's and mixed segment's language with its confidence."""
    return language_table(spark, sf_dir).distinct()


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.repeated_lines(load(spark, sf_dir, "chunks"), load(spark, sf_dir, "crawl_documents"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repeated(spark, sf_dir).select("chunk_id", "line_no").distinct()


def p7_clean_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks without the repeated lines."""
    chunks = load(spark, sf_dir, "chunks").select("chunk_id", "doc_id", "chunk_index", "text")
    # Repeated rows go after the join, whose partitioning by chunk serves for that: texts are shuffled once.
    return boilerplate.strip_lines(chunks, _repeated(spark, sf_dir)).select("chunk_id", "doc_id", "chunk_index", "clean_text").distinct()


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "gold_items")).select("item_id", "doc_id").distinct()


def p8_leak_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold each leaked item, and their number."""
    found = leaks.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "gold_items")).select("item_id", "doc_id").distinct()
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_doc_id"))


def _mixed(spark: SparkSession, sf_dir: str):
    counts = materialize(mixing.token_counts(load(spark, sf_dir, "documents")), "tokens")
    rates = mixing.source_rates(counts, load(spark, sf_dir, "mix_targets"))
    return counts, rates, mixing.mix(counts, rates)


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture: one row per copy of a chosen document."""
    return _mixed(spark, sf_dir)[2]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    counts, rates, mixed = _mixed(spark, sf_dir)
    return mixing.mix_report(counts, rates, mixed)


def _mixed_chars(spark: SparkSession, sf_dir: str):
    docs = load(spark, sf_dir, "documents")
    counts = docs.select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("tokens"))
    rates = mixing.source_rates(counts, load(spark, sf_dir, "mix_targets"))
    return counts, rates, mixing.mix(counts, rates)


def p9_mix_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture where a document's size is its characters, which SQL can count: rates, caps and draws beside it."""
    return _mixed_chars(spark, sf_dir)[2]


def p9_shares_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of that mixture."""
    return mixing.mix_report(*_mixed_chars(spark, sf_dir)).select("source", "max_repeats", F.col("available_tokens").cast("bigint").alias("available_tokens"), F.round("rate", 9).alias("rate"), "copies", "most_copies", "mixed_tokens", F.round("actual_share", 9).alias("actual_share"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = _language(spark, sf_dir)
    level = _reading(spark, sf_dir)
    return reading.reading_levels(docs, model, level).select("doc_id", "reading_level").distinct()


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and words by language and level."""
    docs = load(spark, sf_dir, "documents")
    found = reading.reading_levels(docs, _language(spark, sf_dir), _reading(spark, sf_dir))
    return found.groupBy("lang", "reading_level").agg(F.count("*").alias("documents"), F.sum("n_words").alias("words"), F.avg("confidence").alias("confidence"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [p1_found, p1_main_body, p2_found, p2_kept_pages, p3_found, p3_restored, p4_found, p4_defect_counts, p5_found, p5_languages, p7_found, p7_clean_chunks, p8_found, p8_leak_report, p9_mix, p9_shares, p9_mix_by_length, p9_shares_by_length, p10_found, p10_profile]
    return {f.__name__: f for f in named}


_LINE_FORM = "regexp_replace(lower(nfc_normalize(line)), '[^\\p{L}\\p{M}]+', '', 'g')"

_P7 = f"""
WITH lines AS (
  SELECT DISTINCT chunk_id, doc_id, CAST(i AS INTEGER) AS line_no, {_LINE_FORM} AS form
  FROM (SELECT chunk_id, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM chunks WHERE text IS NOT NULL)
), own AS (
  SELECT DISTINCT l.chunk_id, l.doc_id, l.line_no, l.form, d.source_id FROM lines l JOIN (SELECT DISTINCT doc_id, source_id FROM crawl_documents WHERE source_id IS NOT NULL) d USING (doc_id) WHERE l.form <> ''
), often AS (
  SELECT source_id, form FROM own GROUP BY source_id, form HAVING count(DISTINCT doc_id) >= 8
)
SELECT DISTINCT own.chunk_id, own.line_no FROM own JOIN often USING (source_id, form)
"""

_GRAMS = """
  SELECT {key}, list_aggregate(words[i:i+9], 'string_agg', ' ') AS gram
  FROM (SELECT {key}, words, unnest(generate_series(1, len(words) - 9)) AS i FROM (
    SELECT {key}, regexp_extract_all(lower(translate(nfc_normalize({text}), '०१२३४५६७८९', '0123456789')), '[\\p{{L}}\\p{{M}}\\p{{Nd}}]+') AS words FROM {table} WHERE {text} IS NOT NULL) WHERE len(words) >= 10)
"""

_P8_PAIRS = (
    "WITH items AS (SELECT DISTINCT item_id, gram FROM ("
    + _GRAMS.format(key="item_id", text="question", table="gold_items")
    + " UNION ALL "
    + _GRAMS.format(key="item_id", text="gold_answer", table="gold_items")
    + ")), docs AS ("
    + _GRAMS.format(key="doc_id", text="text", table="documents")
    + ") SELECT DISTINCT items.item_id, docs.doc_id FROM items JOIN docs USING (gram)"
)


_P9 = """
counts AS (SELECT doc_id, source, CAST(coalesce(length(text), 0) AS BIGINT) AS tokens FROM documents),
t AS (SELECT source, share, repeats, available FROM (SELECT source, max(target_share) AS share, max(max_repeats) AS repeats FROM mix_targets WHERE target_share > 0 AND max_repeats > 0 GROUP BY 1)
  JOIN (SELECT source, sum(tokens) AS available FROM counts WHERE tokens > 0 GROUP BY 1) USING (source)),
s AS (SELECT min(repeats * available / share::DOUBLE) AS most FROM t),
raw AS (SELECT t.*, least(repeats::DOUBLE, most * share / available) AS r FROM t, s),
rates AS (SELECT source, share, repeats, available, CASE WHEN abs(r - round(r)) < 1e-9 THEN round(r) ELSE r END AS rate FROM raw),
n AS (SELECT doc_id, source, tokens, CAST(floor(rate) AS INTEGER) + CASE WHEN CAST('0x' || left(md5('11:' || doc_id), 13) AS BIGINT) / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM counts JOIN rates USING (source) WHERE tokens > 0),
mixed AS (SELECT doc_id, source, CAST(unnest(generate_series(1, copies)) AS INTEGER) AS copy_no, tokens FROM n WHERE copies > 0)
"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can state the operator's result exactly; the trained operators are tested against held-out accuracy and brute force instead."""
    return {
        "p7_found": _P7,
        "p7_clean_chunks": f"""
WITH bad AS (SELECT chunk_id, list(line_no) AS nos FROM ({_P7}) GROUP BY chunk_id)
SELECT DISTINCT c.chunk_id, c.doc_id, c.chunk_index, CASE WHEN c.text IS NULL THEN NULL ELSE array_to_string(list_filter(string_split(c.text, chr(10)), lambda x, i: NOT list_contains(coalesce(bad.nos, []), i)), chr(10)) END AS clean_text
FROM (SELECT DISTINCT chunk_id, doc_id, chunk_index, text FROM chunks) c LEFT JOIN bad USING (chunk_id)
""",
        "p9_mix_by_length": f"WITH {_P9} SELECT doc_id, source, copy_no, tokens FROM mixed",
        "p9_shares_by_length": f"""
WITH {_P9}, got AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS mixed, count(*) AS copies, max(copy_no) AS most FROM mixed GROUP BY 1)
SELECT source, repeats AS max_repeats, CAST(available AS BIGINT) AS available_tokens, round(rate, 9) AS rate, coalesce(copies, 0) AS copies, coalesce(most, 0) AS most_copies, coalesce(mixed, 0) AS mixed_tokens, round(coalesce(mixed, 0) / (SELECT sum(mixed) FROM got)::DOUBLE, 9) AS actual_share
FROM rates LEFT JOIN got USING (source)""",
        "p8_found": _P8_PAIRS,
        "p8_leak_report": f"SELECT item_id, count(*) AS documents, min(doc_id) AS first_doc_id FROM ({_P8_PAIRS}) GROUP BY item_id",
    }
