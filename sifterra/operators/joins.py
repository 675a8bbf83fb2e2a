"""Joins beyond plain equality (J10-J22): positional, prefix, containment and alias matches, each turned into equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sifterra.session import broadcast_if_small


def last_write(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by a unique order; by max_by, so a repeated key is combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_write(df: DataFrame, key: str, order: str) -> DataFrame:
    """W5, DS9, X7: the first row of each key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def element_join(df: DataFrame, refs: str, items: str, rank: str, value: str, out: str) -> DataFrame:
    """Each reference number of an array column picks the item of that rank in another array column, else the one at that place."""
    by_rank = lambda r: F.try_element_at(F.filter(F.col(items), lambda x: x[rank] == r), F.lit(1))[value]
    by_place = lambda r: F.try_element_at(F.col(items), r)[value]
    return df.withColumn(out, F.transform(refs, lambda r: F.coalesce(by_rank(r), by_place(r))))


def prefix_repair(urls: DataFrame, url: str, known: DataFrame, known_url: str, least: int = 12) -> DataFrame:
    """Adds ``repaired``: the known address that a cut-off one begins, only if exactly one fits; exact matches stay.

    Known addresses are keyed by their first ``least`` characters, so the prefix match is an equi-join with a
    filter, and matches are counted by aggregation before the one survivor is taken. Shorter cut-offs stay null.
    """
    k = known.select(F.col(known_url).alias("_k")).where("_k is not null").distinct().withColumn("_p", F.substring("_k", 1, least))
    u = urls.select(url).where(F.col(url).isNotNull()).distinct().withColumn("_p", F.substring(url, 1, least))
    exact = u.join(k, F.col(url) == F.col("_k"), "left_semi").select(url, F.col(url).alias("repaired"))
    cut = u.join(k.select(F.col("_k").alias("_x")), F.col(url) == F.col("_x"), "left_anti").where(F.length(url) >= least)
    found = cut.join(k, "_p").where(F.col("_k").startswith(F.col(url))).groupBy(url).agg(F.count("*").alias("_n"), F.min("_k").alias("repaired")).where("_n = 1").select(url, "repaired")
    return urls.join(exact.unionByName(found), url, "left")


def alias_match(texts: DataFrame, key: str, text: Column, aliases: DataFrame, alias: str, target: str) -> DataFrame:
    """Per text the target of its longest alias, ties by name. Word n-grams of the lengths that aliases have are joined, so no text meets every alias."""
    a = aliases.select(F.filter(F.split(F.lower(alias), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "").alias("_w"), F.col(target).alias("_t")).where("size(_w) > 0").select(F.array_join("_w", " ").alias("_a"), F.size("_w").alias("_n"), "_t").distinct()
    lengths = sorted(r[0] for r in a.select("_n").distinct().collect())  # as many as different lengths
    toks = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")
    grams = F.flatten(F.transform(F.array(*[F.lit(n) for n in lengths or [1]]), lambda n: F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.size(toks), F.lit(1))), lambda i: i + n - 1 <= F.size(toks)), lambda i: F.array_join(F.slice(toks, i, n), " "))))
    t = texts.select(key, F.explode(F.array_distinct(grams)).alias("_a"))
    return t.join(broadcast_if_small(a.drop("_n")), "_a").groupBy(key).agg(F.max(F.struct(F.length("_a").alias("n"), F.col("_t").alias("t"))).alias("m")).select(key, F.col("m.t").alias(target))


def zip_files(left: DataFrame, right: DataFrame, order: str) -> DataFrame:
    """Rows of parallel tables side by side by their line number."""
    return left.join(right, order)


def location_filter(df: DataFrame, place: Column, wanted: Column, federal: Column) -> DataFrame:
    """federal rows stay; local rows only where their place is wanted; all stay where none is."""
    return df.where(federal | wanted.isNull() | (F.size(wanted) == 0) | F.array_contains(wanted, place))


def expand_templates(templates: DataFrame, template: str, entities: DataFrame, entity: str, slot: str = "{}", most: int = 10_000) -> DataFrame:
    """DS7: every template filled with every entity: the templates, ``most`` at most (more raise an error), are one literal array that each entity explodes."""
    rows = templates.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} templates")
    kinds = templates.schema
    each = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in kinds]) for r in rows]) if rows else F.array().cast(f"array<{kinds.simpleString()}>")
    d = entities.withColumn("_t", F.explode(each)).select(*[F.col(f"_t.{f.name}").alias(f.name) for f in kinds], *entities.columns)
    return d.withColumn("filled", F.replace(F.col(template), F.lit(slot), F.col(entity)))


def expand_terms(queries: DataFrame, key: str, terms: str, synonyms: DataFrame) -> DataFrame:
    """T-7: a query's terms with their synonyms (``term, extra``), distinct, the query's own first."""
    t = queries.select(key, F.posexplode(terms).alias("pos", "term"))
    extra = t.join(broadcast_if_small(synonyms), "term").select(key, (F.col("pos") + 1000).alias("pos"), F.col("extra").alias("term"))
    first = t.select(key, "pos", "term").unionByName(extra).groupBy(key, "term").agg(F.min("pos").alias("pos"))
    return first.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "term"))).alias("x")).select(key, F.transform("x", lambda v: v["term"]).alias("expanded"))


def first_available(prefs: DataFrame, key: str, prefs_col: str, available: DataFrame, name: str) -> DataFrame:
    """DS14: the first entry of an ordered preference array that is available."""
    p = prefs.select(key, F.posexplode(prefs_col).alias("pos", name)).join(broadcast_if_small(available.select(name).distinct()), name)
    return p.groupBy(key).agg(F.min_by(name, "pos").alias(name))


def numbered_sources(claims: DataFrame, documents: DataFrame, key: str, order: str, ref: str = "S") -> DataFrame:
    """Claims first, then documents, with references S1 to Sn per query."""
    both = claims.withColumn("_kind", F.lit(0)).unionByName(documents.withColumn("_kind", F.lit(1)))
    n = F.row_number().over(Window.partitionBy(key).orderBy("_kind", order))
    return both.withColumn("source_ref", F.concat(F.lit(ref), n.cast("string"))).drop("_kind")
