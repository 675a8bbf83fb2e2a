"""Scoring of model outputs (E4-E8, T-15, T-16, W16, R15-R17, R21, DS1-DS6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifterra.functions import text as T
from sifterra.operators.metrics import issue_list


def type_score(kind: Column, refused: Column, similarity: Column, recall: Column) -> Column:
    """What counts for each kind: similarity, recall and wrong refusals for grounded items, refusals for refusal items, answers as hallucinations for the rest."""
    no = F.coalesce(refused, F.lit(False))
    return F.struct(
        F.when(kind == "grounded", similarity).alias("chrf"),
        F.when(kind == "grounded", recall).alias("url_recall"),
        F.when(kind == "grounded", no).alias("wrongly_refused"),
        F.when(kind == "refusal", no).alias("correctly_refused"),
        F.when(kind == "ungrounded_attempt", ~no).alias("hallucination"),
    )


def numeric_match(answer: Column, gold: Column, tolerance: float = 1e-6) -> Column:
    """E5: the answer's last number equals the gold number."""
    a, g = T.last_number(answer).try_cast("double"), T.last_number(gold).try_cast("double")
    return F.coalesce(F.abs(a - g) <= tolerance, F.lit(False))


def choice_match(answer: Column, gold: Column) -> Column:
    """E6."""
    return F.coalesce(T.choice_letter(answer) == F.upper(F.trim(gold)), F.lit(False))


def accuracy(df: DataFrame, by: list[str], correct: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.when(correct, 1.0).otherwise(0.0)).alias("accuracy"))


def case_issues(answer: Column, any_of: Column, all_of: Column, none_of: Column) -> Column:
    """Expectations of a case that an answer doesn't meet."""
    low = F.lower(F.coalesce(answer, F.lit("")))
    has = lambda arr: F.exists(arr, lambda w: low.contains(F.lower(w)))
    return issue_list(
        [
            ("missing_any", (F.size(any_of) > 0) & ~has(any_of)),
            ("missing_all", (F.size(all_of) > 0) & ~F.forall(all_of, lambda w: low.contains(F.lower(w)))),
            ("has_forbidden", (F.size(none_of) > 0) & has(none_of)),
            ("loop", T.loops(answer)),
            ("empty", F.trim(low) == ""),
        ]
    )


def repeated_sentences(answer: Column, least_chars: int = 20, least: int = 3) -> Column:
    """T-16: a sentence of ``least_chars`` or more, blanks and case aside, occurs ``least`` times."""
    norm = F.filter(F.transform(T.sentences(answer), lambda s: F.lower(T.squeeze(s))), lambda s: F.length(s) >= least_chars)
    return F.coalesce(T.most_repeats(norm) >= least, F.lit(False))


def single_refusal(answer: Column) -> Column:
    """T-15: refusing sentences after the first are left out."""
    fold = F.aggregate(
        T.sentences(answer),
        F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("seen")),
        lambda a, s: F.when(T.is_refusal(s) & a["seen"], a).otherwise(F.struct(F.concat(a["kept"], F.array(s)).alias("kept"), (a["seen"] | T.is_refusal(s)).alias("seen"))),
    )
    return F.array_join(fold["kept"], " ")


def stop_after_repeats(answer: Column, most: int = 2) -> Column:
    """Sentences up to the ``most``-th one in a row that has occurred before; repeats are left out."""
    fold = F.aggregate(
        T.sentences(answer),
        F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("run")),
        lambda a, s: F.when(a["run"] >= most, a).when(F.array_contains(a["kept"], s), F.struct(a["kept"].alias("kept"), (a["run"] + 1).alias("run"))).otherwise(F.struct(F.concat(a["kept"], F.array(s)).alias("kept"), F.lit(0).alias("run"))),
    )
    return F.array_join(fold["kept"], " ")


def first_hit_rank(results: Column, expected: Column) -> Column:
    """The rank of the first result from an expected host (equal, or below it at a dot); null without one."""
    hit = lambda h: F.exists(expected, lambda e: (h == e) | h.endswith(F.concat(F.lit("."), e)))
    ranked = F.transform(results, lambda h, i: F.when(hit(h), i + 1))
    return F.array_min(F.array_compact(ranked))


def first_answer(*extractors: Column) -> Column:
    """The first extractor that gives something; the extractors are the caller's rules."""
    return F.coalesce(*[F.nullif(F.trim(e), F.lit("")) for e in extractors])


def control_rows(df: DataFrame, answer: str, mark: str) -> DataFrame:
    """DS1: valid answers with every sentence cited."""
    a = T.mark_citations(F.col(answer))
    good = df.where(F.col(answer).isNotNull() & (F.trim(answer) != "") & ~T.is_refusal(F.col(answer)))
    return good.withColumn(answer, T.require_citation(a, F.col(mark)))


def value_lines(facts: Column, most: int = 5) -> Column:
    """DS2: the first lines of facts (array of structs label, value) whose value holds a digit or an address."""
    kept = F.filter(facts, lambda f: f["value"].rlike(r"[0-9०-९]|@|https?://"))
    return F.array_join(F.slice(F.transform(kept, lambda f: F.concat(f["label"], F.lit(": "), f["value"])), 1, most), "\n")


def repair_rows(results: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """DS3, J20: results that refused wrongly, or items without a result, with their gold rows."""
    j = gold.join(results.withColumnRenamed("model_refused", "_refused"), key, "left")
    return j.where((F.col("kind") == "grounded") & (F.coalesce("_refused", F.lit(True)))).withColumn("why", F.when(F.col("_refused").isNull(), "missing").otherwise("wrong_refusal")).drop("_refused")


def hard_negatives(df: DataFrame, kind: str, key: str, n: int, texts: dict[str, str], lang: str, seed: str = "s") -> DataFrame:
    """DS4: n seeded rows of a kind with the text of their language."""
    from sifterra.operators.sampling import sample_n

    table = F.create_map(*[F.lit(x) for p in texts.items() for x in p])
    return sample_n(df.where(F.col("kind") == kind), key, n, seed).withColumn("answer", F.coalesce(F.try_element_at(table, F.col(lang)), F.lit(next(iter(texts.values())))))


def one_or_two(df: DataFrame, first: Column, second: Column, name: str = "row") -> DataFrame:
    """DS5: one training row or two of each record; null ones are left out."""
    return df.withColumn(name, F.explode(F.array_compact(F.array(first, second))))


def weighted_choice(key: Column, options: list[tuple[str, int, Column]], seed: str = "s") -> Column:
    """DS10: one of the options that apply, in proportion to their weights, drawn by the hash of the key."""
    pool = F.flatten(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.array_repeat(F.lit(name), weight)).otherwise(F.array().cast("array<string>")) for name, weight, cond in options]))
    return F.when(F.size(pool) > 0, F.element_at(pool, (F.pmod(F.xxhash64(F.lit(seed), key), F.greatest(F.size(pool), F.lit(1))) + 1).cast("int")))


def longest_name(df: DataFrame, by: str, name: str) -> DataFrame:
    """DS12: the longest name of each key, ties by name."""
    return df.groupBy(by).agg(F.max(F.struct(F.length(name).alias("n"), F.col(name).alias("v"))).alias("m")).select(by, F.col("m.v").alias(name))


def embedded_host(link: Column) -> Column:
    """DS15: the host inside a malformed link."""
    return F.nullif(F.regexp_extract(F.lower(link), r"((?:[a-z0-9-]+\.)+[a-z]{2,})", 1), F.lit(""))
