"""Cases from questions: slots by alias rules, missing slots, the next step, its follow-up questions, contact roles (R19, R20, T-25, R6, R7)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifterra.functions.script import DEVANAGARI, fold_digits

MOST_RULES = 5_000


def alias_points(alias: str) -> int:
    """What an alias says when it is met: 4 for several words, 1 to 4 by length in Devanagari, 2 for a word of five letters or more, else 1."""
    if " " in alias:
        return 4
    if re.search(DEVANAGARI, alias):
        return max(1, min(4, len(alias) // 2))
    return 2 if len(alias) >= 5 else 1


def resolve_slots(items: DataFrame, key: str, text: Column, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``key, slots``: a map of each slot to the value whose aliases score highest, ties by the order of the rules (slot, value, alias).

    Aliases in Devanagari or of several words are looked for anywhere, others as whole words. Rules are the caller's, ``MOST_RULES`` at
    most (more raise an error), and are folded into one expression, so texts meet no join. Items without any hit have an empty map.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    low = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "), F.lit(" "))
    hits = []
    for order, (slot, value, alias) in enumerate(rules):
        a = re.sub(r"[^\w\u0900-\u097f]+", " ", alias.lower()).strip()
        loose = " " in a or re.search(DEVANAGARI, a)
        hits.append(F.when(low.contains(a if loose else f" {a} "), F.struct(F.lit(slot).alias("slot"), F.lit(value).alias("value"), F.lit(alias_points(a)).alias("points"), F.lit(-order).alias("order"))))
    found = items.select(key, F.explode_outer(F.array_compact(F.array(*hits))).alias("h"))
    by_value = found.groupBy(key, "h.slot", "h.value").agg(F.sum("h.points").alias("points"), F.max("h.order").alias("order"))
    best = by_value.groupBy(key, "slot").agg(F.max_by("value", F.struct("points", "order")).alias("value"))
    entries = F.array_sort(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "value"))))
    return best.groupBy(key).agg(F.map_from_entries(entries).alias("slots"))


def missing_slots(slots: Column, required: list[tuple[str | None, str | None, list[str]]]) -> Column:
    """Slots that a case lacks, by rules (service, action, wanted slots); None fits any. Each once, in order."""
    lacks = []
    for service, action, wanted in required:
        applies = F.lit(True)
        for slot, value in (("service", service), ("action", action)):
            if value is not None:
                applies = applies & (F.try_element_at(slots, F.lit(slot)).eqNullSafe(F.lit(value)))
        lacks += [F.when(applies & ~F.coalesce(F.map_contains_key(slots, w), F.lit(False)), F.lit(w)) for w in wanted]
    return F.array_distinct(F.array_compact(F.array(*lacks)))


def planner_decision(off_domain: Column, memory_only: Column, missing: Column, action: Column) -> Column:
    """The next step; the first that holds."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(off_domain), "off_domain_light_answer")
        .when(yes(memory_only), "ack_memory")
        .when(F.coalesce(F.size(missing), F.lit(0)) > 0, "partial_answer_plus_followup")
        .when(action == "complaint", "complaint_handoff_or_retrieve")
        .when(action == "contact", "contact_handoff_or_retrieve")
        .otherwise("retrieve_then_answer")
    )


def follow_ups(missing: Column, language: Column, questions: dict[str, dict[str, str]], default: str = "english") -> Column:
    """A question for each missing slot that has one, in the case's language or the default one, each once."""
    table = F.create_map(*[F.lit(x) for slot, by in questions.items() for lang, q in by.items() for x in (f"{slot}@{lang}", q)])
    ask = lambda slot: F.coalesce(F.try_element_at(table, F.concat(slot, F.lit("@"), F.coalesce(language, F.lit(default)))), F.try_element_at(table, F.concat(slot, F.lit(f"@{default}"))))
    return F.array_distinct(F.array_compact(F.transform(missing, ask)))


def contract(slots: Column, language: Column, off_domain: Column, memory_only: Column, required: list[tuple[str | None, str | None, list[str]]], questions: dict[str, dict[str, str]]) -> Column:
    """Struct of decision, service, action, place, missing slots and follow-up questions."""
    lacks = missing_slots(slots, required)
    slot = lambda name: F.try_element_at(slots, F.lit(name))
    return F.struct(
        planner_decision(off_domain, memory_only, lacks, slot("action")).alias("decision"), language.alias("language"), slot("service").alias("service"), slot("action").alias("action"),
        F.struct(slot("district").alias("district"), slot("municipality").alias("municipality"), slot("ward").alias("ward")).alias("location"), lacks.alias("missing_slots"), follow_ups(lacks, language, questions).alias("followup_questions"),
    )


def context_window(text: Column, needle: Column, chars: int = 180) -> Column:
    """T-25: the text around a number or address, half of ``chars`` on each side; digits of either script match. Its beginning where the needle is absent."""
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " ")
    at = F.instr(fold_digits(flat), fold_digits(needle))
    around = F.substring(flat, F.greatest(at - chars // 2, F.lit(1)), F.length(needle) + chars - F.greatest(F.lit(0), F.lit(chars // 2 + 1) - at))
    return F.trim(F.when(F.coalesce(at, F.lit(0)) > 0, around).otherwise(F.substring(flat, 1, chars)))


def role_from_context(context: Column, roles: list[tuple[str, list[str]]]) -> Column:
    """T-25: the first role, in order, of which the context holds a mark."""
    low = F.lower(F.coalesce(context, F.lit("")))
    out = F.lit(None).cast("string")
    for role, marks in reversed(roles):
        out = F.when(low.rlike("|".join(re.escape(m.lower()) for m in marks)), role).otherwise(out)
    return out


def name_from_context(context: Column, no_names: list[str]) -> Column:
    """T-25: two to five capitalised Latin words in a row that are no label, else two to five Devanagari words in a row."""
    flat = F.trim(F.regexp_replace(F.coalesce(context, F.lit("")), r"(?U)\s+", " "))
    latin = F.nullif(F.regexp_extract(flat, r"\b([A-Z][a-z]+(?:\s[A-Z][a-z]+){1,4})\b", 1), F.lit(""))
    deva = F.nullif(F.regexp_extract(flat, "([\u0900-\u097f]{2,}(?: [\u0900-\u097f]{2,}){1,4})", 1), F.lit(""))
    return F.coalesce(F.when(~F.lower(latin).isin([x.lower() for x in no_names] or [""]), latin), deva)
