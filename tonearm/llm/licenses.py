"""License scan: ordered signature rules behind a keyword prefilter, as DataFrame expressions.

A text becomes its words joined by single spaces. Keywords that occur in it choose the
rules that run. A match's start and end are marked in the text, so the positions of all
matches come from one split. Matches inside another of the same or a higher priority are
suppressed; of equal ones the first rule's stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import lower_ascii, whole
from tonearm.llm.license_rules import BASE_PHRASES, Rule, rules

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
START, END = "\x01", "\x02"
PRIORITIES = 4
BASE_CONFIDENCE = 0.4


def joined_words(text: Column) -> Column:
    """The words, each between single spaces; one space if there are none."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_ascii(text), F.lit(" ")), NOT_WORD, " ")


def spans(words: Column, regex: Column) -> Column:
    """(first word, word after the last) of every match; a regex runs from its space to the next."""
    marked = F.split(F.regexp_replace(words, regex, F.lit(f" {START}$1{END}")), " ")
    found = F.transform(
        marked,
        lambda w, i: F.struct(
            F.when(F.startswith(w, F.lit(START)), i - 1).otherwise(-1).alias("start"),
            F.when(F.endswith(w, F.lit(END)), i).otherwise(-1).alias("end"),
        ),
    )
    starts = F.transform(F.filter(found, lambda f: f["start"] >= 0), lambda f: f["start"])
    ends = F.transform(F.filter(found, lambda f: f["end"] >= 0), lambda f: f["end"])
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end")))


def bounded(regex: str) -> str:
    return f" ({regex})(?= )"


def _literal(found: list[Rule]) -> Column:
    return F.array(*(
        F.struct(
            F.lit(i).alias("turn"), F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"),
            F.lit(r.keyword).alias("keyword"), F.lit(bounded(r.regex)).alias("regex"), F.lit(r.confidence).alias("confidence"),
        )
        for i, r in enumerate(found)
    ))


def _survivors(detections: Column) -> Column:
    """Labels and highest confidence of what no earlier match of the same or a higher priority contains.

    In order of start, longer first, higher priority first, any containing match comes
    before the contained; the furthest end so far of each priority or above decides."""
    nothing = F.struct(
        F.array(*[F.lit(-1)] * PRIORITIES).alias("ends"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("confidence"),
    )

    def step(kept: Column, d: Column) -> Column:
        ends = F.transform(
            kept["ends"], lambda e, p: F.when((p <= d["priority"]) & (e < d["end"]), d["end"]).otherwise(e)
        )
        more = F.struct(
            ends.alias("ends"),
            F.array_union(kept["labels"], F.array(d["label"])).alias("labels"),
            F.greatest(kept["confidence"], d["confidence"]).alias("confidence"),
        )
        return F.when(F.get(kept["ends"], d["priority"]) >= d["end"], kept).otherwise(more)

    return F.aggregate(detections, nothing, step)


def scan_licenses(docs: DataFrame, found: list[Rule] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no labels. Every row stands for itself, so
    repeated rows give repeated results; nothing is shuffled.
    """
    found = rules() if found is None else found
    keywords = sorted({r.keyword for r in found})
    rows = docs.select("doc_id", joined_words(whole()).alias("words"))
    words = F.col("words")
    rows = rows.withColumn("n_words", (F.length("words") - F.length(F.replace(words, F.lit(" "))) - 1).cast("long"))
    rows = rows.withColumn("present", F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(words, k)))

    none = F.array().cast("array<struct<start:int,end:int>>")
    places = {label: spans(words, F.lit(bounded(phrase))) for phrase, label in BASE_PHRASES.items()}
    hit = {label: F.contains(words, F.lit(f" {phrase} ")) for phrase, label in BASE_PHRASES.items()}
    rows = rows.withColumns({f"at_{label}": F.when(hit[label], at).otherwise(none) for label, at in places.items()})

    active = F.filter(_literal(found), lambda r: F.array_contains(F.col("present"), r["keyword"]))
    detections = F.flatten(F.transform(active, lambda r: F.transform(
        spans(words, r["regex"]),
        lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("minus_end"), (-r["priority"]).alias("minus_priority"), r["turn"].alias("turn"),
            s["end"].alias("end"), r["priority"].alias("priority"), r["label"].alias("label"), r["confidence"].alias("confidence"),
        ),
    )))
    nothing = F.lit(None).cast("struct<ends:array<int>,labels:array<string>,confidence:double>")
    rows = rows.withColumn("kept", F.when(F.size("present") > 0, _survivors(F.sort_array(detections))).otherwise(nothing))

    labels = sorted(BASE_PHRASES.values())
    starts = F.transform(F.concat(*(F.col(f"`at_{x}`") for x in labels)), lambda s: s["start"])
    base = F.filter(F.array(*(F.when(F.size(F.col(f"`at_{x}`")) > 0, F.lit(x)) for x in labels)), lambda x: x.isNotNull())
    rows = rows.select("doc_id", "n_words", "kept", starts.alias("starts"), base.alias("base"))
    of_rules = F.coalesce(F.col("kept.labels"), F.array().cast("array<string>"))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", of_rules)), ",").alias("labels"),
        F.greatest(
            F.coalesce(F.col("kept.confidence"), F.lit(0.0)), F.when(F.size("base") > 0, BASE_CONFIDENCE).otherwise(0.0)
        ).alias("score"),
    )
