"""License scans: an exact set-similarity join of text blocks and license notices, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframes.llm.common import saved, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose places are counted, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices (label, words) that projects put above their sources, in the wording of the licenses' own texts.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Percent of a notice's distinct words that a block holds at least.
CONTAINED = 90


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), lambda w: w != "")


def places(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively, ascending."""
    wanted = phrase.split(" ")
    last = F.size(words) - len(wanted)
    here = lambda i: reduce(and_, [F.get(words, i + j) == w for j, w in enumerate(wanted)])
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def rarest_first(words: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by how often its words stand in all rows of words, then by name. One number a word of the notices reaches the driver."""
    wanted = words.sparkSession.range(1).select(F.explode(F.lit(vocabulary)).alias("word"))
    found = words.select(F.explode("words").alias("word")).join(F.broadcast(wanted), "word").groupBy("word").count()
    counts = {r["word"]: r["count"] for r in found.collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


class Notices:
    """The notices as sets of words in one global order, with the prefix that every match must meet."""

    def __init__(self, notices: tuple[tuple[str, str], ...], percent: int, order: list[str]):
        at = {w: i for i, w in enumerate(order)}
        self.order, self.rows = order, []
        for label, text in notices:
            held = sorted(set(text.split(" ")), key=at.__getitem__)
            self.rows.append((label, held, -(-percent * len(held) // 100)))
        self.least = min(need for _, _, need in self.rows)
        self.firsts = sorted({w for _, held, need in self.rows for w in held[: len(held) - need + 1]})

    def prefixes(self, spark: SparkSession) -> DataFrame:
        """(label, notice, need, place, word): a row for each word of a notice's prefix."""
        rows = [F.struct(F.lit(label).alias("label"), F.lit(held).alias("notice"), F.lit(need).alias("need")) for label, held, need in self.rows]
        each = spark.range(1).select(F.inline(F.array(*rows)))
        return each.select("*", F.posexplode(F.expr("slice(notice, 1, size(notice) - need + 1)")).alias("place", "word"))


def blocks(words: Column, notices: Notices, step: int) -> Column:
    """Blocks of 2 * step words, one every step words, that can hold a notice: where each begins and which words of notices it
    holds, rarest first. Every run of step words lies whole in one of them."""
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - step - 1), F.lit(step))
    order = F.lit(notices.order)
    every = F.transform(starts, lambda s: F.struct(s.alias("first"), F.array_intersect(order, F.slice(words, s + 1, F.lit(2 * step))).alias("held")))
    return F.filter(every, lambda b: (F.size(b["held"]) >= notices.least) & F.arrays_overlap(b["held"], F.lit(notices.firsts)))


def contained(found: DataFrame, notices: Notices) -> DataFrame:
    """(row, first, label, share) for every block of found (row, first, held) and every notice it holds to the needed percent.

    Words that no notice has can't match, so a block is the set of those that some notice has, in the same
    order as the notices. A pair that shares `need` words shares one in both prefixes; it is met once, at its
    first common word. Before the words are intersected, a block that is too small (length), or with too few
    words left behind the common one in either set (position), goes.
    """
    size = F.size("held")
    begun = found.select("row", "first", "held", F.posexplode(F.slice("held", F.lit(1), size - notices.least + 1)).alias("at", "word"))
    met = begun.join(F.broadcast(notices.prefixes(found.sparkSession)), "word")
    met = met.where((size >= F.col("need")) & (F.least(F.size("notice") - F.col("place"), size - F.col("at")) >= F.col("need")))
    both = F.array_intersect("notice", "held")
    met = met.withColumn("both", both).where((F.get("both", 0) == F.col("word")) & (F.size("both") >= F.col("need")))
    return met.select("row", "first", "label", (F.size("both") / F.size("notice")).alias("share"))


def scanned(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, percent: int = CONTAINED) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, n_words, base, candidates) of docs (doc_id, text), and the blocks found in them (row, first, label, share).

    base holds (start, label) of every place of a phrase. A null text is empty; an empty one has no words, no places and no blocks. Each row
    of docs is one row of the result, repeated ids and texts too, under its own number `row`; long texts are blocks like others; other
    columns are not read. An empty table gives empty ones. The vocabulary and the prefixes come from the notices, a declared list, so they
    are as small as that.
    """
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    vocabulary = sorted({w for _, text in notices for w in text.split(" ")})
    known = Notices(notices, percent, rarest_first(words, vocabulary))
    step = max(len(text.split(" ")) for _, text in notices)
    w = F.col("words")
    labelled = lambda starts, name: F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(name).alias("label")))
    base = F.concat(*[labelled(places(w, phrase), name) for phrase, name in PHRASES])
    rows = words.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size(w).cast("long").alias("n_words"), base.alias("base"), blocks(w, known, step).alias("candidates")
    )
    rows = saved(rows, "license-rows")
    return rows, contained(rows.select("row", F.inline("candidates")), known)


def op11_license_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """score: 1 where a phrase stands, else the largest share of a notice that a block holds; 0 without either. No label: an empty string."""
    rows, found = scanned(table(spark, folder, "documents").select("doc_id", "text"))
    by_row = found.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
    base = F.array_sort(F.array_distinct("base.label"))
    every = F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>"))))
    return rows.join(by_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _sql(notices: tuple[tuple[str, str], ...] = NOTICES, percent: int = CONTAINED) -> str:
    """Every block against every notice, without any filter."""
    step = max(len(text.split(" ")) for _, text in notices)
    listed = ", ".join(f"('{label}', list_distinct(string_split('{text}', ' ')))" for label, text in notices)
    starts = " || ".join(
        f"list_transform(list_filter(range(0, len(words) - {p.count(' ')}), lambda i: list_slice(words, i + 1, i + {p.count(' ') + 1}) = string_split('{p}', ' ')), lambda i: {{'s': i, 'label': '{name}'}})"
        for p, name in PHRASES
    )
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
             translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}'), lambda x: x <> '') AS words FROM documents),
n(label, held) AS (VALUES {listed}),
b AS (SELECT r, words, unnest(range(0, greatest(1, len(words) - {step}), {step})) AS first FROM w),
m AS (SELECT r, label, len(list_intersect(held, list_slice(words, first + 1, first + {2 * step}))) AS hits, len(held) AS size FROM b, n),
f AS (SELECT r, list(DISTINCT label) AS found, max(hits / size) AS share FROM m WHERE 100 * hits >= {percent} * size GROUP BY r),
p AS (SELECT r, doc_id, len(words) AS n_words, {starts} AS base FROM w),
q AS (SELECT *, list_sort(list_distinct(list_transform(base, lambda x: x.label))) AS names FROM p)
SELECT doc_id, n_words::BIGINT AS n_words, len(base)::BIGINT AS n_base, list_min(list_transform(base, lambda x: x.s))::BIGINT AS first_word,
       list_max(list_transform(base, lambda x: x.s))::BIGINT AS last_word, coalesce(array_to_string(names, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(names || coalesce(found, []))), ','), '') AS labels,
       CASE WHEN len(base) > 0 THEN 1.0 ELSE coalesce(share, 0) END::DOUBLE AS score
FROM q LEFT JOIN f USING (r)"""


OP11_SQL = _sql()
