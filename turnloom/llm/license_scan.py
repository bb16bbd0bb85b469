"""License scans by diagonal voting, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of a k-gram.
K = 3
#: Diagonals of one template that lie at most so far apart are one passage with words put in or left out.
DRIFT = 3
#: Share of a template's words that a merged passage must cover.
COVER = 0.8
#: Templates of fewer words count only in full: each of their words can be the one that matters.
SHORT = 10
#: Places of a template that one bit mask holds.
MASK = 62
#: Template k-grams that are broadcast at most; more are joined by shuffle.
BROADCAST_GRAMS = 200_000

#: Words: characters that are digits, letters a-z after lower-casing, or not ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False  # counted only where all its words stand consecutively
    key: str = ""  # words of the text that must stand consecutively, whatever else is changed


# Phrases and well-known sentences of public licenses.
TEMPLATES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", key="gnu general public license"),
    Template("lgpl", "lesser general public license"),
    Template("agpl", "affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by", "creative commons attribution license"),
    Template("cc0", "creative commons zero"),
    Template("public-domain", "into the public domain"),
    Template("all-rights-reserved", "all rights reserved"),
)


def words(text: Column) -> Column:
    """Lower-cased words. Letters outside ASCII are lower-cased too; the Kelvin sign, the only one of
    them that would become an ASCII letter, is replaced by another letter first."""
    plain = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "K", "ĸ"))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def template_grams(spark: SparkSession, templates: tuple[Template, ...], k: int = K) -> DataFrame:
    """Rows (gram, template, place) of every k-gram of every template, hashed."""
    rows = F.inline(F.array(*[F.struct(F.lit(i).alias("template"), F.lit(t.text).alias("text")) for i, t in enumerate(templates)]))
    at = spark.range(1, numPartitions=1).select(rows).select("template", words(F.col("text")).alias("w"))
    return _grams(at, ["template"], k).where("gram IS NOT NULL").select("gram", "template", F.col("i").alias("place"))


def _grams(df: DataFrame, keep: list[str], k: int) -> DataFrame:
    """One row per word of ``w`` with the hash of the k words from there, null near the end."""
    at = df.select("*", F.posexplode_outer("w").alias("i", "first"))
    rest = [F.get("w", F.col("i") + j) for j in range(1, k)]
    gram = F.when(rest[-1].isNotNull(), F.xxhash64("first", *rest))
    return at.select(*keep, "i", gram.alias("gram"))


def _key_places(template: Template, k: int) -> Column:
    """Places of the k-grams of a template's key."""
    own, key = template.text.split(), template.key.split()
    first = next((i for i in range(len(own)) if own[i : i + len(key)] == key), None)
    if first is None or 0 < len(key) < k:
        raise ValueError(f"the key of a template needs {k} words that stand in it: {template.key}")
    return F.array(*[F.lit(first + i) for i in range(len(key) - k + 1)]).cast("array<int>")


def scan_licenses(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, k: int = K, drift: int = DRIFT, cover: float = COVER) -> DataFrame:
    """Per row of ``df``: id, ``n_words`` and ``spans``.

    Every rolling k-gram of every text is joined with the k-grams of the templates. A match votes
    for a template and a diagonal, place in the text minus place in the template; the places that
    vote are gathered as bits per text, template and diagonal before they are shuffled. Neighbouring
    diagonals are merged, and a merged passage is a span where the distinct template words in its
    k-grams are enough of the template, the words of its key among them in a row. Of base templates
    and those of fewer than ``SHORT`` words, all words must stand on one diagonal. A span is
    (template, label, base, start, words, score) with the score the covered share; ``words`` is the
    template's length.

    Null texts count as empty and have no spans; long texts are read whole; rows with equal or null
    ids are told apart. Where several spans begin at one place all are given. An empty table gives
    an empty one; other columns are not read, whatever their names. Only matches and one narrow row
    per text are shuffled. Templates of fewer than ``k`` words are refused.
    """
    spark = df.sparkSession
    sizes = [len(t.text.split()) for t in templates]
    if min(sizes) < k:
        raise ValueError(f"templates need at least {k} words")
    grams = template_grams(spark, templates, k)
    if sum(sizes) <= BROADCAST_GRAMS:
        grams = F.broadcast(grams)
    rows = df.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), words(F.col(text_col).cast("string")).alias("w")).withColumn("n_words", F.size("w").cast("long"))
    votes = (
        _grams(rows, ["id", "row", "n_words"], k)
        .join(grams, "gram", "left")
        .groupBy("id", "row", "n_words", "template", (F.col("i") - F.col("place")).alias("diagonal"), F.floor(F.col("place") / MASK).cast("int").alias("part"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, place % {MASK})")).alias("bits"), F.min("i").alias("at"))
    )
    # templates that count in full keep their diagonals apart; of the others, near ones are one passage
    apart = F.array(*[F.lit(0 if t.base or n < SHORT else drift) for t, n in zip(templates, sizes, strict=True)])
    lane = Window.partitionBy("id", "row", "n_words", "template").orderBy("diagonal")
    parts = votes.withColumn("new", F.when(F.col("diagonal") - F.lag("diagonal").over(lane) > F.get(apart, "template"), 1).otherwise(0))
    passages = (
        parts.withColumn("passage", F.sum("new").over(lane))
        .groupBy("id", "row", "n_words", "template", "passage")
        .agg(F.min("at").alias("at"), F.collect_list(F.struct("part", "bits")).alias("masks"))
    )
    places = F.expr(f"array_distinct(flatten(transform(masks, m -> transform(filter(sequence(0, {MASK - 1}), b -> shiftright(m.bits, b) & 1 = 1), b -> m.part * {MASK} + b))))")
    passages = passages.withColumn("places", F.when(F.col("template").isNotNull(), places))
    facts = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(n).alias("size"), F.lit(1.0 if t.base or n < SHORT else cover).alias("least"), _key_places(t, k).alias("key")) for t, n in zip(templates, sizes, strict=True)])
    fact = F.get(facts, "template")
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (k - 1))))))
    score = covered / fact["size"]
    start = F.col("at").cast("long")
    span = F.struct("template", fact["label"].alias("label"), fact["base"].alias("base"), start.alias("start"), fact["size"].alias("words"), score.alias("score"))
    keyed = F.size(F.array_except(fact["key"], F.col("places"))) == 0
    verified = F.when(F.col("template").isNotNull() & (score >= fact["least"]) & keyed, span)
    return passages.groupBy("id", "row", "n_words").agg(F.array_sort(F.collect_list(verified)).alias("spans")).select(F.col("id").alias(id_col), "n_words", "spans")
