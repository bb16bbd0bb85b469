"""Filters, projections, dedup, ordering and resume over dialogue lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialize

#: Ids that a filter takes as literals; longer lists become a semi join.
LITERAL_IDS = 1000


def filter_chunks(lines: DataFrame, chunk_ids: list[int | None]) -> DataFrame:
    """Lines of the given chunks; None selects lines without a chunk id."""
    named = sorted({c for c in chunk_ids if c is not None})
    if len(named) > LITERAL_IDS:
        wanted = lines.sparkSession.createDataFrame([(c,) for c in named], "chunk_id long")
        found = lines.join(wanted, "chunk_id", "left_semi")
        return found.unionByName(lines.where("chunk_id IS NULL")) if None in chunk_ids else found
    test = F.col("chunk_id").isin(*named) if named else F.lit(False)
    return lines.where(test | F.col("chunk_id").isNull() if None in chunk_ids else test)


def legacy_lines(lines: DataFrame) -> DataFrame:
    """The two old columns; missing ones count as empty."""
    return lines.select(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("dialogue", F.lit("")).alias("dialogue"))


def nonempty_lines(lines: DataFrame) -> DataFrame:
    return lines.where((F.length("role") > 0) & (F.length("dialogue") > 0))


def sort_lines(lines: DataFrame) -> DataFrame:
    """By chunk and position, missing ones as 0; ``ord`` or else the texts break ties."""
    ties = ["ord"] if "ord" in lines.columns else ["role", "dialogue"]
    return lines.orderBy(F.coalesce("chunk_id", F.lit(0)), F.coalesce("dialogue_index", F.lit(0)), *ties)


def dedup_lines(lines: DataFrame, index: str = "raw") -> DataFrame:
    """The first line of each exact (role, dialogue), by chunk and position, over all chunks.

    Case counts. The first is found by an aggregate that is summed on the map side, so a line
    that is said a billion times moves once from each task. ``index`` 'raw' keeps positions with
    their gaps, 'dense' numbers the survivors of each chunk from 0.
    """
    if index not in ("raw", "dense"):
        raise ValueError("index is 'raw' or 'dense'")
    rest = [c for c in lines.columns if c not in ("chunk_id", "dialogue_index", "role", "dialogue")]
    first = F.min(F.struct("chunk_id", "dialogue_index", *rest)).alias("first")
    kept = lines.groupBy("role", "dialogue").agg(first).select("first.*", "role", "dialogue").select(*lines.columns)
    if index == "dense":
        place = F.row_number().over(Window.partitionBy("chunk_id").orderBy("dialogue_index", "role", "dialogue")) - 1
        kept = kept.withColumn("dialogue_index", place.cast("long"))
    return kept


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key has no record yet; null keys are always pending."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def reused(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Existing records of the current items; records of other items are dropped."""
    return done.join(items.select(key).distinct(), key, "left_semi")


def merge_results(kept: DataFrame, new: DataFrame) -> DataFrame:
    return kept.unionByName(new, allowMissingColumns=True)


def match_entries(batch: DataFrame, entries: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Batch items with their entry, and the items without one, which are asked for again."""
    return batch.join(entries, key, "inner"), batch.join(entries.select(key), key, "left_anti")


def canonical_role(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Adds ``canonical`` from rows (alias, canonical); a role without one is its own."""
    return lines.join(names, lines["role"] == names["alias"], "left").drop("alias").withColumn("canonical", F.coalesce("canonical", "role"))


def assign_batches(items: DataFrame, size: int, order: str) -> DataFrame:
    """Adds ``pos``, the place in the given order from 0, and ``batch``, each of ``size`` places.

    Places come from a range exchange and prefix sums over its partitions, so no task sees all rows.
    """
    return number_rows(items, order).withColumn("batch", F.floor(F.col("pos") / size))


def number_rows(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """Adds ``pos``, or another name: 0, 1, ... in the order of the given columns, which should be unique.

    Ranges of the order are numbered inside their partitions; one count for each partition comes
    to the driver and gives the bases.
    """
    if not order:
        raise ValueError("an order is needed")
    # monotonically_increasing_id is the partition number times 2^33 plus the place in it; written
    # once, because another run may draw the ranges elsewhere
    ranged = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.expr("shiftright(_id, 33)")
    counts = sorted((r[0], r[1]) for r in ranged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    bases, total = [], 0
    for p, n in counts:
        bases.append((p, total))
        total += n
    table = F.broadcast(df.sparkSession.createDataFrame(bases, "_p long, _base long"))
    placed = ranged.join(table, part == F.col("_p"))
    return placed.withColumn(name, F.col("_base") + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id", "_p", "_base")
