"""Caps and train/validation splits with exact counts."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialize
from .lines import number_rows

#: Rows that the exact mode permutes on the driver at most.
EXACT_ROWS = 5_000_000
#: Leading hex digits of the rank key that make a bucket of the selection.
PREFIX = 4


def rank_key(id_col: str, seed: int) -> Column:
    """A reproducible random order: the MD5 of seed and id, then the id."""
    return F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string")))


class Ranks:
    """Counts of a table's rows by rank; the condition that holds for the n rows of lowest rank.

    Counts of at most 16**PREFIX buckets come to the driver; only the bucket that holds the border
    is sorted. The result is a plain filter: no global sort, no single task, no join.
    """

    def __init__(self, rows: DataFrame, id_col: str, seed: int):
        self.key, self.id = rank_key(id_col, seed), F.col(id_col).cast("string")
        self.ranked = rows.select(self.key.alias("k"), self.id.alias("i"))
        self.counts = sorted((r[0] or "", r[1]) for r in self.ranked.groupBy(F.substring("k", 1, PREFIX)).count().collect())
        self.total = sum(n for _, n in self.counts)

    def first(self, n: int) -> Column:
        if n <= 0:
            return F.lit(False)
        before = 0
        for prefix, count in self.counts:
            if before + count >= n:
                edge = self.ranked.where(F.coalesce("k", F.lit("")).startswith(prefix) if prefix else F.col("k").isNull()).orderBy("k", "i").limit(n - before).agg(F.max(F.struct("k", "i"))).first()[0]
                return F.struct(self.key.alias("k"), self.id.alias("i")) <= F.struct(F.lit(edge[0]).cast("string").alias("k"), F.lit(edge[1]).cast("string").alias("i"))
            before += count
        return F.lit(True)


def cap_rows(df: DataFrame, most: int, id_col: str = "id", seed: int = 42) -> DataFrame:
    """A reproducible choice of ``most`` rows; all of them if 0 or if there are no more.

    The rows are written once, so that what made them runs once; their number comes with the counts.
    """
    if most <= 0:
        return df
    rows = materialize(df, "cap")
    ranks = Ranks(rows, id_col, seed)
    return rows if ranks.total <= most else rows.where(ranks.first(most))


def valid_count(n: int, ratio: float) -> int:
    return max(1, int(n * ratio)) if n else 0


def split_rows(df: DataFrame, ratio: float = 0.05, id_col: str = "id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, valid) with exactly max(1, int(n * ratio)) rows in valid; ids should be unique.

    One row goes to valid and leaves train empty; an empty table gives two empty ones. The rows are
    written once, so that what made them runs once for both parts.
    """
    train, valid, _ = cap_and_split(df, 0, ratio, id_col, seed)
    return train, valid


def cap_and_split(df: DataFrame, most: int, ratio: float = 0.05, id_col: str = "id", seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, valid, both) of ``cap_rows`` and ``split_rows``, from one writing and one count."""
    rows = materialize(df, "split")
    ranks = Ranks(rows, id_col, seed)
    n = min(ranks.total, most) if most > 0 else ranks.total
    chosen = ranks.first(valid_count(n, ratio))
    kept = rows if n == ranks.total else rows.where(ranks.first(n))
    return kept.where(~chosen), kept.where(chosen), kept


def shuffled_positions(n: int, seed: int) -> list[int]:
    """For each row of n its place after a seeded Mersenne Twister shuffle."""
    order = list(range(n))
    random.Random(seed).shuffle(order)
    place = [0] * n
    for at, row in enumerate(order):
        place[row] = at
    return place


def split_rows_exact(df: DataFrame, ratio: float, order: str, *, most: int = 0, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Cap and split by the same permutations as ``random.Random(seed).shuffle`` of the rows in
    ``order``. Bounded by EXACT_ROWS, since a permutation is made on the driver."""
    df = materialize(df, "exact")
    spark, n = df.sparkSession, df.count()
    if n > EXACT_ROWS:
        raise ValueError(f"{n} rows are too many for an exact permutation; use split_rows")

    def placed(rows: DataFrame, count: int) -> DataFrame:
        table = spark.createDataFrame(list(enumerate(shuffled_positions(count, seed))), "pos long, place long")
        return rows.join(table, "pos").drop("pos").withColumnRenamed("place", "pos")

    rows = number_rows(df, order)
    if 0 < most < n:
        rows, n = placed(rows, n).where(F.col("pos") < most), most
    rows = placed(rows, n)
    k = valid_count(n, ratio)
    return rows.where(F.col("pos") >= k).drop("pos"), rows.where(F.col("pos") < k).drop("pos")


def first_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first n rows in the given order; 0 means all."""
    return df.orderBy(order).limit(n) if n > 0 else df


def newest(df: DataFrame, number: Column) -> DataFrame:
    """The row of the largest number, such as the last checkpoint."""
    return df.agg(F.max_by(F.struct(*df.columns), number).alias("r")).where("r IS NOT NULL").select("r.*")
