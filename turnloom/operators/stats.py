"""Statistics over dialogue lines and datasets."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def _named(lines: DataFrame) -> DataFrame:
    return lines.select("chunk_id", F.coalesce("role", F.lit(UNKNOWN)).alias("role"), F.length(F.coalesce("dialogue", F.lit(""))).cast("long").alias("chars"))


def role_counts(lines: DataFrame) -> DataFrame:
    """Rows (role, n_lines); a missing role counts as 'Unknown'."""
    return _named(lines).groupBy("role").agg(F.count("*").alias("n_lines"))


def corpus_stats(lines: DataFrame) -> DataFrame:
    """One row: lines, distinct roles, total characters; 0 for an empty table.

    Built on the role counts, so that one shuffle of a row for each role and task gives all three.
    """
    per = _named(lines).groupBy("role").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    zero = F.lit(0).cast("long")
    return per.agg(F.coalesce(F.sum("n"), zero).alias("total_dialogues"), F.count("*").alias("unique_roles"), F.coalesce(F.sum("chars"), zero).alias("total_chars"))


def corpus_report(lines: DataFrame) -> dict[str, Any]:
    """The same as a dictionary with the role distribution and the mean length."""
    total = corpus_stats(lines).first()
    roles = {r.role: r.n_lines for r in role_counts(lines).orderBy(F.desc("n_lines"), "role").collect()}
    return {"total_dialogues": total.total_dialogues, "unique_roles": total.unique_roles, "role_distribution": roles, "average_dialogue_length": total.total_chars / total.total_dialogues if total.total_dialogues else 0}


def chunk_role_counts(lines: DataFrame) -> DataFrame:
    """Rows (chunk_id, role, n_lines, chars); lines without a chunk are left out."""
    return _named(lines).where("chunk_id IS NOT NULL").groupBy("chunk_id", "role").agg(F.count("*").alias("n_lines"), F.sum("chars").alias("chars"))


def chunk_stats(lines: DataFrame) -> DataFrame:
    """Rows (chunk_id, dialogue_count, n_roles, total_length, roles map)."""
    per = chunk_role_counts(lines)
    return per.groupBy("chunk_id").agg(
        F.sum("n_lines").alias("dialogue_count"), F.count("*").alias("n_roles"), F.sum("chars").alias("total_length"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "n_lines")))).alias("roles")
    )


def chunk_summary(lines: DataFrame) -> DataFrame:
    """One row: chunks and their lines; 0 for an empty table."""
    per = lines.where("chunk_id IS NOT NULL").groupBy("chunk_id").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("total_chunks"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_dialogues"))


def busiest_chunks(lines: DataFrame, k: int = 5) -> DataFrame:
    """The k chunks of most lines; of equals the smaller id."""
    per = lines.where("chunk_id IS NOT NULL").groupBy("chunk_id").agg(F.count("*").alias("dialogue_count"))
    return per.orderBy(F.desc("dialogue_count"), "chunk_id").limit(k)


def top_roles(lines: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent roles; of equals the first by name."""
    return role_counts(lines).orderBy(F.desc("n_lines"), "role").limit(k)


def effective_batch_size(per_device: int, accumulation: int, devices: int = 1) -> int:
    return per_device * accumulation * devices
