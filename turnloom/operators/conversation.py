"""Dialogue lines to alternating turns and nested samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip


@dataclass(frozen=True)
class Dialect:
    """How turns and ids are written; the defaults are the pipeline's, ``SCRIPT`` the tool's."""

    speaker_sep: str = ": "
    id_sep: str = "_"
    always_title: bool = True  # the system sentence keeps its title phrase without a title


PIPELINE = Dialect()
SCRIPT = Dialect("：", "-", always_title=False)
DIALECTS = {"pipeline": PIPELINE, "script": SCRIPT}


def parse_aliases(text: str) -> list[str]:
    """Names parted by ASCII commas, trimmed, empty ones dropped; the first is the canonical one."""
    names = [n.strip() for n in text.split(",") if n.strip()]
    if not names:
        raise ValueError("no target role is named")
    return names


def _prepared(lines: DataFrame, aliases: list[str], dialect: Dialect) -> DataFrame:
    """Lines with position, side and piece. ``ord`` breaks ties if the table has it."""
    target = F.coalesce(F.col("role").isin(*aliases), F.lit(False))
    role, said = F.coalesce("role", F.lit("")), strip(F.coalesce("dialogue", F.lit("")))
    order = F.col("ord") if "ord" in lines.columns else F.struct(role.alias("role"), said.alias("said"))
    return lines.select(
        F.col("chunk_id").cast("long").alias("chunk_id"),
        F.struct(F.coalesce(F.col("dialogue_index").cast("long"), F.lit(0)).alias("i"), order.alias("o")).alias("pos"),
        target.alias("is_target"),
        F.when(target, said).otherwise(F.concat(role, F.lit(dialect.speaker_sep), said)).alias("piece"),
    )


def build_turns(lines: DataFrame, aliases: list[str], dialect: Dialect = PIPELINE) -> DataFrame:
    """Rows (chunk_id, turn_no, side, value): alternating turns that start human and end gpt.

    A chunk is left out if no line is the target's, if its first line is the target's, or if no
    target line has text. Lines of one side that follow each other merge, joined by line feeds;
    blank target lines neither make nor part turns; a last human turn goes. All windows and the
    merging aggregate share one exchange by ``chunk_id`` and one sort.

    Lines need ``chunk_id``, ``dialogue_index``, ``role``, ``dialogue`` and may have ``ord``.
    """
    chunk = Window.partitionBy("chunk_id")
    ordered = chunk.orderBy("pos")
    flagged = _prepared(lines, aliases, dialect).select("*", F.first("is_target").over(ordered).alias("leads"), F.max("is_target").over(chunk).alias("has_target"))
    spoken = flagged.where(F.col("has_target") & ~F.col("leads") & (F.length("piece") > 0))
    turns = spoken.withColumn("new", F.coalesce((F.lag("is_target").over(ordered) != F.col("is_target")).cast("int"), F.lit(1))).withColumn("turn_no", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    merged = turns.groupBy("chunk_id", "turn_no").agg(F.max("is_target").alias("gpt"), F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("pieces"))
    ends = merged.withColumn("last", F.max(F.when(F.col("gpt"), F.col("turn_no"))).over(chunk))
    kept = ends.where("turn_no <= last AND last >= 2")
    value = strip(F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n"))
    return kept.select("chunk_id", F.col("turn_no").cast("int").alias("turn_no"), F.when(F.col("gpt"), "gpt").otherwise("human").alias("side"), value.alias("value"))


def sample_id(run_name: str, chunk_id: Column, dialect: Dialect = PIPELINE) -> Column:
    """Run name and the chunk's number, zero-padded to five digits and never cut."""
    return F.format_string(run_name.replace("%", "%%") + dialect.id_sep.replace("%", "%%") + "%05d", chunk_id)


def build_samples(lines: DataFrame, aliases: list[str], *, run_name: str, system: str, dialect: Dialect = PIPELINE) -> DataFrame:
    """Nested samples (chunk_id, id, system, conversations), one per kept chunk."""
    turns = build_turns(lines, aliases, dialect)
    message = F.struct("turn_no", F.col("side").alias("from"), "value")
    nested = turns.groupBy("chunk_id").agg(F.array_sort(F.collect_list(message)).alias("m"))
    talk = F.transform("m", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    return nested.select("chunk_id", sample_id(run_name, F.col("chunk_id"), dialect).alias("id"), F.lit(system).alias("system"), talk.alias("conversations"))


def classify_chunks(lines: DataFrame, aliases: list[str], dialect: Dialect = PIPELINE) -> DataFrame:
    """Rows (chunk_id, reason): no_target, leads_with_target, too_short or kept; one aggregate."""
    said = F.col("is_target") & (F.length("piece") > 0)
    per = _prepared(lines, aliases, dialect).groupBy("chunk_id").agg(F.max("is_target").alias("any"), F.min_by("is_target", "pos").alias("leads"), F.max(said).alias("said"))
    reason = F.when(~F.col("any"), "no_target").when(F.col("leads"), "leads_with_target").when(~F.col("said"), "too_short").otherwise("kept")
    return per.select("chunk_id", reason.alias("reason"))


def drop_reasons(lines: DataFrame, aliases: list[str], dialect: Dialect = PIPELINE) -> DataFrame:
    """Rows (reason, n_chunks)."""
    return classify_chunks(lines, aliases, dialect).groupBy("reason").agg(F.count("*").alias("n_chunks"))


def alias_hits(lines: DataFrame, aliases: list[str]) -> DataFrame:
    """Rows (role, n_lines) of target names over the raw lines, most frequent first."""
    return lines.where(F.col("role").isin(*aliases)).groupBy("role").agg(F.count("*").alias("n_lines")).orderBy(F.desc("n_lines"), "role")


def require_hits(lines: DataFrame, aliases: list[str]) -> None:
    """Raises if no line is the target's."""
    if not lines.where(F.col("role").isin(*aliases)).limit(1).count():
        raise RuntimeError(f"no dialogue line has a role in {aliases}")


def turn_stats(samples: DataFrame) -> DataFrame:
    """One row: number of samples, total, least and most turns. Averages are total / samples."""
    n = F.size("conversations").cast("long")
    return samples.agg(F.count("*").alias("samples"), F.coalesce(F.sum(n), F.lit(0)).alias("total_turns"), F.min(n).alias("min_turns"), F.max(n).alias("max_turns"))


def multi_turn(samples: DataFrame, least: int = 4) -> DataFrame:
    """Samples of at least so many messages."""
    return samples.where(F.size("conversations") >= least)


def target_volume(lines: DataFrame, aliases: list[str], few: int = 100) -> DataFrame:
    """One row (n_lines, label): none, few or enough lines of the target."""
    n = F.count(F.when(F.col("role").isin(*aliases), 1))
    return lines.agg(n.alias("n_lines")).withColumn("label", F.when(F.col("n_lines") == 0, "none").when(F.col("n_lines") < few, "few").otherwise("enough"))
