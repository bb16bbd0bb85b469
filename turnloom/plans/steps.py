"""Steps of a run: extraction, sample building, validation; state tells what is done."""

from __future__ import annotations

import logging
import os
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import Settings
from ..operators import chunker, conversation, extract, lines, split, stats
from ..operators.validate import validate_samples
from ..functions.text import role_system_prompt
from ..sources import files
from ..sources.shared import materialize

FEW_SAMPLES = 10
#: Chunks, or batches of samples, whose replies are stored at once.
SLICE_ROWS = 500
log = logging.getLogger("turnloom")


class RunState:
    """Which steps of which runs are done: an append-only table, the last entry counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _table(self) -> DataFrame:
        try:
            return self.spark.read.schema(schemas.STEP).parquet(self.path)
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], schemas.STEP)
            raise

    def _append(self, run_name: str, step: str, done: bool) -> None:
        row = self.spark.createDataFrame([(run_name, step)], "run_name string, step string")
        stamp = F.current_timestamp() if done else F.lit(None).cast("timestamp")
        row.select("*", stamp.alias("done_at"), F.current_timestamp().alias("at")).write.mode("append").parquet(self.path)

    def is_done(self, run_name: str, step: str) -> bool:
        if not self._exists():
            return False
        found = self.spark.read.parquet(self.path).where((F.col("run_name") == run_name) & (F.col("step") == step))
        last = found.agg(F.max_by(F.struct("done_at"), "at").alias("r")).first()["r"]
        return bool(last and last.done_at)

    def _exists(self) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def mark(self, run_name: str, step: str) -> None:
        self._append(run_name, step, True)

    def clear(self, run_name: str, step: str) -> None:
        self._append(run_name, step, False)

    def run(self, run_name: str, step: str, work: Callable[[], Any]) -> Any:
        """The step's result, or None if it is done already; marked done only if it ends well."""
        if self.is_done(run_name, step):
            return None
        result = work()
        self.mark(run_name, step)
        return result


def pending_chunks(chunks: DataFrame, replies: DataFrame | None) -> DataFrame:
    """Chunks without a good reply: new ones and those that failed."""
    if replies is None:
        return chunks
    good = replies.where("error IS NULL").select("doc_id", "chunk_id").distinct()
    return chunks.join(good, ["doc_id", "chunk_id"], "left_anti")


# What the model is asked for.
EXTRACT_TASK = "Novel dialogues"
EXTRACT_ATTRIBUTES = ({"name": "role", "type": "String", "description": "who speaks"}, {"name": "dialogue", "type": "String", "description": "what is said"})


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def ask_in_slices(todo: DataFrame, ask: Callable[[DataFrame], DataFrame], keys: list[str], path: str, slice_rows: int) -> int:
    """Asks about rows in slices by the hash of their keys and stores each slice's replies as soon
    as it is through, so that a run that dies loses one slice at most; returns their number."""
    slices = max(1, -(-todo.count() // slice_rows))
    part = F.pmod(F.xxhash64(*keys), F.lit(slices))
    for k in range(slices):
        ask(todo if slices == 1 else todo.where(part == k)).write.mode("append").parquet(path)
        log.info("replies of slice %d of %d stored", k + 1, slices)
    return slices


def run_extraction(
    spark: SparkSession,
    settings: Settings,
    make_model: Callable[[], extract.Model],
    reply_path: str,
    *,
    attempts: int = extract.ATTEMPTS,
    pause: Callable[[int, Exception], float] = extract.linear_pause,
    slice_rows: int = SLICE_ROWS,
    prompt: str | None = None,
) -> DataFrame:
    """Chunk the novel, ask the model for chunks without a good reply, and parse all replies.

    Budgets count tokens if the settings name a tokenizer. A failed call is repeated ``attempts``
    times in all, with pauses; what then fails leaves an error. Replies are stored slice by slice,
    before they are parsed, and are the state of the step: a run that stops is taken up where it
    was, failed chunks are asked again, and dedup covers old and new replies.
    """
    novel = files.read_text(spark, settings.novel_txt).select(F.lit(0).cast("long").alias("doc_id"), "text")
    chunks = materialize(chunker.chunk_documents(novel, count=settings.counter, max_tokens=settings.chunk_size_tokens, overlap_tokens=settings.chunk_overlap_tokens), "chunks")
    prompt = prompt or extract.extraction_prompt(EXTRACT_TASK, list(EXTRACT_ATTRIBUTES))

    def make() -> extract.Model:
        return extract.with_retries(make_model(), attempts, pause)

    todo = pending_chunks(chunks, _stored(spark, reply_path))
    todo = materialize(todo, "pending")
    ask_in_slices(todo, lambda rows: extract.call_model(rows, make, prompt, "chunk", parallel=settings.max_workers), ["doc_id", "chunk_id"], reply_path, slice_rows)
    replies = spark.read.parquet(reply_path).where("error IS NULL").select(F.col("chunk_id").cast("long").alias("chunk_id"), "chunk", "response")
    result = lines.sort_lines(extract.extract_lines(replies, chunk_text=settings.save_chunk_text))
    files.write_jsonl(result, settings.raw_lines)
    return result


def rewrite_samples(
    samples: DataFrame,
    make_model: Callable[[], extract.Model],
    folder: str,
    out: str,
    *,
    role: str,
    title: str,
    prefix: str,
    field: str = "role",
    manner: str = "",
    preamble: str = "",
    sample_count: int = 0,
    batch_size: int = 10,
    parallel: int = 8,
    slice_batches: int = SLICE_ROWS,
    attempts: int = extract.BATCH_ATTEMPTS,
    pause: Callable[[int, Exception], float] = extract.rate_aware_pause,
    system: str | None = None,
) -> dict[str, int]:
    """Rewrites single-turn samples (pos, conversations) into chat samples, in batches.

    The first ``sample_count`` samples count, or all. Those already in ``folder`` are kept and not
    asked about again. The others go to the model by ``batch_size`` in a prompt; what a batch
    leaves out, or all of a batch that fails, is asked about once more sample by sample, and what
    fails again is dropped. Replies are stored slice by slice. ``out`` gets the result as one JSON
    list in the order of the samples; the counts are returned.
    """
    spark = samples.sparkSession
    fields = ("user", field)
    fill = lambda text: text.replace("{role}", role).replace("{manner}", manner).replace("{field}", field)

    def make() -> extract.Model:
        return extract.with_retries(make_model(), attempts, pause)

    wanted = materialize(samples.where(F.col("pos") < sample_count) if sample_count > 0 else samples, "rewrite")
    done = _stored(spark, f"{folder}/rewritten")
    todo = wanted if done is None else wanted.join(done.select("pos").distinct(), "pos", "left_anti")
    # batches are of samples that are still to do, so their places among these count
    todo = materialize(lines.number_rows(todo, "pos", name="place"), "rewrite-todo")
    prompts = extract.rewrite_prompts(todo.withColumn("pos", F.col("pos")), role, preamble, batch_size, place="place")

    def ask(rows: DataFrame) -> DataFrame:
        replies = materialize(extract.call_model(rows, make, fill(extract.REWRITE_SYSTEM), "prompt", parallel=parallel), "rewrite-replies")
        found, missing = extract.match_rewrites(replies.select("ids", "response"), fields)
        singles = extract.single_prompts(todo.join(missing, "pos", "left_semi"), role, preamble, field)
        again = materialize(extract.call_model(singles, make, fill(extract.SINGLE_SYSTEM), "prompt", parallel=parallel), "rewrite-singles")
        alone = again.select("pos", extract.single_rewrite(F.col("response"), fields).alias("v")).where("v IS NOT NULL").select("pos", *[F.col(f"v.`{f}`").alias(f) for f in fields])
        return found.unionByName(alone)

    if todo.limit(1).count():
        ask_in_slices(prompts, ask, ["batch"], f"{folder}/rewritten", slice_batches)
    every = _stored(spark, f"{folder}/rewritten")
    counts = {"samples": wanted.count(), "kept_from_before": 0 if done is None else done.join(wanted, "pos", "left_semi").count(), "written": 0}
    if every is not None:
        items = every.join(wanted.select("pos"), "pos", "left_semi").dropDuplicates(["pos"])
        items = extract.chat_items(items, prefix, system or role_system_prompt(role, title), "user", field)
        counts["written"] = files.write_json_array(items, out)
    return counts


def build_dataset(spark: SparkSession, settings: Settings, source: DataFrame | None = None, system: str | None = None) -> dict[str, Any]:
    """Lines to samples, cap, split, files and registry; returns the counts and figures.

    The settings' dialect says how speakers, ids and the system sentence are written; ``system``
    replaces the sentence.
    """
    source = files.read_jsonl(spark, settings.raw_lines) if source is None else source
    conversation.require_hits(source, settings.aliases)
    dialect = conversation.DIALECTS[settings.dialect]
    system = system or role_system_prompt(settings.canonical_role, settings.novel_title, always_title=dialect.always_title)
    samples = conversation.build_samples(source, settings.aliases, run_name=settings.run_name, system=system, dialect=dialect)
    train, valid, capped = split.cap_and_split(samples, settings.max_conversations, settings.valid_ratio, "id", settings.seed)
    os.makedirs(os.path.dirname(settings.train_file), exist_ok=True)
    counts = {name: files.write_json_array(part.orderBy("chunk_id").drop("chunk_id"), path) for name, part, path in (("train", train, settings.train_file), ("valid", valid, settings.valid_file))}
    report = {
        **counts,
        "reasons": {r.reason: r.n_chunks for r in conversation.drop_reasons(source, settings.aliases, dialect).collect()},
        "alias_hits": {r.role: r.n_lines for r in conversation.alias_hits(source, settings.aliases).collect()},
        "turns": conversation.turn_stats(capped).first().asDict(),
    }
    report["warning"] = f"only {sum(counts.values())} samples" if sum(counts.values()) < FEW_SAMPLES else None
    names = {f"{settings.run_name}_train": os.path.basename(settings.train_file), f"{settings.run_name}_valid": os.path.basename(settings.valid_file)}
    files.write_registry(files.registry_entries(spark, names), os.path.join(os.path.dirname(settings.train_file), "dataset_info.json"))
    return report


def validate_files(spark: SparkSession, paths: list[str]) -> list[dict[str, Any]]:
    """Figures of each file with its path; the first invalid row of any raises."""
    from ..operators.validate import json_sample_errors

    out = []
    for path in paths:
        rows = json_sample_errors(files.read_json_array_raw(spark, path))
        out.append({"path": path, **validate_samples(rows, "index")})
    return out


def report_lines(spark: SparkSession, path: str, k: int = 10) -> dict[str, Any]:
    """Figures of a file of dialogue lines: corpus, chunks, busiest chunks and top roles."""
    source = files.read_jsonl(spark, path)
    return {
        **stats.corpus_report(source),
        "chunks": stats.chunk_summary(source).first().asDict(),
        "busiest": [r.asDict() for r in stats.busiest_chunks(source).collect()],
        "top_roles": [r.asDict() for r in stats.top_roles(source, k).collect()],
    }
