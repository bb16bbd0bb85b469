"""Dialogue lines and chunks as they arrive: file streams, checkpointed state, idempotent sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from .. import schemas
from ..operators import extract


def read_line_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """New JSON-line files of a folder as a stream."""
    return spark.readStream.schema(schemas.LINE).option("maxFilesPerTrigger", files_per_batch).option("mode", "FAILFAST").json(folder)


def _first_of_key(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The first line of a (role, dialogue) that no batch had before, by chunk and place in it."""
    best = None
    for frame in frames:
        first = frame.sort_values(["chunk_id", "dialogue_index"], na_position="first", kind="stable").head(1)
        best = first if best is None else pd.concat([best, first]).sort_values(["chunk_id", "dialogue_index"], na_position="first", kind="stable").head(1)
    if best is not None and not state.exists:
        state.update((True,))
        yield best


def first_lines(stream: DataFrame) -> DataFrame:
    """The lines of a stream whose exact (role, dialogue) was not there before.

    What was said is state, kept by key and looked up by key, so a batch costs what it holds and
    not what came before it; with a RocksDB state store it need not fit in memory. State is one
    flag for each different line, for as long as the query lives: exact, without a watermark.
    """
    return stream.groupBy("role", "dialogue").applyInPandasWithState(_first_of_key, stream.schema, "seen boolean", "append", "NoTimeout")


def dedup_stream(stream: DataFrame, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends each line to a Parquet table the first time it is said, exactly once."""
    writer = first_lines(stream).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def chunk_counts_stream(stream: DataFrame) -> DataFrame:
    """Running lines for each chunk and role, for a sink in update or complete mode."""
    return stream.where("chunk_id IS NOT NULL").groupBy("chunk_id", F.coalesce("role", F.lit("Unknown")).alias("role")).agg(F.count("*").alias("n_lines"))


def call_model_stream(chunks: DataFrame, make_model: Callable[[], extract.Model], system: str, out: str, checkpoint: str, parallel: int = 8) -> StreamingQuery:
    """Asks the model for each new chunk once and stores replies and errors batch by batch."""
    def store(batch: DataFrame, number: int) -> None:
        extract.call_model(batch, make_model, system, "chunk", parallel=parallel).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return chunks.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
