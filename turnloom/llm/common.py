"""Shared folders, Arrow text access and small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.shared import free, materialize, scratch_path, shared_dir  # noqa: F401

#: Raw text handled at once inside a Python worker, in bytes.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and its Python workers.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit for Arrow batches to ``BATCH_BYTES``; a lower one stays.

    Rows differ in size by orders of magnitude, so a limit by rows alone does not bound memory.
    """
    now = spark.conf.get(_BATCH_SETTING).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, f"{BATCH_BYTES}b")


def posix_path(url: str) -> str:
    """The path of a shared folder that is mounted on every machine; other stores are refused."""
    parsed = urlparse(url)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {url}")
    return parsed.path


def ascii_lower(column):
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column as large_string, nulls as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column.cast(pa.large_string()), "")


def buffers(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets (starting at 0) of a large_string array without nulls."""
    _, offsets, data = text.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Pieces of the batches with at most ``most`` bytes of text, or a single longer row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        text = text_of(batch, name)
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start), text.slice(start, stop - start)
            start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each run, concatenated."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]]; empty runs give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


_TURN = np.uint64(0x9E3779B97F4A7C15)
_TURN_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_CODE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The words of some texts: maximal runs of bytes that ``is_word`` (a table of 256) allows.

    ``first`` and ``last`` are byte bounds of each word, ``offsets`` the bounds of each text in
    the words, ``hashes`` 64-bit polynomial hashes of the words' bytes, after ``fold`` (a table
    of 256) has been applied to each. Bytes from 0x80 are parts of other characters and always
    belong to words.
    """

    def __init__(self, text: pa.Array, is_word: np.ndarray, fold: np.ndarray):
        raw, ends = buffers(text)
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[:-1] = is_word[raw]
        starts, stops = inside.copy(), np.zeros(len(raw) + 1, np.int8)
        starts[1:] &= ~inside[:-1] & 1
        stops[1:] = inside[:-1] & ~inside[1:] & 1
        inner = ends[1:-1]
        if len(inner):  # a word ends with its text
            cut = inner[(inner > 0) & (inner < len(raw))]
            both = cut[(inside[cut - 1] & inside[cut]).astype(bool)]
            starts[both] = 1
            stops[both] = 1
        self.raw = raw
        self.first, self.last = np.flatnonzero(starts), np.flatnonzero(stops)
        self.offsets = np.searchsorted(self.first, ends)
        # prefix sums of byte codes times powers; a word's share is turned back to its start
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[fold[raw]] * _powers(_TURN, len(raw)), dtype=np.uint64, out=total[1:])
        self.hashes = (total[self.last] - total[self.first]) * _powers(_TURN_BACK, len(raw) + 1)[self.first]

    def __len__(self) -> int:
        return len(self.first)


ASCII_FOLD = np.arange(256, dtype=np.uint8)
ASCII_FOLD[ord("A") : ord("Z") + 1] += 32
