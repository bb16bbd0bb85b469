"""Overlapping, token-budgeted chunks of long texts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SENTENCE_ENDS

MAX_TOKENS = 500
OVERLAP_TOKENS = 50
#: Lines before a chunk's first new line from which its overlap is taken.
LOOK_BACK = 5

#: Counts the tokens of many texts at once.
Counter = Callable[[list[str]], list[int]]


def count_characters(texts: list[str]) -> list[int]:
    return [len(t) for t in texts]


def tokenizer_counter(path: str) -> Counter:
    """Counts by a file of the tokenizers library."""
    loaded: dict[str, object] = {}

    def count(texts: list[str]) -> list[int]:
        if "t" not in loaded:
            from tokenizers import Tokenizer

            loaded["t"] = Tokenizer.from_file(path)
        return [len(e.ids) for e in loaded["t"].encode_batch_fast(texts, add_special_tokens=False)]

    return count


def split_long_line(line: str, count: Counter, max_tokens: int, ends: str = SENTENCE_ENDS) -> list[str]:
    """Sentences of a line gathered while their joined text fits; a longer sentence stays whole."""
    pieces = [p for p in re.split(f"(?<=[{re.escape(ends)}])", line) if p]
    out, held = [], ""
    for piece in pieces:
        if held and count([held + piece])[0] > max_tokens:
            out.append(held)
            held = piece
        else:
            held += piece
    return [*out, held] if held else out


def _overlap(lines: list[str], costs: list[int], i: int, budget: int) -> tuple[list[str], int]:
    """Of the lines before i, oldest first, those that still fit; gaps are possible."""
    taken, total = [], 0
    for j in range(max(0, i - LOOK_BACK), i):
        if total >= budget:
            break
        if total + costs[j] <= budget:
            taken.append(lines[j])
            total += costs[j]
    return taken, total


def chunk_text(text: str, count: Counter = count_characters, max_tokens: int = MAX_TOKENS, overlap_tokens: int = OVERLAP_TOKENS, ends: str = SENTENCE_ENDS) -> list[str]:
    """Chunks of whole stripped lines, each line and its line feed within the budget.

    A full chunk is closed and the next one starts with an overlap: of the five lines before,
    oldest first, those that fit its budget. Lines beyond the budget are chunks by sentences and
    close what is open. Where a line does not fit after the overlap, the overlap is given up, so
    the scan always moves on.
    """
    lines = [s for s in (x.strip() for x in text.split("\n")) if s]
    costs = count(lines) if lines else []
    chunks: list[str] = []
    parts: list[str] | None = None  # the open chunk; its text ends with a line feed
    total = 0
    for i, (line, cost) in enumerate(zip(lines, costs, strict=True)):
        if cost > max_tokens:
            if parts is not None:
                chunks.append("\n".join(parts) + "\n")
            parts, total = None, 0
            chunks.extend(split_long_line(line, count, max_tokens, ends))
            continue
        if total + cost + 1 > max_tokens:
            if parts is not None:
                chunks.append("\n".join(parts).rstrip())
            taken, total = _overlap(lines, costs, i, overlap_tokens)
            # an empty overlap still leaves its line feed, so such a chunk begins with one
            parts = taken or [""]
            if total + cost + 1 > max_tokens:
                parts, total = None, 0
        parts = [*(parts or []), line]
        total += cost + 1
    if parts is not None:
        chunks.append("\n".join(parts).rstrip())
    return chunks


def chunk_documents(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", count: Counter = count_characters, max_tokens: int = MAX_TOKENS, overlap_tokens: int = OVERLAP_TOKENS, ends: str = SENTENCE_ENDS
) -> DataFrame:
    """Rows (id, chunk_id, chunk, n_tokens); ``chunk_id`` counts from 0 in each document.

    The scan is sequential inside a document and parallel across documents, in Arrow batches
    without a shuffle. Null and blank texts give no rows.
    """
    if max_tokens <= overlap_tokens:
        raise ValueError("max_tokens must be larger than overlap_tokens")
    narrow = df.select(F.col(id_col), F.col(text_col).cast("string")).where(F.col(text_col).isNotNull())
    kind = narrow.schema[id_col].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                ids, numbers, texts = [], [], []
                some = batch.slice(start, 64)
                for key, text in zip(*(c.to_pylist() for c in some.columns), strict=True):
                    for k, chunk in enumerate(chunk_text(text, count, max_tokens, overlap_tokens, ends)):
                        ids.append(key)
                        numbers.append(k)
                        texts.append(chunk)
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(numbers, pa.int32()), pa.array(texts, pa.string()), pa.array(count(texts) if texts else [], pa.int32())], names=[id_col, "chunk_id", "chunk", "n_tokens"])

    return narrow.mapInArrow(chunks, f"`{id_col}` {kind}, chunk_id int, chunk string, n_tokens int")
