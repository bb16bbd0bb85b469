"""Packing documents into sequences of bounded length: best fit, then swap-based local search."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, materialize, slices
from .tokens import Encoder

#: Pieces that one task packs together. Each block leaves at most about one sequence underfull.
BLOCK_PIECES = 4096

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int | None = 0, max_tokens: int = 2048) -> DataFrame:
    """One row per piece: documents of more than ``max_tokens`` ids are cut, others are one piece.

    The ids of a document are those of its text and ``end_id``. Null texts count as empty; texts
    of any length are encoded whole; null and repeated ids stay as they are. A document without
    any id (no ``end_id``) gives one piece of length 0. An empty table gives an empty one; other
    columns are not read, whatever their names.
    """
    bound_batches(df.sparkSession)
    narrow = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(tokenizer)
        tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch, text in slices(batches, "text", 4 << 20):
            ids, ends = encoder.encode(text)
            raw, step = memoryview(ids.astype("<u4").tobytes()), 4 * max_tokens
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, a, b in zip(batch.column(0).to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                whole = bytes(raw[4 * a : 4 * b]) + tail
                for k, at in enumerate(range(0, max(1, len(whole)), step)):
                    piece = whole[at : at + step]
                    for column, value in zip(out, (doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return narrow.mapInArrow(cut, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the lengths in bins: each, in the given order, goes where it leaves least room."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes = 0
    for i, size in enumerate(lengths):
        fits = open_sizes >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_free[room].pop()
            if not by_free[room]:
                open_sizes &= ~(1 << room)
        else:
            b, room = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        by_free[room - size].append(b)
        open_sizes |= 1 << (room - size)
    return bins


class _Exchanges:
    """Local search on bins: moves and exchanges between two bins that raise the sum of squared fills.

    A change takes one or two items out of a bin and puts them into another one, for nothing or for
    one smaller item of it. The sum rises exactly if the other bin is then fuller than the first
    one was. Of all such changes the one that leaves least room is made.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.capacity = bins, capacity
        self.sizes = np.array(lengths, np.int64)
        self.where = np.zeros(len(lengths), np.int64)
        for b, items in enumerate(bins):
            self.where[items] = b
        self.free = capacity - np.bincount(self.where, self.sizes, len(bins)).astype(np.int64)
        self.list = self.sizes.tolist()
        self.order = np.argsort(self.sizes, kind="stable")
        self.sorted = self.sizes[self.order].tolist()
        self.used = sum(map(bool, bins))
        self.least = -(-int(self.sizes.sum()) // capacity)

    def run(self) -> None:
        """From the emptiest bin on, until no change raises the sum or no bin can be emptied."""
        changed = True
        while changed and self.used > self.least:
            changed = False
            order = np.argsort(-self.free, kind="stable")
            for poor in order[(self.free[order] > 0) & (self.free[order] < self.capacity)].tolist():
                while self.bins[poor] and self.free[poor] and self.improve(poor):
                    changed = True
                if self.used == self.least:
                    return

    def improve(self, poor: int) -> bool:
        """The best change of the first kind that has one: a move, one for one, two for one."""
        sizes, capacity, limit = self.list, self.capacity, int(self.free[poor])
        room = self.free.copy()
        room[room == capacity] = -1  # empty bins are none to move to
        room[poor] = -1
        widest = int(room.max())
        gifts = {sizes[i]: (i,) for i in self.bins[poor]}
        best, change = limit, None  # the room left must be less than the poor bin has
        for size, gift in gifts.items():
            if size <= widest:
                left = np.where(room >= size, room - size, capacity)
                at = int(left.argmin())
                if left[at] < best:
                    best, change = int(left[at]), (gift, None, at)
        if change is None:
            change = self.exchange(gifts, room, widest, limit)
        if change is None:
            pairs = {sizes[i] + sizes[j]: (i, j) for i, j in combinations(self.bins[poor], 2)}
            change = self.exchange(pairs, room, widest, limit)
        if change is None:
            return False
        self.make(poor, *change)
        return True

    def exchange(self, gifts: dict[int, tuple[int, ...]], room: np.ndarray, widest: int, limit: int) -> tuple | None:
        """The gift that with one smaller item taken back for it leaves least room, and that item."""
        if not gifts or widest <= 0:
            return None
        # by size, so that only items are looked at that could make way
        first = bisect_left(self.sorted, min(gifts) - widest)
        items = self.order[first : bisect_left(self.sorted, max(gifts))]
        bins = self.where[items]
        # an item in a full bin or in the poor one cannot make way: its reach is no more than its size
        reach = self.sizes[items] + room[bins]
        best, found = limit, None
        for size, gift in gifts.items():
            a, b = bisect_left(self.sorted, size - widest) - first, bisect_left(self.sorted, size) - first
            if a < b:
                left = np.where(reach[a:b] >= size, reach[a:b] - size, self.capacity)
                at = int(left.argmin())
                if left[at] < best:
                    best, found = int(left[at]), (gift, int(items[a + at]), int(bins[a + at]))
                    if not best:
                        break
        return found

    def make(self, poor: int, gift: tuple[int, ...], item: int | None, other: int) -> None:
        for i in gift:
            self.bins[poor].remove(i)
            self.where[i] = other
        self.bins[other] += gift
        change = sum(self.list[i] for i in gift)
        if item is not None:
            self.bins[other].remove(item)
            self.bins[poor].append(item)
            self.where[item] = poor
            change -= self.list[item]
        self.free[other] -= change
        self.free[poor] += change
        self.used -= not self.bins[poor]


def pack_lengths(lengths: list[int], capacity: int, search: bool = True) -> list[list[int]]:
    """Indices of the given lengths in as few bins as the search finds.

    Best fit in the given order, then moves and exchanges between underfull bins until none raises
    the sum of squared fills, or until there are as few bins as the sum of all lengths allows.
    """
    bins = best_fit(lengths, capacity)
    if search and lengths:
        _Exchanges(bins, lengths, capacity).run()
    return [b for b in bins if b]


def pack_pieces(pieces: DataFrame, *, max_tokens: int = 2048, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows (doc_id, piece, start, length, ...).

    Full pieces are sequences by themselves. The others are dealt by the hash of their place in the
    table into blocks of about ``block_pieces``, each packed in one task, so memory is bounded at
    any size, whatever ids repeat or are null. Repeated rows are packed like any other; pieces of
    equal lengths are placed by id; an empty table gives an empty one. Columns named
    ``sequence_id`` or ``offset`` are refused.
    """
    if clash := {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError(f"the pieces have columns of their own named {sorted(clash)}")
    schema = pieces.schema
    pieces = materialize(pieces, "pieces")
    rest = pieces.where(F.col("length") < max_tokens)
    blocks = max(1, -(-rest.count() // block_pieces))
    key = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    block = next(f"block{'_' * k}" for k in range(len(pieces.columns) + 1) if f"block{'_' * k}" not in pieces.columns)

    def pack(table: pa.Table) -> pa.Table:
        # a plain order: by id, not by length
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("length", "descending")])
        lengths = table["length"].to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        base = (table[block][0].as_py() + 1) << 32
        for k, items in enumerate(pack_lengths(lengths, max_tokens)):
            at = 0
            for i in sorted(items):
                sequence[i], offset[i] = base + k, at
                at += lengths[i]
        return table.drop_columns([block]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    out = T.StructType([*schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    packed = rest.withColumn(block, key).groupBy(block).applyInArrow(pack, out)
    full = pieces.where(F.col("length") >= max_tokens).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return full.unionByName(packed)


def pack_documents(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, max_tokens: int = 2048, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Pieces of every document with their sequence and place there; see the two steps above."""
    pieces = token_pieces(df, id_col=id_col, text_col=text_col, tokenizer=tokenizer, max_tokens=max_tokens)
    return pack_pieces(pieces, max_tokens=max_tokens, block_pieces=block_pieces)
