"""Benchmark decontamination with an FM-index for each shard of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_FOLD, bound_batches, materialize, ragged, slices, Words

#: Words of a window; a benchmark item of fewer words is one window.
WINDOW = 10
#: Symbols of a shard's index and documents of a shard, about.
SHARD_SYMBOLS = 1 << 19
SHARD_DOCS = 100_000
#: Every so many text positions the index keeps the position of a suffix.
SAMPLE = 8
#: Bytes of rows that a shard holds until it is indexed.
HELD_BYTES = 16 << 20
#: Occurrences located at once.
LOCATE_BLOCK = 1 << 18
#: Bytes of benchmark text that are searched for in one pass, about; an item is never cut. So much
#: comes to the driver and is broadcast at once; a larger benchmark takes several passes.
PART_BYTES = 2 << 20

_IS_WORD = np.zeros(256, np.int8)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def words_of(text: pa.Array) -> Words:
    """Runs of digits, letters A-Z (folded to a-z) and characters outside ASCII."""
    return Words(text, _IS_WORD, ASCII_FOLD)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by prefix doubling; the last symbol must be the only smallest."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    step = 1
    while True:
        key = rank.astype(np.int64) * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        changes = np.concatenate([[0], np.diff(key[order]) > 0]).cumsum()
        rank = np.empty(n, np.int64)
        rank[order] = changes
        if changes[-1] == n - 1 or step >= n:
            return order
        step = min(2 * step, n)


class FmIndex:
    """Burrows-Wheeler transform in a wavelet matrix, with sampled suffix positions."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = SAMPLE):
        order = suffix_array(text)
        self.n, self.sample = len(text), sample
        column = text[order - 1]
        self.levels: list[tuple[int, np.ndarray, int]] = []  # bit, ones before each place, zeros
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (column >> bit) & 1
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, self.n - int(before[-1])))
            column = np.concatenate([column[ones == 0], column[ones == 1]])
        smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))[:-1]])
        every = np.arange(symbols)
        self.base = smaller - self._descend(every, np.zeros(symbols, np.int64))
        kept = order % sample == 0
        self.kept = kept
        self.kept_before = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, before, zeros in self.levels:
            ones = before[place]
            place = np.where((symbol >> bit) & 1, zeros + ones, place - ones)
        return place

    def _back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one symbol longer."""
        symbol, place = np.zeros(len(row), np.int64), row
        for _, before, zeros in self.levels:
            ones = before[place]
            bit = before[place + 1] - ones
            symbol = symbol * 2 + bit
            place = np.where(bit, zeros + ones, place - ones)
        return self.base[symbol] + place

    def search(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) whose suffixes begin with each phrase, all phrases at once."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for k in range(int(lengths.max(initial=0))):
            going = np.flatnonzero((lengths > k) & (low < high))
            if not len(going):
                break
            symbol = words[starts[going] + lengths[going] - 1 - k]
            low[going] = self.base[symbol] + self._descend(symbol, low[going])
            high[going] = self.base[symbol] + self._descend(symbol, high[going])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: back to the next sampled suffix, whose position is kept."""
        out, row, steps, open_ = np.empty(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(open_):
            done = self.kept[row]
            out[open_[done]] = self.positions[self.kept_before[row[done]]] + steps
            open_, row = open_[~done], self._back(row[~done])
            steps += 1
        return out % self.n


class Phrases:
    """The distinct windows of all benchmark items as symbols, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        items = sorted(((i or "", t or "") for i, t in items))
        found = words_of(pa.array([t for _, t in items], pa.large_string()))
        self.names = [i for i, _ in items]
        self.vocabulary, symbols = np.unique(found.hashes, return_inverse=True)
        symbols = symbols + 2  # 0 ends the text of an index, 1 parts passages
        starts, lengths, owner = [], [], []
        for k, (a, b) in enumerate(zip(found.offsets[:-1], found.offsets[1:], strict=True)):
            if b > a:
                size = min(window, b - a)
                at = np.arange(a, b - size + 1)
                starts.append(at)
                lengths.append(np.full(len(at), size))
                owner.append(np.full(len(at), k))
        start, length, owner = (np.concatenate([[], *x]).astype(np.int64) for x in (starts, lengths, owner))
        table = np.full((len(start), window), -1, np.int64)
        for k in range(window):
            table[length > k, k] = symbols[start[length > k] + k]
        distinct, first, which = np.unique(table, axis=0, return_index=True, return_inverse=True) if len(table) else (table, start, start)
        self.words, self.starts, self.lengths = symbols, start[first], length[first]
        held = np.unique(np.stack([which.ravel(), owner], 1), axis=0) if len(table) else np.zeros((0, 2), np.int64)
        self.items = held[:, 1]
        self.item_bounds = np.searchsorted(held[:, 0], np.arange(len(distinct) + 1))
        self.shortest = int(self.lengths.min(initial=window))


class _Shard:
    """Documents gathered for one index."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.n_words: list[np.ndarray] = []
        self.docs = 0
        # passages: symbols, and for each passage its document, first word and size
        self.symbols: list[np.ndarray] = []
        self.passages: list[np.ndarray] = []
        self.size = 0

    def add(self, text: pa.Array) -> None:
        known = self.phrases.vocabulary
        found = words_of(text)
        n = len(found)
        if n and len(known):
            at = np.minimum(np.searchsorted(known, found.hashes), len(known) - 1)
            good = known[at] == found.hashes
            # maximal runs of benchmark words inside a document; a window lies in one such run
            edge = np.zeros(n + 1, bool)
            edge[found.offsets] = True
            begins = np.flatnonzero(good & (edge[:-1] | ~np.concatenate([[False], good[:-1]])))
            stops = np.flatnonzero(good & (edge[1:] | ~np.concatenate([good[1:], [False]]))) + 1
            wide = stops - begins >= self.phrases.shortest
            begins, stops = begins[wide], stops[wide]
            if len(begins):
                doc = np.searchsorted(found.offsets, begins, side="right") - 1
                self.symbols.append(at[ragged(begins, stops - begins)] + 2)
                self.passages.append(np.stack([doc + self.docs, begins - found.offsets[doc], stops - begins], 1))
                self.size += len(self.symbols[-1])
        self.n_words.append(np.diff(found.offsets))
        self.docs += len(text)

    def contaminated(self) -> np.ndarray:
        """Whether each document has an occurrence."""
        return self.results()["n_hit"].to_numpy() > 0

    def results(self) -> pa.RecordBatch:
        """Rows (n_words, n_hit, items, spans) of all documents, in order."""
        p = self.phrases
        spans_of = spans = items_of = items = np.zeros(0, np.int64)
        ends = spans
        if self.size:
            doc, word, size = np.concatenate(self.passages).T
            begins = np.cumsum(size + 1) - size - 1
            text = np.ones(int(begins[-1] + size[-1]) + 2, np.int64)
            text[ragged(begins, size)] = np.concatenate(self.symbols)
            text[-1] = 0
            index = FmIndex(text, len(p.vocabulary) + 2)
            low, high = index.search(p.words, p.starts, p.lengths)
            count = high - low
            edge = np.zeros(len(text) + 1, np.int64)
            pairs = [np.zeros((0, 2), np.int64)]
            done = np.cumsum(count)
            for a in range(0, int(count.sum()), LOCATE_BLOCK):
                nth = np.arange(a, min(a + LOCATE_BLOCK, int(done[-1])))
                phrase = np.searchsorted(done, nth, side="right")
                at = index.locate(low[phrase] + nth - (done[phrase] - count[phrase]))
                np.add.at(edge, at, 1)
                np.add.at(edge, at + p.lengths[phrase], -1)
                pairs.append(np.unique(np.stack([doc[np.searchsorted(begins, at, side="right") - 1], phrase], 1), axis=0))
            # overlapping occurrences merge into spans
            hit = np.cumsum(edge)[:-1] > 0
            at = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
            stop = np.flatnonzero(hit & ~np.concatenate([hit[1:], [False]])) + 1
            passage = np.searchsorted(begins, at, side="right") - 1
            spans_of, spans = doc[passage], word[passage] + at - begins[passage]
            ends = spans + stop - at
            pairs = np.unique(np.concatenate(pairs), axis=0)
            number = p.item_bounds[pairs[:, 1] + 1] - p.item_bounds[pairs[:, 1]]
            held = np.stack([np.repeat(pairs[:, 0], number), p.items[ragged(p.item_bounds[pairs[:, 1]], number)]], 1)
            items_of, items = np.unique(held, axis=0).T
        every = np.arange(self.docs + 1)
        n_hit = np.bincount(spans_of, ends - spans, self.docs).astype(np.int64)
        span_offsets = np.searchsorted(spans_of, every).astype(np.int32)
        item_offsets = np.searchsorted(items_of, every).astype(np.int32)
        names = pa.array([p.names[k] for k in items], pa.string())
        pieces = pa.StructArray.from_arrays([pa.array(spans), pa.array(ends)], names=["start", "end"])
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate(self.n_words).astype(np.int64)), pa.array(n_hit),
            pa.ListArray.from_arrays(pa.array(item_offsets), names), pa.ListArray.from_arrays(pa.array(span_offsets), pieces),
        ], names=["n_words", "n_hit", "items", "spans"])


def benchmark_parts(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> Iterator[Broadcast]:
    """The windows of the benchmark's items, broadcast, in parts of about ``PART_BYTES`` of text.

    The size is counted before anything is collected; items are dealt to the parts by hash.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    for k in range(parts):
        rows = items if parts == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k)
        yield spark.sparkContext.broadcast(Phrases([tuple(r) for r in rows.collect()], window))


def _shards(batches: Iterator[pa.RecordBatch], text_col: str, phrases: Phrases, keep: list[str], limits: tuple[int, int, int]) -> Iterator[tuple[list[pa.RecordBatch], _Shard]]:
    """Shards with the rows they were made of, bounded by symbols, documents and bytes held."""
    symbols, docs, most = limits
    shard, held, size = _Shard(phrases), [], 0
    for batch, text in slices(batches, text_col, 1 << 20):
        shard.add(text)
        held.append(batch.select(keep))
        size += held[-1].nbytes
        if shard.size >= symbols or shard.docs >= docs or size >= most:
            yield held, shard
            shard, held, size = _Shard(phrases), [], 0
    if held:
        yield held, shard


def _search(table: DataFrame, part: Broadcast, k: int, keep: list[str]) -> DataFrame:
    """The columns to keep, with ``items`` and ``spans`` of the k-th part of the benchmark in
    ``text``, and on the first pass the number of words."""
    found = T.StructType().add("n_words", "long").add(f"items{k}", T.ArrayType(T.StringType())).add(f"spans{k}", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).fields[k > 0 :]
    schema = T.StructType([*(table.schema[c] for c in keep), *found])
    limits = SHARD_SYMBOLS, SHARD_DOCS, HELD_BYTES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, shard in _shards(batches, "text", part.value, keep, limits):
            result, at = shard.results(), 0
            for batch in held:
                own = result.slice(at, batch.num_rows).select(["n_words", "items", "spans"][k > 0 :])
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns, *own.columns], names=schema.names)

    return table.mapInArrow(scan, schema)


def _merged(spans: str) -> str:
    """SQL for sorted spans without overlaps and without ones that touch."""
    last = "element_at(done, -1)"
    longer = f"concat(slice(done, 1, size(done) - 1), array(named_struct('start', {last}.start, 'end', greatest({last}.end, s.end))))"
    return f"aggregate(array_sort({spans}), cast(array() AS array<struct<start:bigint,end:bigint>>), (done, s) -> if(size(done) > 0 AND {last}.end >= s.start, {longer}, concat(done, array(s))))"


def find_contamination(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``items`` and the word ``spans`` to remove.

    Each task indexes its documents shard by shard, finds every window of every benchmark item
    by backward search, locates all occurrences and merges them. Words that no benchmark item has,
    and runs of known words too short for any window, cannot be part of an occurrence and are left
    out of the index; nothing else is. Nothing is shuffled. A benchmark of more than ``PART_BYTES``
    is searched for in several passes, each written to the shared folder.

    Null texts have no words and no hits; long texts are indexed whole, in a shard of their own
    where they exceed one; rows with equal ids are judged alone. Items without words have no
    windows; of equal items both are named. ``items`` are sorted as strings; a null item id is
    named "". An empty table of documents gives an empty one, an empty benchmark no hits. Other
    columns are not read, whatever their names.
    """
    bound_batches(df.sparkSession)
    table = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = list(benchmark_parts(benchmark, item_col, item_text_col, window))
    for k, part in enumerate(parts):
        last = k == len(parts) - 1
        table = _search(table, part, k, [c for c in table.columns if not (last and c == "text")])
        table = table if last else materialize(table, "contamination")
    every = range(len(parts))
    if len(parts) > 1:
        items = F.array_sort(F.array_distinct(F.concat(*[f"items{k}" for k in every])))
        spans = F.expr(_merged(f"concat({', '.join(f'spans{k}' for k in every)})"))
    else:
        items, spans = F.col("items0"), F.col("spans0")
    table = table.select("id", "n_words", items.alias("items"), spans.alias("spans"))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return table.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "items", "spans")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``df`` whose texts hold no window of any benchmark item, all columns kept.

    The same search as in ``find_contamination``; rows are held with their shard until it is
    indexed, and nothing is joined or shuffled. Null and empty texts stay, as do repeated rows
    without hits; columns of any name pass through; an empty table stays empty.
    """
    bound_batches(df.sparkSession)
    parts = list(benchmark_parts(benchmark, item_col, item_text_col, window))
    limits, columns = (SHARD_SYMBOLS, SHARD_DOCS, HELD_BYTES), df.columns
    for k, part in enumerate(parts):

        def scan(batches: Iterator[pa.RecordBatch], part: Broadcast = part) -> Iterator[pa.RecordBatch]:
            for held, shard in _shards(batches, text_col, part.value, columns, limits):
                keep, at = ~shard.contaminated(), 0
                for batch in held:
                    yield batch.filter(pa.array(keep[at : at + batch.num_rows]))
                    at += batch.num_rows

        df = df.mapInArrow(scan, df.schema)
        df = df if k == len(parts) - 1 else materialize(df, "clean")
    return df
