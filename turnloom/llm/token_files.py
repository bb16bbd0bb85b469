"""Token files: flat unsigned ids plus 64-bit document offsets, memory-mapped."""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, buffers, posix_path, scratch_path, slices
from .tokens import Encoder

#: Bytes of text whose ids make one file, about; they are counted before the files are laid out.
BYTES_PER_FILE = 64 << 20
#: Rows in all and besides for each file, about, from whose keys and sizes the borders are drawn.
SAMPLE_ROWS = 100_000
SAMPLE_PER_FILE = 40
LOWEST = np.iinfo(np.int64).min

MANIFEST = T.StructType([T.StructField("shard", T.LongType()), T.StructField("docs", T.LongType()), T.StructField("ids", T.LongType())])
INDEX = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def _files(folder: str, shard: int) -> dict[str, str]:
    return {kind: f"{folder}/{shard:06d}.{kind}" for kind in ("ids", "offsets", "docs")}


class Borders:
    """Keys (id, salt) that part the rows into files: a file begins with its border."""

    def __init__(self, keys: list[tuple[int, int]]):
        keys = sorted(keys)
        self.ids, self.salts = (np.array([k[j] for k in keys], np.int64) for j in (0, 1))

    def file_of(self, ids: np.ndarray, salts: np.ndarray) -> np.ndarray:
        first, last = np.searchsorted(self.ids, ids, "left"), np.searchsorted(self.ids, ids, "right")
        out = first.copy()
        split = np.flatnonzero(first < last)  # ids that stand in several files
        for a in np.unique(first[split]):
            rows = split[first[split] == a]
            out[rows] = a + np.searchsorted(self.salts[a : last[rows[0]]], salts[rows], "right")
        return out


def _salted(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, salt, text). The salt parts rows with equal ids; a null id is the lowest number."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("id"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"), text)


def file_borders(df: DataFrame, id_col: str, text_col: str, files: int | None) -> Borders:
    """Borders of files of about equal bytes of text, from a sample of ids and sizes by hash."""
    rows = _salted(df, id_col, text_col).select("id", "salt", F.octet_length("text").cast("long").alias("size"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    files = files or max(1, -(-size // BYTES_PER_FILE))
    if files == 1 or not n:
        return Borders([])
    share = min(1.0, (SAMPLE_ROWS + SAMPLE_PER_FILE * files) / n)
    sample = rows.where(F.pmod(F.xxhash64("salt"), F.lit(1 << 30)) <= int(share * (1 << 30))).toArrow().sort_by([("id", "ascending"), ("salt", "ascending")])
    total = np.cumsum(sample["size"].to_numpy() + 1)
    at = np.searchsorted(total, np.arange(1, files) * (total[-1] / files)) if len(total) else np.zeros(0, int)
    return Borders([(sample["id"][int(i)].as_py(), sample["salt"][int(i)].as_py()) for i in np.unique(at[at > 0])])


def write_token_files(df: DataFrame, folder: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int | None = 1, files: int | None = None) -> str:
    """Write the ids of every text in ascending order of ``id_col``; returns the folder.

    The borders of the files are drawn first, from ids and sizes. Then the texts are encoded where
    they lie, and their ids, not the texts, are dealt to the files and sorted. A shard has three
    files: ``ids`` (uint16 if the vocabulary fits, else uint32), ``offsets`` (int64, one more than
    documents) and ``docs`` (int64 ids, the lowest int64 for null). ``manifest.json`` holds the
    counts and the base of each shard, a prefix sum over them. Files appear by an atomic rename, so
    retried and speculative tasks leave the same result.

    Null texts count as empty; a long text is one row of ids, whole. Rows with equal ids all stay;
    they and rows without an id, which come first, may be dealt to several files. An empty table
    gives a folder without shards. Other columns are not read, whatever their names. The folder
    must be mounted on every machine.
    """
    spark = df.sparkSession
    bound_batches(spark)
    folder = posix_path(folder or scratch_path(spark, "token-files"))
    os.makedirs(folder, exist_ok=True)
    borders = file_borders(df, id_col, text_col, files)
    dtype = _dtype(tokenizer)
    encoded = _encoded(_salted(df, id_col, text_col), spark.sparkContext.broadcast(borders), tokenizer, dtype, end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = docs = total = -1
        out: dict = {}
        temp: dict = {}

        def closed() -> Iterator[pa.RecordBatch]:
            for kind, handle in out.items():
                handle.close()
                os.replace(temp[kind], _files(folder, shard)[kind])
            if out:
                yield pa.RecordBatch.from_pydict({"shard": [shard], "docs": [docs], "ids": [total]}, schema=_arrow(MANIFEST))

        for batch in batches:
            shards = batch.column(0).to_numpy()
            for a, b in zip(*_runs(shards), strict=True):  # a task may hold several files, one after another
                if shards[a] != shard:
                    yield from closed()
                    shard, docs, total = int(shards[a]), 0, 0
                    temp = {k: f"{v}.{uuid.uuid4().hex}" for k, v in _files(folder, shard).items()}
                    out = {k: open(v, "wb") for k, v in temp.items()}
                    out["offsets"].write(np.zeros(1, "<i8").tobytes())
                raw, ends = buffers(batch.column(2).slice(a, b - a).cast(pa.large_binary()))
                raw.tofile(out["ids"])
                ends = ends // np.dtype(dtype).itemsize
                (ends[1:] + total).astype("<i8").tofile(out["offsets"])
                batch.column(1).slice(a, b - a).to_numpy().astype("<i8").tofile(out["docs"])
                docs, total = docs + int(b - a), total + int(ends[-1])
        yield from closed()

    # one row per file comes to the driver
    dealt = encoded.repartitionById(len(borders.ids) + 1, F.col("shard")).sortWithinPartitions("shard", "id", "salt").select("shard", "id", "ids")
    made = sorted(tuple(r) for r in dealt.mapInArrow(write, MANIFEST).collect())
    bases = list(accumulate((m[2] for m in made), initial=0))
    shards = [{"shard": s, "docs": d, "ids": n, "base": b} for (s, d, n), b in zip(made, bases, strict=False)]
    with open(f"{folder}/manifest.json.new", "w") as f:
        json.dump({"dtype": dtype, "ids": bases[-1], "shards": shards}, f)
    os.replace(f"{folder}/manifest.json.new", f"{folder}/manifest.json")
    return folder


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Where runs of equal values begin and end."""
    inner = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return ([0, *inner], [*inner, len(values)]) if len(values) else ([], [])


def _dtype(tokenizer: str | None) -> str:
    return "<u2" if Encoder(tokenizer).vocab_size <= 1 << 16 else "<u4"


def _encoded(rows: DataFrame, borders: Broadcast, tokenizer: str | None, dtype: str, end_id: int | None) -> DataFrame:
    """Rows (shard, id, salt, ids): the file and the ids of each text and ``end_id``, as
    little-endian unsigned integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = Encoder.of_worker(tokenizer), np.dtype(dtype).itemsize
        for batch, text in slices(batches, "text", 4 << 20):
            ids, ends = encoder.encode(text)
            if end_id is not None:
                full = np.full(len(ids) + len(text), end_id, np.uint32)
                full[np.arange(len(ids)) + np.repeat(np.arange(len(text)), np.diff(ends))] = ids
                ids, ends = full, ends + np.arange(len(ends))
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer((ends * size).astype(np.int64).tobytes()), pa.py_buffer(ids.astype(dtype).tobytes())])
            shard = borders.value.file_of(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), batch.column(0), batch.column(1), packed.cast(pa.binary())], names=["shard", "id", "salt", "ids"])

    return rows.mapInArrow(encode, "shard int, id long, salt long, ids binary")


class TokenShard:
    """One shard, memory-mapped."""

    def __init__(self, folder: str, shard: int, dtype: str):
        names = _files(folder, shard)
        self.docs = np.memmap(names["docs"], "<i8", "r")
        self.offsets = np.memmap(names["offsets"], "<i8", "r")
        self.ids = np.memmap(names["ids"], dtype, "r") if os.path.getsize(names["ids"]) else np.zeros(0, "u4")

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


def manifest(folder: str) -> dict:
    with open(f"{folder}/manifest.json") as f:
        return json.load(f)


def read_token_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the files: id, ids before it, number of ids, their CRC-32."""
    told = manifest(folder)
    dtype = told["dtype"]
    rows = [(s["shard"], s["base"]) for s in told["shards"]]
    shards = spark.createDataFrame(rows, "shard long, base long")
    shards = shards.repartition(max(1, len(rows)), "shard") if rows else shards

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = TokenShard(folder, shard, dtype)
                for at in range(0, len(part), 20_000):
                    some = range(at, min(len(part), at + 20_000))
                    keys = np.asarray(part.docs[at : some.stop])
                    starts = np.asarray(part.offsets[at : some.stop])
                    ends = np.asarray(part.offsets[at + 1 : some.stop + 1])
                    crc = [zlib.crc32(part[i].astype("<u4").tobytes()) for i in some]
                    yield pa.RecordBatch.from_arrays([pa.array(keys, mask=keys == LOWEST), pa.array(starts + base), pa.array(ends - starts), pa.array(crc, pa.int64())], schema=_arrow(INDEX))

    return shards.mapInArrow(read, INDEX)


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, pa.int64()) for f in schema])
