"""Exact dedup with two-pass Bloom filtering, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free, materialize

#: Bits of the first pass's filter for each row: of the rows that are alone, one in so many hits it.
BITS_PER_ROW = 32
#: The first pass's filter is broadcast up to so many 64-bit words with a set bit (16 bytes each in
#: the relation); a larger one is joined with the narrow rows by a shuffle.
BROADCAST_WORDS = 2_000_000
#: Bits of the filter that is broadcast to the documents, for each repeated hash, and at most. Past
#: the bound more documents hit it by chance, and are shuffled though they are alone; none is lost.
BITS_PER_HASH = 32
MAX_FILTER_BITS = 1 << 28
#: Bits of one block of that filter, 4 KB.
BLOCK = 1 << 15


def repeated_bits(hashes: DataFrame, bits: int) -> DataFrame:
    """First pass: the bits that at least two rows set, as rows (word, bits) of 64 bits each.

    ``hashes`` has one column ``h``. Each row sets one bit. Only bit positions move, summed on the
    map side, so a hash that a third of all rows share leaves each task as one count.
    """
    twice = hashes.groupBy(F.pmod("h", F.lit(bits)).alias("pos")).agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy(F.expr("pos >> 6").alias("word")).agg(F.bit_or(F.expr("1L << cast(pos & 63 as int)")).alias("bits"))


def flag_repeated(rows: DataFrame, filter_bits: DataFrame, bits: int) -> DataFrame:
    """Second pass: adds ``repeated``, true for every narrow row whose ``h`` another row may share."""
    side = filter_bits.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    small = side.count() <= BROADCAST_WORDS
    at = F.pmod("h", F.lit(bits))
    found = rows.withColumn("_at", at).join(F.broadcast(side) if small else side, F.expr("_at >> 6") == F.col("_word"), "left")
    found = found.withColumn("repeated", F.expr("coalesce(_bits & (1L << cast(_at & 63 as int)), 0) != 0")).drop("_at", "_word", "_bits")
    return found if small else materialize(found, "exact-flagged")


def _bits(rows: int) -> int:
    return 64 * max(1, -(-rows * BITS_PER_ROW // 64))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: its group of equal texts and which row of it stays.

    Columns: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``. The row with the
    largest id stays. Rows that the filter shows to be alone pass straight through; the others are
    shuffled as narrow rows, never with their texts. A hot group is summed on the map side, and the
    join that brings its result back is one that Spark splits.

    Null texts count as the empty text and are equal to it; texts of any length are hashed whole.
    Null ids are the smallest; of rows with equal ids exactly one stays. An empty table gives an
    empty one. Other columns are not read, whatever their names and types.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = materialize(df.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row")), "exact-rows")
    bits = _bits(rows.count())
    found = materialize(repeated_bits(rows.select("h"), bits), "exact-filter")
    flagged = flag_repeated(rows, found, bits)
    maybe = materialize(flagged.where("repeated").select("id", "sha", "row"), "exact-maybe")
    # a written table, so that both sides of the join are plain exchanges and a hot one is split
    groups = materialize(maybe.groupBy("sha").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("size")), "exact-groups")
    shared = maybe.join(groups, "sha").select(F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("keep.row")).alias("kept"), F.col("sha").alias("text_sha256"))
    alone = flagged.where("NOT repeated").select(F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return alone.unionByName(shared)


def repeated_hashes(hashes: DataFrame) -> DataFrame:
    """The values of ``h`` that several rows have: both passes, then an exact count of the rest."""
    bits = _bits(hashes.count())
    found = materialize(repeated_bits(hashes, bits), "exact-filter")
    maybe = flag_repeated(hashes, found, bits).where("repeated")
    exact = materialize(maybe.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "exact-repeated", small=True)
    free(found)
    return exact


def _filter_bits(hashes: int) -> int:
    return min(MAX_FILTER_BITS, max(BLOCK, 1 << (hashes * BITS_PER_HASH - 1).bit_length())) if hashes else BLOCK


def _places(bits: int) -> list[Column]:
    """The two bits of a hash in a filter of ``bits``."""
    return [F.pmod("h", F.lit(bits)), F.pmod(F.xxhash64("h"), F.lit(bits))]


def hash_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """A Bloom filter of hashes (h) as rows (block, map) of ``BLOCK`` bits, at most ``bits`` in all."""
    places = hashes.select(F.explode(F.array(*_places(bits))).alias("pos"))
    return places.groupBy(F.expr(f"pos div {BLOCK}").alias("block")).agg(F.bitmap_construct_agg(F.expr(f"pos % {BLOCK}")).alias("map"))


def _with_hit(df: DataFrame, blocks: DataFrame, bits: int) -> DataFrame:
    """Adds ``hit``: whether ``h`` may be in the filter, which is broadcast."""
    hit = F.lit(True)
    for k, place in enumerate(_places(bits)):
        side = F.broadcast(blocks.select(F.col("block").alias(f"block{k}"), F.col("map").alias(f"map{k}")))
        df = df.withColumn(f"at{k}", place).join(side, F.expr(f"at{k} div {BLOCK}") == F.col(f"block{k}"), "left")
        byte = f"cast(conv(hex(substring(map{k}, cast(at{k} % {BLOCK} as int) div 8 + 1, 1)), 16, 10) as int)"
        hit = hit & F.expr(f"coalesce(shiftright({byte}, cast(at{k} % 8 as int)) & 1, 0) = 1")
    return df.withColumn("hit", hit)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, T.MapType | T.VariantType)


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without repeated texts, all columns kept; the row with the largest id stays.

    Only hashes are counted. The repeated ones are sent to the documents as a filter of bounded
    size: documents that miss it pass straight through, in the order they are read, and of the
    others each task sends on one row of each text. So no document is shuffled that is alone, but
    for chance hits of the filter.

    Null texts count as the empty text and are equal to it; texts of any length are hashed whole.
    Null ids are the smallest. Of rows with equal ids and texts exactly one stays; a hash of the
    other columns, maps and variants aside, decides. An empty table stays empty. Columns of any
    name and type pass through.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    hashes = materialize(df.select(F.xxhash64(text).alias("h")), "exact-hashes")
    repeated = repeated_hashes(hashes)
    bits = _filter_bits(repeated.count())
    blocks = materialize(hash_filter(repeated, bits), "exact-blocks", small=True)
    free(hashes, repeated)
    # the columns travel as one, so that none can clash with those added here
    whole = df.select(F.struct(*[F.col(f"`{n}`") for n in df.columns]).alias("doc"), text.alias("text"), F.xxhash64(text).alias("h"))
    tested = _with_hit(whole, blocks, bits)
    others = [F.col("doc")[f.name] for f in df.schema if _orderable(f.dataType)]
    best = tested.where("hit").groupBy(F.sha2("text", 256).alias("sha")).agg(F.max_by("doc", F.struct(F.col("doc")[id_col], F.xxhash64(*others))).alias("doc"))
    return tested.where("NOT hit").select("doc").unionByName(best.select("doc")).select("doc.*")
