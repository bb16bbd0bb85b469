"""MinHash near-dedup with tensored banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_FOLD, bound_batches, free, materialize, slices, Words

#: Words of a shingle.
SHINGLE = 5
#: Each table key joins two half keys of ROWS minhashes, one from each of two collections of HALF
#: half keys: HALF * HALF tables from 2 * HALF * ROWS minhashes. A pair at the threshold of 0.85
#: shares a table with probability (1 - (1 - 0.85**4)**16)**2 = 0.99998.
HALF = 16
ROWS = 4

#: Documents are linked from this similarity on, in hundredths.
SIMILARITY = 85
#: Ids of colliding documents that are broadcast to fetch their texts; more are joined by shuffle.
BROADCAST_IDS = 4_000_000

_IS_WORD = np.ones(256, np.int8)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = 0
_random = np.random.default_rng(11)
_MULTIPLY = _random.integers(0, 1 << 63, 2 * HALF * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(29))) * _STEP
    return x ^ (x >> np.uint64(32))


def shingle_sets(text: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text and the offsets of the texts in them.

    A text of fewer than ``k`` words, but not none, has its whole word sequence as one shingle.
    """
    words = Words(text, _IS_WORD, ASCII_FOLD)
    n, offsets = len(words), words.offsets
    full = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        full = full * _STEP + words.hashes[j : j + len(full)]
    full = mixed(full)
    sets, sizes = [], np.zeros(len(offsets) - 1, np.int64)
    for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a >= k:
            found = np.unique(full[a : b - k + 1])
        elif b > a:
            value = np.uint64(b - a)
            for h in words.hashes[a:b]:
                value = np.uint64((int(value) * int(_STEP) + int(h)) & 0xFFFFFFFFFFFFFFFF)
            found = mixed(np.array([value], np.uint64))
        else:
            continue
        sets.append(found)
        sizes[d] = len(found)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def sketches(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set: 128 bits that stand for the whole set, and its 2 * HALF half keys.

    Empty sets have half keys of zero.
    """
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    starts = offsets[:-1][full]
    whole = np.zeros((len(sizes), 2), np.uint64)
    keys = np.zeros((len(sizes), 2 * HALF), np.uint64)
    if len(full):
        whole[full, 0] = np.add.reduceat(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
        whole[full, 1] = np.add.reduceat(mixed(values + np.uint64(0x14057B7EF767814F)), starts)
        for i in range(2 * HALF):
            key = np.full(len(full), i + 1, np.uint64)
            for r in range(ROWS):
                key = mixed(key + np.minimum.reduceat(values * _MULTIPLY[i * ROWS + r], starts))
            keys[full, i] = key
    return whole.view(np.int64), keys.view(np.int64)


def sketch_documents(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """Rows (id, n, w1, w2, keys): the size of the shingle set, its 128 bits and its half keys."""
    schema = pa.schema([("n", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text", 1 << 20):
            values, offsets = shingle_sets(text, shingle)
            whole, keys = sketches(values, offsets)
            n = np.diff(offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(np.ascontiguousarray(whole[:, 0])), pa.array(np.ascontiguousarray(whole[:, 1])), lists], names=["id", *schema.names])

    narrow = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(sketch, "id long, n long, w1 long, w2 long, keys array<long>")


def _colliding(classes: DataFrame) -> DataFrame:
    """Rows (rep, n, keys) of classes that share a half key of either collection with others.

    ``keys`` are (place, key) of the shared ones. A pair that shares no such keys shares no table,
    so this asks for 2 * HALF keys of each document instead of HALF * HALF.
    """
    each = classes.select("rep", "n", F.posexplode("keys").alias("place", "key"))
    shared = materialize(each.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "near-keys", small=True)
    found = each.join(shared, "key", "left_semi").groupBy("rep", "n").agg(F.collect_list(F.struct("place", "key")).alias("keys"))
    both = F.exists("keys", lambda k: k["place"] < HALF) & F.exists("keys", lambda k: k["place"] >= HALF)
    return found.where(both)


def _shingles_of(df: DataFrame, ids: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Rows (rep, shingles) of the documents in ``ids`` (rep), one for each."""
    narrow = df.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    few = ids.count() <= BROADCAST_IDS
    texts = narrow.join(F.broadcast(ids) if few else ids, "rep", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text", 1 << 20):
            values, offsets = shingle_sets(text, shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))], names=["rep", "shingles"])

    return texts.mapInArrow(sets, "rep long, shingles array<long>").dropDuplicates(["rep"])


def _alone(sets: DataFrame) -> DataFrame:
    """Rows (rep, u): how many shingles of each document no other document of ``sets`` has."""
    each = sets.select("rep", F.explode("shingles").alias("s"))
    counted = each.groupBy("s").agg(F.count("*").alias("c"), F.min("rep").alias("rep"))
    return counted.where("c = 1").groupBy("rep").agg(F.count("*").alias("u"))


def _most_common(n: Column, u: Column, m: Column, v: Column) -> Column:
    """How many shingles sets of sizes n and m with u and v of their own can have in common."""
    return F.least(n - u, m - v)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets reach the similarity."""
    left, right = (sets.select(F.col("rep").alias(k), F.col("shingles").alias(f"s{k}")) for k in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    sized = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return sized.where(100 * F.col("common") >= similarity * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) of every node of ``edges`` (a, b): the smallest node it is linked with.

    Alternates large and small stars: every node hands its larger neighbours to its smallest one,
    then its smaller neighbours, until the edges are stars. Each round is written to the shared
    folder; the number of rounds grows with the logarithm of a component's size.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "star", small=True)
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        before = state
        around = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(lowest, "hi")
        small = small.select("hi", F.col("m").alias("lo")).unionByName(small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct()
        edges = materialize(small, "star", small=True)


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (the smallest id reachable) and ``kept``.

    1. Sketches: each set gives two collections of half keys; equal sets become one class.
    2. Classes that share half keys of both collections with others go on. Of these, any that has
       too many shingles of its own to reach the similarity with any other is linked with none.
    3. Table keys pair the half keys. In every table a class is compared with the smallest one of
       its bucket, on whole sets. Components of these links are found.
    4. Of tables that still span several components, every class is compared with the smallest one
       of its first half key, and those pairs across components with each other which their
       sizes, the shingles that only one component has, and their rarest common difference from
       that one allow. So no pair that shares a table goes untested unless it is already connected
       or its similarity is provably too low.

    Ids should be unique and are whole numbers; repeated rows share a component and are all kept
    or not. Rows without words, null texts among them, are components of their own. A row with a
    null id belongs to the component of its copies, and is kept only if it has none. Long texts
    are read whole: a set is one row. An empty table gives an empty one. Other columns are not
    read, whatever their names.
    """
    bound_batches(df.sparkSession)
    rows = materialize(sketch_documents(df, id_col, text_col, shingle), "near-sketches")
    named = rows.where("n > 0 AND id IS NOT NULL")
    classes = materialize(named.groupBy("w1", "w2", "n").agg(F.min("id").alias("rep"), F.first("keys").alias("keys")), "near-classes", small=True)
    colliding = materialize(_colliding(classes), "near-colliding", small=True)
    sets = materialize(_shingles_of(df, colliding.select("rep"), id_col, text_col, shingle), "near-sets")
    able = colliding.join(_alone(sets), "rep", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    able = materialize(able.where(100 * (F.col("n") - F.col("u")) >= similarity * F.col("n")), "near-able", small=True)
    free(colliding)

    links = materialize(_verified(_stars(able, similarity), sets, similarity), "near-links", small=True)
    found = components(links)
    near, pairs = _across(able, found, sets, similarity)
    pairs = materialize(pairs, "near-across", small=True)
    more = materialize(near.unionByName(_verified(pairs, sets, similarity)), "near-more", small=True)
    if more.limit(1).count():
        found = components(links.unionByName(more))
    roots = found.withColumnRenamed("node", "rep")

    members = classes.join(roots, "rep", "left").select("w1", "w2", "n", F.coalesce("root", "rep").alias("component"))
    members = materialize(members, "near-members", small=True)
    free(classes, sets, able, pairs)
    out = rows.select("id", "n", "w1", "w2").where("n > 0").join(members, ["w1", "w2", "n"], "left").select("id", "n", "component")
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component"))
    both = out.unionByName(empty)
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def drop_near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """``df`` with one row of each component, the one of the smallest id, all columns kept.

    Only the ids to drop are joined, broadcast up to ``BROADCAST_IDS`` of them, else by shuffle.
    Rows with a null id cannot be named and stay; so do all rows that share a kept id. Rows without
    words stay; an empty table stays empty; columns of any name pass through.
    """
    found = near_duplicates(df, id_col=id_col, text_col=text_col, shingle=shingle, similarity=similarity)
    gone = materialize(found.where(~F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("gone")).distinct(), "near-gone", small=True)
    few = gone.count() <= BROADCAST_IDS
    # the columns travel as one, so that none can clash with the ids
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    return whole.join(F.broadcast(gone) if few else gone, F.col("row")[id_col].cast("long") == F.col("gone"), "left_anti").select("row.*")


def _stars(able: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of the smallest class of a table bucket and each other class in it."""
    first_half, second_half = F.filter("keys", lambda k: k["place"] < HALF), F.filter("keys", lambda k: k["place"] >= HALF)
    one = able.select("rep", "n", "u", F.explode(first_half).alias("p"), second_half.alias("others"))
    tables = one.select("rep", "n", "u", F.col("p.key").alias("p"), F.explode("others.key").alias("q")).select("rep", "n", "u", F.xxhash64("p", "q").alias("t"))
    first = tables.groupBy("t").agg(F.min(F.struct("rep", "n", "u")).alias("f"), F.count("*").alias("c")).where("c > 1").select("t", F.col("f.rep").alias("a"), F.col("f.n").alias("m"), F.col("f.u").alias("v"))
    first = materialize(first, "near-buckets", small=True)
    most = _most_common(F.col("n"), F.col("u"), F.col("m"), F.col("v"))
    fits = 100 * most >= similarity * (F.col("n") + F.col("m") - most)
    return tables.join(first, (tables.t == first.t) & (F.col("rep") != F.col("a")) & fits).select("a", F.col("rep").alias("b")).distinct()


def _own(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (rep, v): how many shingles of each of ``classes`` (rep, root) no class of another
    component among them has."""
    each = classes.join(sets, "rep").select("rep", "root", F.explode("shingles").alias("s"))
    one = each.groupBy("s").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x = y").select("s")
    return each.join(one, "s", "left_semi").groupBy("rep").agg(F.count("*").alias("v"))


def _apart(sides: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """``sides`` with the shingles that only one of a class and its pivot has, ``d``, and its
    ``score`` (100 + k)|d| - (100 - k)n.

    Of classes with the pivot in common, the shingles in which two differ are those in one d alone.
    So they reach k hundredths exactly if 2(100 + k) times what both d have in common is at least
    the sum of their scores.
    """
    left, right = sets.select(F.col("rep").alias("pivot"), F.col("shingles").alias("sa")), sets.select("rep", F.col("shingles").alias("sb"))
    both = sides.join(right, "rep").join(left, "pivot")
    d = F.concat(F.array_except("sb", "sa"), F.array_except("sa", "sb"))
    out = both.withColumn("d", d).drop("sa", "sb")
    return out.withColumn("score", (100 + similarity) * F.size("d") - (100 - similarity) * F.col("n"))


def _across(able: DataFrame, found: DataFrame, sets: DataFrame, similarity: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of classes with pivots, and the other pairs (a, b) of classes in different
    components that share a table and may be similar enough.

    Tables that have the first half key in common are walked together. Keys whose classes are all
    of one component are closed.

    What two classes share are at most the shingles that neither's component has to itself, n - v
    and m - w of them; so their similarity reaches k hundredths only if (100 - k)(n + m) >=
    (100 + k)(v + w). The slack of a class is its own share of this. Of any pair one class has no
    negative slack, so a key all of whose classes have it is closed.

    The classes of a key are seen from its smallest one, the pivot, by what they differ in (see
    ``_apart``). No score is below the pivot's, -(100 - k) times its size; so of two classes whose
    scores add up to no more than 0 both are similar to the pivot. Any others must have some of
    their differences in common. Ordered by the number of classes that have them, rare ones first,
    the first common one must leave enough of them on both sides. What all copies of a text have
    in common is not compared, nor are edits that one component has to itself.
    """
    first_half = F.filter("keys", lambda k: k["place"] < HALF)
    rooted = able.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    each = rooted.select("rep", "n", "root", F.explode(F.transform(first_half, lambda k: k["key"])).alias("key"))
    spans = each.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
    left = materialize(each.join(materialize(spans, "near-open", small=True), "key", "left_semi"), "near-halves", small=True)
    own = materialize(_own(left.select("rep", "root").distinct(), sets), "near-own", small=True)
    slack = (100 - similarity) * F.col("n") - (100 + similarity) * F.col("v")
    sides = left.join(own, "rep", "left").withColumn("v", F.coalesce("v", F.lit(0))).withColumn("slack", slack)
    top = sides.groupBy("key").agg(F.max("slack").alias("top"), F.min(F.struct("rep", "root", "n")).alias("p")).where("top >= 0")
    sides = sides.join(top, "key").where("slack + top >= 0 AND rep <> p.rep")
    sides = sides.select(F.col("p.rep").alias("pivot"), F.col("p.root").alias("home"), F.col("p.n").alias("size"), "rep", "n", "v", "root", "slack").distinct()
    sides = materialize(_apart(materialize(sides, "near-sides", small=True), sets, similarity), "near-apart", small=True)
    free(left, own)

    near = F.col("score") <= (100 - similarity) * F.col("size")
    links = sides.where(near & (F.col("root") != F.col("home"))).select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    # in what follows, all that are similar to the pivot are of its component
    sides = sides.withColumn("root", F.when(near, F.col("home")).otherwise(F.col("root")))
    away = F.when(F.col("root") != F.col("home"), F.col("score"))
    least = sides.groupBy("pivot").agg(F.min("score").alias("lowest"), F.min(away).alias("away")).where("away IS NOT NULL")
    sides = sides.join(least, "pivot").withColumn("lowest", F.when(F.col("root") == F.col("home"), F.col("away")).otherwise(F.col("lowest")))
    reach = 2 * (100 + similarity)
    sides = sides.where(reach * F.size("d") >= F.col("score") + F.col("lowest")).drop("home", "size", "away")
    each = sides.withColumn("t", F.explode("d")).drop("d")
    shared = each.groupBy("pivot", "t").agg(F.count("*").alias("c"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("pivot", "t", "c")
    what = ["pivot", "rep", "n", "v", "root", "slack", "score", "lowest"]
    ordered = each.join(shared, ["pivot", "t"]).groupBy(*what).agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("d"))
    # ``most``: twice the most that can be in common from here on, in the unit of the scores
    marks = ordered.select(*what, F.size("d").alias("z"), F.posexplode("d").alias("i", "t")).withColumn("most", reach * (F.col("z") - F.col("i")))
    marks = marks.where("most >= score + lowest").select(*what[:-1], F.col("t.t").alias("t"), "most")
    marks = materialize(marks, "near-marks", small=True)
    a, b = marks.alias("a"), marks.select("pivot", "t", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "v", "root", "slack", "score", "most")]).alias("b")
    common = _most_common(F.col("n"), F.col("v"), F.col("n2"), F.col("v2"))
    fits = 100 * common >= similarity * (F.col("n") + F.col("n2") - common)
    pair = (F.col("rep") < F.col("rep2")) & (F.col("root") != F.col("root2")) & (F.col("slack") + F.col("slack2") >= 0) & fits
    pair &= F.least("most", "most2") >= F.col("score") + F.col("score2")
    same = (F.col("a.pivot") == F.col("b.pivot")) & (F.col("a.t") == F.col("b.t"))
    return links, a.join(b, same & pair).select(F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct()
