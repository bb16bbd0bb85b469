import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnloom.llm import near_dup, queries
from turnloom.llm.near_dup import components, near_duplicates, shingle_sets, sketches

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def expected(rows):
    """Brute force: all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        count = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    count[j] = count.get(j, 0) + 1
        for j, c in count.items():
            if 100 * c >= 85 * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), key), key)
    return sorted((key, len(sets[i]), smallest[find(i)], key == smallest[find(i)]) for i, (key, _) in enumerate(rows))


def test_shingles_and_sketches():
    texts = ["", "a b", "A b", "b a", "x y z v w u", "x y z v w u x y z v w u", "X  y\tz\x0bv\nw u", " "]
    values, offsets = shingle_sets(pa.array(texts, pa.large_string()))
    assert np.diff(offsets).tolist() == [len(shingles(t)) for t in texts]
    whole, keys = sketches(values, offsets)
    assert (whole[1] == whole[2]).all() and (whole[1] != whole[3]).any() and (keys[4] == keys[6]).all() and not keys[0].any()


def test_half_keys_agree_as_often_as_similar_sets_do():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(200):
        common, own = rng.integers(0, 1 << 63, 850, dtype=np.uint64), rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        a, b = np.unique(np.concatenate([common, own[:75]])), np.unique(np.concatenate([common, own[75:]]))
        _, keys = sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        agree.append((keys[0] == keys[1]).mean())
    assert np.mean(agree) == pytest.approx(0.85**4, abs=0.02)


def test_op8_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.op8_minhash_near_dedup(spark, sf_dir).collect())
    assert got == expected(rows) and sum(not r[3] for r in got) > 20


def test_chains_of_edits_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 3)
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randint(0, 99))
    rows, key = [], 0
    for _ in range(6):
        base = [word() for _ in range(rng.choice([30, 120, 200]))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                base = copy
            rows.append((key, " ".join(copy)))
            key += 1
    rows += [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (904, "same words " * 400), (905, "same words " * 500), (906, " "), (907, "one two three four five")]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, n long, keys int")
    got = near_duplicates(docs)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)
    assert near_duplicates(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "one two"), (5, "one two"), (5, "one two"), (None, "lone"), (None, None)], "doc_id long, text string")
    assert sorted(map(repr, (tuple(r)[2:] for r in near_duplicates(odd).collect()))) == sorted(map(repr, [(5, False), (5, True), (5, True), (None, True), (None, True)]))


def test_pairs_beside_the_smallest_member_are_found(spark):
    """Two clusters of one bucket whose members are not similar to its smallest document."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(400)]
    rows = []
    for cluster in range(6):
        own = [f"k{cluster}_{i}" for i in range(48)]
        for i in range(3):
            text = common + own
            text[rng.randrange(300)] = f"edit{cluster}{i}"
            rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == expected(rows)


def boilerplate(clusters, members):
    """Clusters that share 400 words with all others and 48 among themselves: all just below the threshold."""
    rng = random.Random(clusters)
    common = [f"c{i}" for i in range(400)]
    rows = []
    for cluster in range(clusters):
        own = [f"k{cluster}_{i}" for i in range(48)]
        for i in range(members):
            text = common + own
            text[rng.randrange(300)] = f"edit{cluster}{i}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("members, clusters", [(1, 5_000), (3, 200)])
def test_pairs_tested_grow_with_the_documents(spark, monkeypatch, members, clusters):
    tested = []
    verified = near_dup._verified
    monkeypatch.setattr(near_dup, "_verified", lambda pairs, *rest: tested.append(pairs.distinct().count()) or verified(pairs, *rest))
    rows = boilerplate(clusters, members)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == {k: k - k % members for k, _ in rows}
    assert sum(tested) <= 40 * len(rows)


def test_slack_of_components_closes_no_similar_pair(spark, monkeypatch):
    """With a star step that finds nothing, step 4 finds all links that share a table by itself."""
    empty = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(near_dup, "_stars", lambda able, similarity: empty)
    rng = random.Random(9)
    rows = []
    for base in range(12):
        words = [f"w{base % 4}_{i}" for i in range(150)] + [f"own{base}_{i}" for i in range(rng.choice([5, 15, 30]))]
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"e{rng.random()}"
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == expected(rows)


def edited_copies(copies):
    """Near copies of one text: words replaced, left out and put in, so that many miss each other narrowly."""
    rng = random.Random(copies)
    rows = []
    for key in range(copies):
        text = [f"b{i}" for i in range(80)]
        for _ in range(rng.randint(1, 4)):
            at, kind = rng.randrange(len(text)), rng.choice(["replace", "leave out", "put in"])
            text[at : at + (kind != "put in")] = [] if kind == "leave out" else [f"e{rng.random()}"]
        rows.append((key, " ".join(text)))
    return rows


def test_pairs_tested_across_components_of_one_group_of_near_copies(spark, monkeypatch):
    tested = []
    verified = near_dup._verified
    monkeypatch.setattr(near_dup, "_verified", lambda pairs, *rest: tested.append(pairs.distinct().count()) or verified(pairs, *rest))
    rows = edited_copies(1_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == expected(rows)
    assert len(tested) == 2 and tested[1] <= 2 * len(rows)


def test_differences_from_pivots_lose_no_link(spark, monkeypatch):
    """With a star step that finds nothing, pivots and rare differences find all links of the group."""
    empty = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(near_dup, "_stars", lambda able, similarity: empty)
    rows = [(2 * k, t) for k, t in edited_copies(300)] + [(2 * k + 1, t.replace("b7", "c7")) for k, t in edited_copies(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in near_duplicates(docs).collect())
    assert got == expected(rows) and 20 < sum(not r[3] for r in got) < 480


def test_dropped_rows_and_clashing_names(spark):
    rows = [(1, "a b c d e f g h", "x", 1), (2, "A b c d e f g h", "y", 2), (3, None, "z", 3), (None, "a b c d e f g h", "n", 4), (4, "long words " * 60_000, "l", 5), (5, "Long words " * 60_000, "l", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone string, `row` int").withColumn("__gone", docs_map())
    got = near_dup.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r["row"] for r in got.collect())) == [1, 3, 4, 5]
    assert near_dup.drop_near_duplicates(docs.limit(0)).count() == 0


def docs_map():
    return F.create_map(F.lit("k"), F.lit(1))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (202, 201), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(41), 100], 0), **dict.fromkeys([200, 201, 202], 200)}
