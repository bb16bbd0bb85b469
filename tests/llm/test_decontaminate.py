import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from turnloom.llm import decontaminate, queries
from turnloom.llm.decontaminate import FmIndex, find_contamination, suffix_array, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def windows(items, size):
    out = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            out.setdefault(tuple(w[i : i + size]), set()).add(str(name))
    return out


def expected(text, found, size):
    w = words(text)
    lengths = {len(k) for k in found}
    hit, items = set(), set()
    for n in lengths:
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in found:
                hit |= set(range(i, i + n))
                items |= found[tuple(w[i : i + n])]
    return len(w), len(hit), sorted(items)


def spans_of(hit_count, spans):
    assert sum(b - a for a, b in spans) == hit_count and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_words_hash_apart():
    texts = ["Abba baab ABBA É é a-b", "", "x", "baab"]
    found = words_of(pa.array(texts, pa.large_string()))
    assert found.offsets.tolist() == [0, 7, 7, 8, 9]
    assert found.hashes[0] == found.hashes[2] != found.hashes[1] == found.hashes[8] and found.hashes[3] != found.hashes[4]
    assert len(words_of(pa.array(["ab", "cd", "", "e"], pa.large_string()))) == 3


def test_index_against_brute_force():
    rng = random.Random(5)
    for n in (1, 2, 30, 300):
        text = [rng.randint(1, 5) for _ in range(n)] + [0]
        array = np.array(text)
        assert suffix_array(array).tolist() == sorted(range(n + 1), key=lambda i: text[i:])
        index = FmIndex(array, 7, sample=3)
        phrases = [[rng.randint(1, 6) for _ in range(rng.randint(1, 4))] for _ in range(50)]
        starts = np.cumsum([0] + [len(p) for p in phrases])[:-1]
        low, high = index.search(np.array(sum(phrases, [])), starts, np.array([len(p) for p in phrases]))
        for p, a, b in zip(phrases, low, high, strict=True):
            want = [i for i in range(n) if text[i : i + len(p)] == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_op3_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = windows(items, 10)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op3_decontamination(spark, sf_dir).collect()
    assert len(got) == len(texts) and sum(r.contaminated for r in got) > 0
    for r in got:
        n, hits, names = expected(texts[r.doc_id], found, 10)
        assert tuple(r)[1:] == (n, hits, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hits > 0)


@pytest.mark.parametrize("shard, part", [(1, 1 << 20), (1 << 19, 1 << 20), (1 << 19, 60)])
def test_random_texts_and_odd_rows(spark, monkeypatch, shard, part):
    monkeypatch.setattr(decontaminate, "SHARD_SYMBOLS", shard)
    monkeypatch.setattr(decontaminate, "PART_BYTES", part)
    rng = random.Random(shard)
    text = lambda n: " ".join(rng.choice("aé Bc dd 7 x-y".split()) for _ in range(n))
    items = [(i, text(rng.choice([0, 2, 3, 5, 9]))) for i in range(12)] + [(12, None), (3, "a a a a"), (None, "7 7 7")]
    rows = [(i, text(rng.randint(0, 60)), 1, "q") for i in range(60)] + [(61, None, 1, "q"), (None, "a a a a", 1, "q"), (61, "", 1, "q"), (62, "A.a,A a " * 4000, 1, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit int, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(docs, bench, window=4).collect()
    found = windows([("" if i is None else i, t) for i, t in items], 4)
    want = sorted(repr((r[0], *expected(r[1], found, 4))) for r in rows)
    assert sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in got) == want
    for r in got:
        spans_of(r.n_hit, [tuple(s) for s in r.spans])
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert find_contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    clean = decontaminate.drop_contaminated(docs, bench, window=4)
    assert clean.columns == docs.columns and sorted(map(repr, map(tuple, clean.collect()))) == sorted(repr(r) for r in rows if not expected(r[1], found, 4)[1])
    assert decontaminate.drop_contaminated(docs.limit(0), bench, window=4).count() == 0


def test_a_benchmark_of_common_words(spark):
    """All words of the texts are in the index here; with the driver's benchmark hardly one in twenty is."""
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    common = [w for w, _ in Counter(w for t in texts for w in words(t)).most_common()]
    rng = random.Random(1)
    passage = words(max(texts, key=len))
    items = [(1, " ".join(common)), (2, " ".join(passage[40:52])), (3, " ".join(passage[100:104]))] + [(k, " ".join(rng.choice(common[:30]) for _ in range(12))) for k in range(4, 200)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = decontaminate.Phrases([(str(i), t) for i, t in items])
    shard = decontaminate._Shard(known)
    shard.add(pa.array(texts, pa.large_string()))
    assert shard.size == sum(len(words(t)) for t in texts if len(words(t)) >= known.shortest)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = windows(items, 10)
    for r in find_contamination(docs, bench).collect():
        assert (r.n_words, r.n_hit, r["items"]) == expected(texts[r.doc_id], found, 10)
