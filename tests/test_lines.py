import random

import pytest

from turnloom.operators import lines, split, stats

LINE = "chunk_id long, dialogue_index long, role string, dialogue string"


@pytest.fixture
def said(spark):
    rows = [(1, 0, "A", "Hi"), (1, 1, "A", "hi"), (1, 2, "A", "Hi"), (2, 0, "A", "Hi"), (2, 1, "B", "Hi"), (2, 2, None, None), (None, 0, "B", "x"), (0, 5, "B", "x")]
    return spark.createDataFrame(rows, LINE)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dedup(said):
    kept = rows(lines.dedup_lines(said))
    assert kept == sorted([(1, 0, "A", "Hi"), (1, 1, "A", "hi"), (2, 1, "B", "Hi"), (2, 2, None, None), (None, 0, "B", "x")], key=repr)
    dense = rows(lines.dedup_lines(said.where("chunk_id IS NOT NULL"), "dense"))
    assert (2, 0, "B", "Hi") in dense and (2, 1, None, None) in dense
    with pytest.raises(ValueError):
        lines.dedup_lines(said, "other")
    assert lines.dedup_lines(said.limit(0)).count() == 0


def test_filter_and_legacy(said, monkeypatch):
    assert lines.filter_chunks(said, [2, 0]).count() == 4 and lines.filter_chunks(said, [None]).count() == 1 and lines.filter_chunks(said, []).count() == 0
    monkeypatch.setattr(lines, "LITERAL_IDS", 1)
    assert lines.filter_chunks(said, [2, 0, None]).count() == 5
    assert ("", "") in rows(lines.legacy_lines(said))
    assert lines.nonempty_lines(said).count() == 7
    assert [r.chunk_id for r in lines.sort_lines(said).collect()][:2] == [None, 0]


def test_resume(spark):
    items = spark.createDataFrame([(1,), (2,), (None,), (2,)], "id long")
    done = spark.createDataFrame([(2, "old"), (9, "foreign")], "id long, v string")
    assert rows(lines.pending(items, done, "id")) == sorted([(1,), (None,)], key=repr)
    assert rows(lines.reused(items, done, "id")) == [(2, "old")]
    assert rows(lines.merge_results(lines.reused(items, done, "id"), lines.pending(items, done, "id"))) == sorted([(2, "old"), (1, None), (None, None)], key=repr)
    found, missing = lines.match_entries(items.where("id IS NOT NULL").distinct(), done)
    assert rows(found) == [(2, "old")] and rows(missing) == [(1,)]


def test_numbering(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1009 AS k", "id AS pos0").repartition(7)
    got = sorted((r.k, r.pos) for r in lines.number_rows(df, "k").collect())
    assert [p for _, p in got] == list(range(1000))
    assert {r.batch for r in lines.assign_batches(df, 300, "k").collect()} == {0, 1, 2, 3}
    assert lines.number_rows(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("n", [0, 1, 19, 20, 40, 333])
def test_split(spark, n):
    df = spark.range(n).selectExpr("concat('id', id) AS id")
    train, valid = split.split_rows(df, 0.05, seed=3)
    want = max(1, int(n * 0.05)) if n else 0
    assert (valid.count(), train.count()) == (want, n - want)
    assert not set(rows(train)) & set(rows(valid))
    ids = sorted((f"id{i}" for i in range(n)), key=lambda i: (__import__("hashlib").md5(f"3-{i}".encode()).hexdigest(), i))
    assert rows(valid) == sorted([(i,) for i in ids[:want]], key=repr)
    for most in (0, 5, n, n + 1):
        kept = rows(split.cap_rows(df, most, seed=3))
        assert kept == sorted([(i,) for i in (ids[:most] if 0 < most < n else ids)], key=repr)


@pytest.mark.parametrize("n, most", [(1, 0), (40, 0), (40, 15), (40, 40)])
def test_exact_split(spark, n, most):
    data = [f"{i:03d}" for i in range(n)]
    want = list(data)
    if 0 < most < n:
        random.Random(7).shuffle(want)
        want = want[:most]
    random.Random(7).shuffle(want)
    k = max(1, int(len(want) * 0.1))
    train, valid = split.split_rows_exact(spark.createDataFrame([(d,) for d in data], "id string"), 0.1, "id", most=most, seed=7)
    assert rows(valid) == [(i,) for i in sorted(want[:k])] and rows(train) == [(i,) for i in sorted(want[k:])]


def test_exact_split_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(split, "EXACT_ROWS", 3)
    with pytest.raises(ValueError):
        split.split_rows_exact(spark.range(4).selectExpr("cast(id AS string) AS id"), 0.5, "id")


def test_statistics(spark, said):
    report = stats.corpus_report(said)
    assert report["total_dialogues"] == 8 and report["role_distribution"] == {"A": 4, "B": 3, "Unknown": 1} and report["average_dialogue_length"] == 12 / 8
    assert stats.corpus_report(said.limit(0)) == {"total_dialogues": 0, "unique_roles": 0, "role_distribution": {}, "average_dialogue_length": 0}
    per = {r.chunk_id: r for r in stats.chunk_stats(said).collect()}
    assert set(per) == {0, 1, 2} and per[2].roles == {"A": 1, "B": 1, "Unknown": 1} and per[2].total_length == 4
    assert tuple(stats.chunk_summary(said).first()) == (3, 7) and tuple(stats.chunk_summary(said.limit(0)).first()) == (0, 0)
    assert [r.chunk_id for r in stats.busiest_chunks(said, 2).collect()] == [1, 2]
    assert [r.role for r in stats.top_roles(said, 2).collect()] == ["A", "B"]
    assert stats.effective_batch_size(4, 4) == 16
    from pyspark.sql import functions as F

    assert split.newest(spark.createDataFrame([("a", 1), ("b", 3)], "p string, n int"), F.col("n")).first().p == "b"
