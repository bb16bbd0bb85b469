import hashlib
import re
from collections import defaultdict

from turnloom.llm import exact


def test_groups_and_survivors(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, "a "), (7, "long " * 20_000), (8, "long " * 20_000), (None, "a"), (None, "only null"), (9, "rep"), (9, "rep")]
    docs = spark.createDataFrame([(a, b, f"s{i}", i, "h", 1) for i, (a, b) in enumerate(rows)], "doc_id long, text string, sha string, repeated int, h string, `doc.x` int")
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    got = exact.exact_groups(docs).collect()
    assert len(got) == len(rows)
    want = sorted(repr((k, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())) for k, t in rows)
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.kept for r in got if r.doc_id in (2, 4, 5, 6, 8))
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [2, 4, 5, 6, 8, 9]
    assert left.count() == len(groups)
    assert exact.exact_groups(docs.limit(0)).count() == 0 == exact.drop_exact_copies(docs.limit(0)).count()


def test_filter_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST_WORDS", 0)
    docs = spark.range(300).selectExpr("id AS doc_id", "cast(id % 100 AS string) AS text")
    got = exact.exact_groups(docs).collect()
    assert sum(r.kept for r in got) == 100 and {r.group_size for r in got} == {3}
    assert sorted(r.doc_id for r in exact.drop_exact_copies(docs).collect()) == list(range(200, 300))


def test_documents_that_are_alone_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST_WORDS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.range(3_000).selectExpr("id AS doc_id", "cast(if(id < 300, id % 100, id) AS string) AS text", "map('k', id) AS m")
        left = exact.drop_exact_copies(docs)
        plan = left._jdf.queryExecution().executedPlan().toString()
        # the one exchange of rows is that of documents that hit the filter; the others are its broadcasts
        assert len(re.findall(r"(?<!Broadcast)Exchange ", plan)) == 1
        assert "SortMergeJoin" not in plan
        got = left.collect()
        assert sorted(r.doc_id for r in got) == list(range(200, 3_000)) and all(r.m == {"k": r.doc_id} for r in got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact, "MAX_FILTER_BITS", 64)
    docs = spark.range(2_000).selectExpr("id AS doc_id", "cast(id % 700 AS string) AS text")
    assert sorted(r.doc_id for r in exact.drop_exact_copies(docs).collect()) == list(range(1_300, 2_000))


def test_one_of_rows_with_equal_ids_stays(spark):
    docs = spark.createDataFrame([(1, "a", k) for k in range(5)] + [(None, "b", 1), (None, "b", 2)], "doc_id long, text string, hit int")
    got = exact.drop_exact_copies(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "b"), (1, "a")]


def test_filters_pass_every_repeated_hash_and_few_others(spark):
    rows = spark.range(20_000).selectExpr("xxhash64(if(id < 500, id % 100, id)) AS h")
    bits = exact._bits(20_000)
    flagged = exact.flag_repeated(rows, exact.repeated_bits(rows, bits), bits).where("repeated").count()
    assert 500 <= flagged < 1_500
    repeated = exact.repeated_hashes(rows)
    assert repeated.count() == 100
    size = exact._filter_bits(100)
    tested = exact._with_hit(rows, exact.hash_filter(repeated, size), size)
    assert 500 <= tested.where("hit").count() < 520
