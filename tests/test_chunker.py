import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from turnloom.operators import chunker
from turnloom.operators.chunker import chunk_documents, chunk_text, count_characters, split_long_line


def test_plain_cases():
    assert chunk_text("") == [] == chunk_text(" \n\t\n")
    assert chunk_text("one") == ["one"]
    assert chunk_text("a\n\n b \nc", max_tokens=10, overlap_tokens=2) == ["a\nb\nc"]


def test_lines_that_fill_the_budget():
    # each line costs its length and a line feed
    assert chunk_text("aaaa\nbbbb\ncccc", max_tokens=10, overlap_tokens=0) == ["aaaa\nbbbb", "\ncccc"]
    assert chunk_text("aaaa\nbbbb\ncccc", max_tokens=10, overlap_tokens=4) == ["aaaa\nbbbb", "aaaa\ncccc"]


def test_overlap_takes_the_oldest_that_fit():
    text = "aa\nbbbbbb\nc\ndddddddddd"
    # of aa, bbbbbb and c the first and the last fit into three
    assert chunk_text(text, max_tokens=20, overlap_tokens=3) == ["aa\nbbbbbb\nc", "aa\nc\ndddddddddd"]


def test_line_that_fits_only_without_overlap():
    assert chunk_text("a" * 10, max_tokens=10, overlap_tokens=2) == ["a" * 10]
    assert chunk_text("bb\n" + "a" * 8 + "\ncc", max_tokens=10, overlap_tokens=2) == ["bb", "a" * 8, "bb\ncc"]


def test_long_lines():
    assert split_long_line("ab。cd。ef", count_characters, 6) == ["ab。cd。", "ef"]
    assert split_long_line("abcdefghij。k", count_characters, 4) == ["abcdefghij。", "k"]
    assert chunk_text("x\n" + "ab。" * 4 + "\ny", max_tokens=6, overlap_tokens=1) == ["x\n", "ab。ab。", "ab。ab。", "y"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab。 \n", max_size=30), max_size=30), st.integers(2, 25), st.integers(0, 24))
def test_properties(parts, most, overlap):
    overlap = min(overlap, most - 1)
    text = "\n".join(parts)
    chunks = chunk_text(text, max_tokens=most, overlap_tokens=overlap)
    joined = "\n".join(chunks)
    for line in (s.strip() for s in text.split("\n")):
        if line and len(line) <= most:
            assert any(line in c.split("\n") for c in chunks)
        elif line:
            assert line.replace("\n", "") in joined.replace("\n", "")
    for c in chunks:
        assert len(c.strip()) <= most + chunker.LOOK_BACK or "\n" not in c.strip()


def test_documents(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, None), (None, "x"), (4, ""), (1, "a\nb"), (5, "word " * 50_000)], "doc_id long, text string")
    docs = docs.withColumn("chunk_id", docs.doc_id)
    got = sorted(map(tuple, chunk_documents(docs, ends=".").collect()), key=repr)
    assert [g for g in got if g[0] != 5] == sorted([(1, 0, "a\nb", 3)] * 2 + [(None, 0, "x", 1)], key=repr)
    assert chunk_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chunk_documents(docs, max_tokens=5, overlap_tokens=5)


def test_counter_is_pluggable(spark):
    words = lambda texts: [len(t.split()) for t in texts]
    docs = spark.createDataFrame([(1, "a b c\nd e\nf")], "doc_id long, text string")
    got = chunk_documents(docs, count=words, max_tokens=6, overlap_tokens=1).orderBy("chunk_id").collect()
    assert [(r.chunk, r.n_tokens) for r in got] == [("a b c", 3), ("\nd e\nf", 3)]


def test_table_matches_a_loop_over_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = [(d.doc_id, i, c, len(c)) for d in docs.collect() for i, c in enumerate(chunk_text(d.text, ends=".!?"))]
    random.Random(1).shuffle(want)
    assert sorted(map(tuple, chunk_documents(docs, ends=".!?").collect())) == sorted(want)
