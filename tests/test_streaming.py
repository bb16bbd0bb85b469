import json

from turnloom.streaming import ingest


def put(folder, name, rows):
    (folder / name).write_text("".join(json.dumps(dict(zip(("chunk_id", "dialogue_index", "role", "dialogue"), r))) + "\n" for r in rows))


def test_lines_are_kept_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    put(source, "a.jsonl", [(1, 0, "A", "x"), (1, 1, "A", "x"), (1, 2, "B", "x")])
    ingest.dedup_stream(ingest.read_line_stream(spark, str(source)), out, checkpoint).awaitTermination()
    put(source, "b.jsonl", [(2, 0, "A", "x"), (2, 1, "A", "y")])
    ingest.dedup_stream(ingest.read_line_stream(spark, str(source)), out, checkpoint).awaitTermination()
    got = sorted((r.chunk_id, r.dialogue_index, r.role, r.dialogue) for r in spark.read.parquet(out).collect())
    assert got == [(1, 0, "A", "x"), (1, 2, "B", "x"), (2, 1, "A", "y")]
    ingest.dedup_stream(ingest.read_line_stream(spark, str(source)), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_running_counts(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    put(source, "a.jsonl", [(1, 0, "A", "x"), (1, 1, None, "x"), (None, 2, "B", "x")])
    query = ingest.chunk_counts_stream(ingest.read_line_stream(spark, str(source))).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("counts").collect())) == [(1, "A", 1), (1, "Unknown", 1)]


def echo():
    return lambda system, user: user.upper()


def test_model_stream(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([(0, 0, "a"), (0, 1, "b")], "doc_id long, chunk_id long, chunk string").write.parquet(str(source))
    stream = spark.readStream.schema("doc_id long, chunk_id long, chunk string").parquet(str(source))
    for _ in range(2):
        ingest.call_model_stream(stream, echo, "s", str(tmp_path / "out"), str(tmp_path / "cp"), 2).awaitTermination()
    assert sorted(r.response for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["A", "B"]
