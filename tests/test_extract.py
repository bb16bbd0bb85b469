import json

import pytest
from pyspark.sql import functions as F

from turnloom.operators import extract


def test_retries():
    calls, slept = [], []

    def model(system, user):
        calls.append(user)
        if len(calls) < 3:
            raise RuntimeError("429 rate limit")
        return "ok"

    assert extract.with_retries(model, sleep=slept.append)("s", "u") == "ok" and slept == [2.0, 4.0]
    calls.clear()
    slept.clear()
    assert extract.with_retries(model, 4, extract.rate_aware_pause, slept.append)("s", "u") == "ok" and slept == [5.0, 10.0]
    assert extract.rate_aware_pause(1, RuntimeError("boom")) == 3.0
    calls.clear()
    with pytest.raises(RuntimeError):
        extract.with_retries(model, 2, sleep=slept.append)("s", "u")


def make_model():
    def model(system, user):
        if "bad" in user:
            raise ValueError("no")
        return json.dumps([{"role": "R", "dialogue": line} for line in user.split()])

    return model


def test_failed_chunks_leave_errors(spark):
    chunks = spark.createDataFrame([(0, 0, "a b"), (0, 1, "bad"), (0, 2, "b c"), (0, 3, None)], "doc_id long, chunk_id long, chunk string")
    got = {r.chunk_id: r for r in extract.call_model(chunks, make_model, "s", "chunk", parallel=2).collect()}
    assert got[1].response is None and got[1].error == "ValueError: no" and got[0].error is None and got[3].response == "[]"
    replies = extract.call_model(chunks, make_model, "s", "chunk")
    lines = extract.extract_lines(replies.withColumn("chunk_id", F.col("chunk_id")))
    assert sorted(map(tuple, lines.collect())) == [(0, 0, "R", "a"), (0, 1, "R", "b"), (2, 1, "R", "c")]
    dense = extract.extract_lines(replies, "dense", chunk_text=True)
    assert sorted((r.chunk_id, r.dialogue_index, r.chunk_text) for r in dense.collect()) == [(0, 0, "a b"), (0, 1, "a b"), (2, 0, "b c")]
    assert extract.call_model(chunks.limit(0), make_model, "s", "chunk").count() == 0


def test_prompt():
    attributes = [{"name": "role", "type": "String", "description": "who"}, {"name": "d", "type": "String", "description": "what"}]
    prompt = extract.extraction_prompt("lines", attributes, "EX")
    assert "script: Array<Dict( // lines\n    role: String // who,\n    d: String // what\n    )>" in prompt and prompt.endswith("Output:\nEX\n")
    assert extract.extraction_prompt("lines", attributes, "EX", "own {schema}|{example}", "{task}: {attributes}").startswith("own lines: role")


def test_batch_rewrite(spark):
    samples = [(i, [("human", f"ctx{i}\n甲：old"), ("gpt", f"line{i}")]) for i in range(5)]
    df = spark.createDataFrame(samples, "pos long, conversations array<struct<from:string,value:string>>")
    prompts = extract.rewrite_prompts(df, "甲", "P", 2).orderBy("batch").collect()
    assert [p.ids for p in prompts] == [[0, 1], [2, 3], [4]]
    assert "--- id=1 ---\n上下文：\nctx1\n甲原台词：line1\n" in prompts[0].prompt
    replies = spark.createDataFrame([([0, 1], '[{"id": 1, "user": " u ", "role": "r"}, {"id": 77, "user": "x", "role": "y"}]'), ([2, 3], "broken"), ([4], None)], "ids array<long>, response string")
    found, missing = extract.match_rewrites(replies, ("user", "role"))
    assert [tuple(r) for r in found.collect()] == [(1, " u ", "r")] and sorted(r.pos for r in missing.collect()) == [0, 2, 3, 4]
    items = extract.chat_items(found, "n", "sys", "user", "role").collect()
    assert items[0].id == "n-00001" and [m.value for m in items[0].conversations] == ["u", "r"]
    one = spark.createDataFrame([('ok {"user": "a", "role": "b"}',), ('{"user": "", "role": "b"}',), ("none",)], "x string")
    got = [r.v for r in one.select(extract.single_rewrite(F.col("x"), ("user", "role")).alias("v")).collect()]
    assert got[0].user == "a" and got[1:] == [None, None]
