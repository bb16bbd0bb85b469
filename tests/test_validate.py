import json

import pytest

from turnloom.operators import validate
from turnloom.operators.validate import DatasetValidationError, dataset_stats, json_sample_errors, sample_errors, validate_samples
from turnloom.plans import steps
from turnloom.schemas import SAMPLE

PAIR = [{"from": "human", "value": "hello"}, {"from": "gpt", "value": "hi there"}]


def samples(spark, talks, system="s"):
    return spark.createDataFrame([(str(i), system, t) for i, t in enumerate(talks)], SAMPLE)


def test_valid_row_gives_figures(spark):
    found = validate_samples(samples(spark, [PAIR]))
    assert found["examples"] == 1 and found["min_turns"] == found["max_turns"] == 2
    assert found["avg_user_chars"] == 5 and found["avg_assistant_chars"] == 8 and found["avg_turns"] == 2


def test_missing_reply_is_refused(spark):
    with pytest.raises(DatasetValidationError, match="too_few"):
        validate_samples(samples(spark, [PAIR[:1]]), "id")


def test_file_is_read(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps([{"conversations": PAIR}]), encoding="utf-8")
    (found,) = steps.validate_files(spark, [str(path)])
    assert found["examples"] == 1 and found["path"] == str(path)


def h(v):
    return {"from": "human", "value": v}


def g(v):
    return {"from": "gpt", "value": v}


CASES = [
    (None, "too_few_turns"), ([], "too_few_turns"), ([h("a"), g("b")], None), ([h("a"), g(" \n")], "invalid_content"), ([h("a"), {"from": "", "value": "b"}], "invalid_role"),
    ([h("a"), {"from": "system", "value": "b"}], "unsupported_role"), ([g("a"), g("b")], "must_start_human_end_gpt"), ([h("a"), h("b")], "must_start_human_end_gpt"),
    ([h("a"), h("b"), g("c")], None), ([{"from": "x", "value": "a"}, h("")], "unsupported_role"),
]


def test_typed_rules(spark):
    got = [r.error for r in sample_errors(samples(spark, [c for c, _ in CASES])).orderBy("id").collect()]
    assert got == [e for _, e in CASES]
    counts = {r.error: r.n_rows for r in validate.error_counts(samples(spark, [c for c, _ in CASES])).collect()}
    assert counts["ok"] == 2 and sum(counts.values()) == len(CASES)


def test_raw_rules(spark):
    rows = [(json.dumps({"conversations": c}), e) for c, e in CASES]
    rows += [
        (json.dumps({"conversations": PAIR, "system": None}), None), (json.dumps({"conversations": PAIR, "system": 5}), "system_not_string"), (json.dumps({"conversations": PAIR, "system": "s"}), None),
        (json.dumps({"conversations": [h("a"), {"from": "gpt", "value": 7}]}), "invalid_content"), (json.dumps({"conversations": [h("a"), {"from": 1, "value": "x"}]}), "invalid_role"),
        (json.dumps({"conversations": [h("a"), "text"]}), "message_not_object"), (json.dumps({"conversations": "text"}), "too_few_turns"), ("not json", "too_few_turns"), ("7", "too_few_turns"),
    ]
    df = spark.createDataFrame([(i, j) for i, (j, _) in enumerate(rows)], "n int, json string")
    got = json_sample_errors(df).orderBy("n").collect()
    assert [r.error for r in got] == [e for _, e in rows]
    assert got[2].conversations[0].value == "a" and got[12].system == "s"


def test_lowest_bad_row_wins_and_empty_is_refused(spark):
    with pytest.raises(DatasetValidationError, match="row 1: must_start"):
        validate_samples(samples(spark, [PAIR, [g("a"), g("b")], [h("a")]]), "id")
    with pytest.raises(DatasetValidationError, match="empty"):
        validate_samples(samples(spark, []))


def test_figures_by_group(spark):
    df = samples(spark, [PAIR, [h(" abc "), h("d"), g("é😀")]])
    got = {r.id: r for r in dataset_stats(df, "id").collect()}
    assert (got["1"].user_messages, got["1"].user_chars, got["1"].max_user_chars, got["1"].assistant_chars) == (2, 4, 3, 2)
    assert dataset_stats(df.limit(0)).first().examples == 0
