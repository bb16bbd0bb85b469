import dataclasses
import json
import re

import pytest

from turnloom.config import load_settings
from turnloom.plans import cli, steps
from turnloom.sources import files

CALLS: list[str] = []


@pytest.fixture
def settings(tmp_path):
    (tmp_path / "n.txt").write_text("\n".join(f"Line {i} of the tale" for i in range(40)))
    (tmp_path / "c.toml").write_text('novel_txt = "n.txt"\ntarget_role = "Hero,H"\nrun_name = "tale"\nnovel_title = "T"\nchunk_size_tokens = 100\nchunk_overlap_tokens = 10\nvalid_ratio = 0.2\n')
    return load_settings(str(tmp_path / "c.toml"), make_folders=True)


def good_model():
    def model(system, user):
        lines = user.split("\n")
        return "```json\n" + json.dumps([{"role": "Other" if i % 2 == 0 else "Hero", "dialogue": f"{x}!"} for i, x in enumerate(lines)]) + "\n```"

    return model


def failing_model():
    good = good_model()

    def model(system, user):
        if "Line 7 " in user:
            raise RuntimeError("down")
        return good(system, user)

    return model


def test_extraction_takes_up_failed_chunks(spark, settings):
    replies = settings.path("cache", "replies")
    first = steps.run_extraction(spark, settings, failing_model, replies).count()
    stored = spark.read.parquet(replies)
    failed = stored.where("error IS NOT NULL").count()
    assert failed > 0 and first > 0
    n = stored.count()
    second = steps.run_extraction(spark, settings, good_model, replies)
    assert spark.read.parquet(replies).count() == n + failed
    lines = second.collect()
    assert len(lines) > first and len({(r.role, r.dialogue) for r in lines}) == len(lines)
    assert files.read_jsonl(spark, settings.raw_lines).count() == len(lines)


def shaky_model():
    good, failed = good_model(), set()

    def model(system, user):
        if user not in failed:
            failed.add(user)
            raise RuntimeError("429")
        return good(system, user)

    return model


def test_extraction_retries_and_stores_in_slices(spark, settings):
    replies = settings.path("cache", "replies")
    n = steps.run_extraction(spark, settings, shaky_model, replies, pause=lambda k, e: 0.0, slice_rows=3).count()
    stored = spark.read.parquet(replies)
    assert n > 0 and stored.where("error IS NOT NULL").count() == 0
    once = steps.run_extraction(spark, settings, shaky_model, settings.path("cache", "single"), attempts=1)
    assert once.count() == 0
    assert spark.read.parquet(settings.path("cache", "single")).where("error = 'RuntimeError: 429'").count() == stored.count()


def test_a_slice_that_dies_leaves_the_earlier_ones(spark, tmp_path):
    rows = spark.range(40).selectExpr("id AS doc_id", "id AS chunk_id", "'x' AS chunk")
    asked = []

    def ask(part):
        asked.append(part)
        if len(asked) == 3:
            raise RuntimeError("driver lost")
        return part.selectExpr("doc_id", "chunk_id", "chunk AS response", "cast(null AS string) AS error")

    path = str(tmp_path / "replies")
    with pytest.raises(RuntimeError):
        steps.ask_in_slices(rows, ask, ["doc_id", "chunk_id"], path, 10)
    left = steps.pending_chunks(rows, spark.read.parquet(path))
    assert 0 < left.count() < 40
    steps.ask_in_slices(left, lambda part: part.selectExpr("doc_id", "chunk_id", "chunk AS response", "cast(null AS string) AS error"), ["doc_id", "chunk_id"], path, 10)
    assert spark.read.parquet(path).count() == 40


def test_budgets_by_tokens(spark, settings, tmp_path):
    import public_tokenizers
    from turnloom.operators.chunker import tokenizer_counter

    path = public_tokenizers.path("byte_bpe_50k.json")
    by_tokens = dataclasses.replace(settings, tokenizer=path)
    steps.run_extraction(spark, by_tokens, good_model, settings.path("cache", "tokens"))
    chunks = [r.chunk for r in spark.read.parquet(settings.path("cache", "tokens")).collect()]
    steps.run_extraction(spark, settings, good_model, settings.path("cache", "chars"))
    assert max(tokenizer_counter(path)(chunks)) <= 105 and len(chunks) < spark.read.parquet(settings.path("cache", "chars")).count()


def rewriter():
    def model(system, user):
        if "JSON 数组" in system:
            ids = [int(x) for x in re.findall(r"--- id=(\d+) ---", user)]
            if 21 in ids:
                return "no list at all"
            return "Here: " + json.dumps([{"id": i, "user": f"q{i} ", "hero": f"a{i}"} for i in ids if i % 5] + [{"id": 999, "user": "x", "hero": "y"}])
        number = re.search(r"line(\d+)", user)[1]
        return "none" if number == "20" else '{"user": "single %s", "hero": "alone"}' % number

    return model


def test_rewriter_asks_singly_for_what_batches_leave_out(spark, tmp_path):
    rows = [(i, [("human", f"context {i}\nH：old line"), ("gpt", f"line{i}")]) for i in range(24)]
    samples = spark.createDataFrame(rows, "pos long, conversations array<struct<from:string,value:string>>")
    out = str(tmp_path / "out.json")

    def run(**more):
        return steps.rewrite_samples(samples, rewriter, str(tmp_path / "state"), out, role="H", title="T", prefix="h-chat", field="hero", batch_size=5, slice_batches=2, pause=lambda k, e: 0.0, **more)

    told = run(sample_count=12)
    assert told == {"samples": 12, "kept_from_before": 0, "written": 12}
    told = run()
    assert told == {"samples": 24, "kept_from_before": 12, "written": 23}
    found = {x["id"]: x for x in json.load(open(out))}
    assert list(found) == [f"h-chat-{i:05d}" for i in range(24) if i != 20]
    assert found["h-chat-00001"]["conversations"] == [{"from": "human", "value": "q1"}, {"from": "gpt", "value": "a1"}]
    assert found["h-chat-00005"]["conversations"][0]["value"] == "single 5"
    assert found["h-chat-00021"]["conversations"][1]["value"] == "alone"
    assert found["h-chat-00001"]["system"].startswith("你正在扮演《T》中的H。")
    assert run()["written"] == 23


def test_script_dialect(spark, settings):
    steps.run_extraction(spark, settings, good_model, settings.path("cache", "replies"))
    steps.build_dataset(spark, dataclasses.replace(settings, dialect="script", novel_title=""))
    row = json.load(open(settings.train_file))[0]
    assert row["id"].startswith("tale-0") and row["system"].startswith("你正在扮演Hero。") and row["conversations"][0]["value"].startswith("Other：")
    steps.build_dataset(spark, dataclasses.replace(settings, novel_title=""), system="own words")
    assert json.load(open(settings.train_file))[0]["system"] == "own words"


def service_model(**service):
    assert set(service) <= {"api_key", "base_url", "model"}
    return good_model()


def test_extractor_command(spark, settings, tmp_path, capsys):
    text, out = settings.novel_txt, str(tmp_path / "lines.jsonl")
    assert cli.main(["extract", "-l"], spark) == 0 and "deepseek" in capsys.readouterr().out
    (tmp_path / ".env").write_text("DEEPSEEK_API=secret\n")
    assert cli.main(["extract", text, "-m", "test_steps:service_model", "-p", "deepseek", "--env", str(tmp_path / ".env"), "-o", out, "-t", "2", "--legacy-format", "--max-tokens", "100", "--overlap", "10"], spark) == 0
    told = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert told["platform"] == "deepseek" and told["output"].endswith("lines_sorted.jsonl") and told["total_dialogues"] > 0
    assert spark.read.json(out).where("chunk_text IS NOT NULL").count() > 0
    assert set(spark.read.json(str(tmp_path / "lines_sorted_legacy.jsonl")).columns) == {"role", "dialogue"}
    plain = str(tmp_path / "plain.jsonl")
    assert cli.main(["extract", text, "-m", "test_steps:good_model", "-o", plain, "--no-chunk-id", "--no-save-chunk-text", "--no-stats", "--no-concurrent", "--no-sort-output"], spark) == 0
    assert set(spark.read.json(plain).columns) == {"role", "dialogue"}
    with pytest.raises(SystemExit):
        cli.main(["extract", text, "-m", "test_steps:good_model", "--max-tokens", "5"], spark)
    with pytest.raises(SystemExit):
        cli.main(["extract"], spark)


def test_build_and_rewrite_commands(spark, settings, tmp_path, capsys):
    steps.run_extraction(spark, settings, good_model, settings.path("cache", "replies"))
    out = str(tmp_path / "built")
    assert cli.main(["build", "--input", settings.raw_lines, "--target-role", "Hero", "--run-name", "tale", "--out-dir", out], spark) == 0
    assert json.load(open(f"{out}/data/tale_chat_train.json"))[0]["id"].startswith("tale-")
    capsys.readouterr()
    (tmp_path / "s.json").write_text(json.dumps([{"id": str(i), "system": "", "conversations": [{"from": "human", "value": f"c{i}"}, {"from": "gpt", "value": f"line{i}"}]} for i in range(3)]))
    assert cli.main(["rewrite", str(tmp_path / "s.json"), str(tmp_path / "r.json"), "-m", "test_steps:rewriter", "--role", "H", "--field", "hero"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["written"] == 3


def test_build_and_validate(spark, settings):
    steps.run_extraction(spark, settings, good_model, settings.path("cache", "replies"))
    report = steps.build_dataset(spark, settings)
    assert report["valid"] == max(1, int((report["train"] + report["valid"]) * 0.2)) and report["reasons"]["kept"] == report["train"] + report["valid"]
    found = steps.validate_files(spark, [settings.train_file, settings.valid_file])
    assert [f["examples"] for f in found] == [report["train"], report["valid"]]
    assert set(json.load(open(settings.path("data", "dataset_info.json")))) == {"tale_train", "tale_valid"}
    again = steps.report_lines(spark, settings.raw_lines)
    assert again["total_dialogues"] == files.read_jsonl(spark, settings.raw_lines).count() and again["chunks"]["total_chunks"] > 1


def test_state(spark, tmp_path):
    state = steps.RunState(spark, str(tmp_path / "steps"))
    assert not state.is_done("r", "build")
    assert state.run("r", "build", lambda: 5) == 5 and state.run("r", "build", lambda: 6) is None
    assert not state.is_done("r", "extract") and not state.is_done("q", "build")
    state.clear("r", "build")
    with pytest.raises(ZeroDivisionError):
        state.run("r", "build", lambda: 1 / 0)
    assert not state.is_done("r", "build") and state.run("r", "build", lambda: 7) == 7


def test_command_line(spark, settings, capsys):
    config = settings.path("c.toml")
    assert cli.main(["run", "-c", config, "-m", "test_steps:good_model"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["train"] > 0
    assert cli.main(["run", "-c", config, "-o", "build", "-r", "build"], spark) == 0
    assert cli.main(["validate", settings.train_file], spark) == 0
    out = settings.path("sorted")
    assert cli.main(["lines", settings.raw_lines, "--sort", out, "--legacy", settings.path("legacy"), "--chunks", "0", "1", "--chunks-out", settings.path("some"), "--dedup", settings.path("d"), "--stats"], spark) == 0
    assert spark.read.json(out).count() == files.read_jsonl(spark, settings.raw_lines).count()
    assert {r.chunk_id for r in spark.read.json(settings.path("some")).collect()} == {0, 1}
    assert set(spark.read.json(settings.path("legacy")).columns) == {"role", "dialogue"}
    with pytest.raises(SystemExit):
        cli.main(["run", "-c", config, "-o", "extract", "-r", "extract"], spark)
