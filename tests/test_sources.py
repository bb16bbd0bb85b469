import json
import tarfile

import pytest

from turnloom import config
from turnloom.schemas import SAMPLE
from turnloom.sources import archives, files, shared


def test_text(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("héllo\n世界".encode())
    assert [r.text for r in files.read_text(spark, str(tmp_path / "a.txt")).collect()] == ["héllo\n世界"]
    (tmp_path / "b.txt").write_bytes(b"ab\xff")
    with pytest.raises(Exception, match="UTF"):
        files.read_text(spark, str(tmp_path / "b.txt")).collect()
    assert files.read_text(spark, str(tmp_path / "b.txt"), strict=False).first().text == "ab�"


def test_jsonl(spark, tmp_path):
    path = tmp_path / "l.jsonl"
    path.write_text('{"chunk_id": 1, "dialogue_index": 0, "role": "A", "dialogue": "x"}\n\n{"role": "B"}\n', encoding="utf-8")
    got = files.read_jsonl(spark, str(path)).orderBy("ord").collect()
    assert [(r.chunk_id, r.role) for r in got] == [(1, "A"), (None, "B")]
    path.write_text('{"chunk_id": 1}\n{broken\n', encoding="utf-8")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(path)).collect()


def test_jsonl_out(spark, tmp_path):
    df = files.with_chunk_text(spark.createDataFrame([(1, "é", ""), (2, "b", "t")], "chunk_id long, role string, chunk_text string"), True)
    for n in (1, 2):
        files.write_jsonl(df, str(tmp_path / "o"))
    lines = sorted(x for p in (tmp_path / "o").glob("part*") for x in p.read_text(encoding="utf-8").splitlines())
    assert [json.loads(x) for x in lines] == [{"chunk_id": 1, "role": "é"}, {"chunk_id": 2, "role": "b", "chunk_text": "t"}]
    files.write_jsonl(df, str(tmp_path / "o"), append=True)
    assert spark.read.json(str(tmp_path / "o")).count() == 4
    assert "chunk_text" not in files.with_chunk_text(df, False).columns


def test_json_array(spark, tmp_path):
    rows = [("a", None, [("human", "é"), ("gpt", "y")]), ("b", "s", [])]
    path = str(tmp_path / "d.json")
    assert files.write_json_array(spark.createDataFrame(rows, SAMPLE), path) == 2
    assert json.load(open(path, encoding="utf-8"))[0]["conversations"][0] == {"from": "human", "value": "é"}
    assert files.read_json_array(spark, path).count() == 2
    raw = files.read_json_array_raw(spark, path).orderBy("index").collect()
    assert [json.loads(r.json)["id"] for r in raw] == ["a", "b"]
    assert files.write_json_array(spark.createDataFrame([], SAMPLE), path) == 0 and json.load(open(path)) == []
    (tmp_path / "one.json").write_text('{"id": 1}')
    with pytest.raises(ValueError):
        files.read_json_array(spark, str(tmp_path / "one.json"))
    with pytest.raises(Exception, match="list"):
        files.read_json_array_raw(spark, str(tmp_path / "one.json")).collect()


def test_names():
    assert files.output_name("x", "sorted") == "x_sorted.jsonl" and files.output_name("x", "chunks", [10, 2]) == "x_chunks_2_10.jsonl"


def test_env(spark, tmp_path):
    (tmp_path / "e").write_text("# c=1\nA = \"x=y\"\nB='z'\n\nbroken\nC=\n")
    assert files.load_env(spark, str(tmp_path / "e")) == {"A": "x=y", "B": "z", "C": ""}
    assert files.load_env(spark, str(tmp_path / "none")) == {}


def test_registry(spark, tmp_path):
    path = str(tmp_path / "r.json")
    files.write_registry(files.registry_entries(spark, {"a": "a.json", "b": "b.json"}), path)
    files.write_registry(files.registry_entries(spark, {"b": "new.json"}), path)
    known = json.load(open(path))
    assert known["a"]["file_name"] == "a.json" and known["b"]["file_name"] == "new.json" and known["b"]["columns"]["messages"] == "conversations"


def test_settings(tmp_path):
    (tmp_path / "n.txt").write_text("x")
    (tmp_path / "c.toml").write_text('novel_txt = "n.txt"\ntarget_role = "A, B"\nrun_name = "r"\nmodel_choice = "m"\nlora_rank = 8\n[model_ids]\nm = "id"\n')
    s = config.load_settings(str(tmp_path / "c.toml"), make_folders=True)
    assert s.aliases == ["A", "B"] and s.canonical_role == "A" and s.model_id == s.extraction_model_id == "id" and s.other == {"lora_rank": 8}
    assert s.novel_txt == str(tmp_path / "n.txt") and (tmp_path / "data/raw").is_dir() and s.train_file.endswith("r_chat_train.json")
    (tmp_path / "c.toml").write_text('novel_txt = "n.txt"\ntarget_role = ","\nrun_name = "r"\n')
    with pytest.raises(ValueError):
        config.load_settings(str(tmp_path / "c.toml"))


def test_platforms():
    assert config.resolve_platform("deepseek", {"DEEPSEEK_API": "k"})["base_url"] == "https://api.deepseek.com"
    assert config.resolve_platform("custom", {"CUSTOM_API_KEY": "k", "CUSTOM_BASE_URL": "u"})["base_url"] == "u"
    with pytest.raises(ValueError):
        config.resolve_platform("other", {})
    assert len(config.setting_errors(50, 50, 3.0, "openai", {})) == 3 and config.setting_errors(500, 50, 0.6) == []


def test_archives(tmp_path):
    folder = tmp_path / "adapter"
    (folder / "sub").mkdir(parents=True)
    (folder / "a.json").write_text("{}")
    (folder / "sub" / "b").write_text("b")
    path = str(tmp_path / "a.tar.gz")
    assert archives.pack_folder(str(folder), path) == ["a.json", "sub"]
    out = archives.unpack_folder(path, str(tmp_path / "out"))
    assert open(f"{out}/sub/b").read() == "b"
    assert archives.pack_folder(str(folder), path, ["missing", "a.json"], "top") == ["a.json"]
    assert archives.unpack_folder(path, str(tmp_path / "two")).endswith("two/top")
    for names in (["../x"], ["top/../../x"], ["/abs/x"], ["one/x", "two/x"]):
        with tarfile.open(path, "w:gz") as tar:
            for name in names:
                tar.addfile(tarfile.TarInfo(name))
        with pytest.raises(ValueError):
            archives.unpack_folder(path, str(tmp_path / "bad"))
    with tarfile.open(path, "w:gz") as tar:
        link = tarfile.TarInfo("top/link")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc"
        tar.addfile(link)
    with pytest.raises(ValueError):
        archives.unpack_folder(path, str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists() and not (tmp_path / "x").exists()


def test_shared_folder_is_refused_on_clusters():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        shared.shared_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        shared.shared_dir(Session())
    Context.master = "local[4]"
    assert shared.shared_dir(Session()).startswith("file:///")


def test_scratch_tables_are_freed(spark):
    mark = shared.scratch_mark()
    one, two = (shared.materialize(spark.range(3), n) for n in ("one", "two"))
    shared.free(one)
    shared.free(one)
    assert two.count() == 3
    shared.free_since(mark, two)
    assert two.count() == 3 and shared.scratch_mark() == mark + 1
    shared.free_since(mark)
    assert shared.scratch_mark() == mark


def test_training_file(tmp_path):
    (tmp_path / "n.txt").write_text("x")
    (tmp_path / "c.toml").write_text('novel_txt = "n.txt"\ntarget_role = "R"\nrun_name = "r"\nlora_rank = 8\nlearning_rate = 0.0001\nother_key = 1\ndialect = "script"\n')
    values = config.training_values(config.load_settings(str(tmp_path / "c.toml")), "org/m", "qwen3", "r_train")
    assert values["lora_rank"] == 8 and values["learning_rate"] == 0.0001 and "other_key" not in values and values["finetuning_type"] == "lora"
    (tmp_path / "c.toml").write_text('novel_txt = "n.txt"\ntarget_role = "R"\nrun_name = "r"\ndialect = "x"\n')
    with pytest.raises(ValueError):
        config.load_settings(str(tmp_path / "c.toml"))
