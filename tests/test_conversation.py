import random

import pytest

from turnloom.operators import conversation
from turnloom.operators.conversation import SCRIPT, build_samples, build_turns, classify_chunks, parse_aliases

LINE = "chunk_id long, dialogue_index long, role string, dialogue string, ord long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], LINE)


def plain(rows, aliases, sep=": "):
    """A row-by-row model of the rules."""
    chunks = {}
    for i, (chunk, index, role, said) in enumerate(rows):
        chunks.setdefault(chunk, []).append((index or 0, i, role, said))
    out, reasons = {}, {}
    for chunk, lines in chunks.items():
        lines.sort()
        if not any(r in aliases for _, _, r, _ in lines):
            reasons[chunk] = "no_target"
            continue
        if lines[0][2] in aliases:
            reasons[chunk] = "leads_with_target"
            continue
        turns = []
        for _, _, role, said in lines:
            side = "gpt" if role in aliases else "human"
            piece = said.strip() if side == "gpt" else f"{role}{sep}{said.strip()}"
            if not piece:
                continue
            if turns and turns[-1][0] == side:
                turns[-1][1].append(piece)
            else:
                turns.append((side, [piece]))
        while turns and turns[-1][0] == "human":
            turns.pop()
        if len(turns) < 2:
            reasons[chunk] = "too_short"
            continue
        reasons[chunk] = "kept"
        out[chunk] = [(s, "\n".join(p).strip()) for s, p in turns]
    return out, reasons


def turns_of(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.chunk_id, r.turn_no)):
        assert r.turn_no == len(out.setdefault(r.chunk_id, [])) + 1
        out[r.chunk_id].append((r.side, r.value))
    return out


def test_aliases():
    assert parse_aliases("A, B,,A ") == ["A", "B", "A"] and parse_aliases("甲，乙") == ["甲，乙"]
    with pytest.raises(ValueError):
        parse_aliases(", ,")


def test_edge_rows(spark):
    rows = [
        (1, 0, "x", "hi"), (1, 1, "T", "  "),  # only a blank target line
        (2, 0, "x", "a"), (2, 1, "T", " "), (2, 2, "y", "b"), (2, 3, "T", "c"),  # merge across a blank
        (3, 0, "T", " "), (3, 1, "x", "a"), (3, 2, "T", "b"),  # the raw first line leads
        (4, 0, "x", "a"), (4, 1, "T", "b"), (4, 2, "x", "c"),  # the last human turn goes
        (5, None, "x", "second"), (5, -1, "x", "first"), (5, 0, "T", "third"),  # missing index is 0, ties keep order
        (6, 0, " T", "not the target"), (6, 1, "t", "nor this"),
        (123456, 0, "x", "a　"), (123456, 1, "T2", "\tb\n"),
    ]
    aliases = ["T", "T2"]
    want, reasons = plain(rows, aliases)
    df = frame(spark, rows)
    assert turns_of(build_turns(df, aliases)) == want
    assert {r.chunk_id: r.reason for r in classify_chunks(df, aliases).collect()} == reasons
    assert want[2] == [("human", "x: a\ny: b"), ("gpt", "c")] and want[5][0][1] == "x: first\nx: second"
    ids = {r.chunk_id: r.id for r in build_samples(df, aliases, run_name="r%d", system="s").collect()}
    assert ids == {2: "r%d_00002", 4: "r%d_00004", 5: "r%d_00005", 123456: "r%d_123456"}
    script = {r.chunk_id: r for r in build_samples(df, aliases, run_name="r", system="s", dialect=SCRIPT).collect()}
    assert script[4].id == "r-00004" and script[4].conversations[0].value == "x：a" and script[4].conversations[1]["from"] == "gpt"


@pytest.mark.parametrize("seed", range(4))
def test_random_dialogues(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 30), rng.choice([None, *range(6)]), rng.choice(["A", "B", "T", "T2", "t"]), rng.choice(["", " ", "hi", "yo\n", "　x"])) for _ in range(300)]
    df, aliases = frame(spark, rows), ["T", "T2"]
    want, reasons = plain(rows, aliases)
    assert turns_of(build_turns(df, aliases)) == want
    counts = {r.reason: r.n_chunks for r in conversation.drop_reasons(df, aliases).collect()}
    assert sum(counts.values()) == len(reasons) and all(list(reasons.values()).count(k) == v for k, v in counts.items())
    for turns in want.values():
        assert [s for s, _ in turns] == ["human", "gpt"] * (len(turns) // 2)


def test_nulls_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, 0, None, "a", "x", 1), (1, 1, "T", None, "x", 1), (1, 2, "T", "b", "x", 1)], "chunk_id long, dialogue_index long, role string, dialogue string, side string, turn_no int")
    assert turns_of(build_turns(df, ["T"])) == {1: [("human", ": a"), ("gpt", "b")]}
    assert build_turns(df.limit(0), ["T"]).count() == 0 == conversation.drop_reasons(df.limit(0), ["T"]).count()
    stats = conversation.turn_stats(build_samples(df.limit(0), ["T"], run_name="r", system="s")).first()
    assert (stats.samples, stats.total_turns, stats.min_turns) == (0, 0, None)
    with pytest.raises(RuntimeError):
        conversation.require_hits(df, ["nobody"])
    assert conversation.target_volume(df, ["T"]).first().label == "few"
    assert conversation.target_volume(df, ["Z"]).first().label == "none"


def test_windows_share_one_exchange(spark, sf_dir):
    from turnloom import queries

    plan = queries.sft_turns(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
