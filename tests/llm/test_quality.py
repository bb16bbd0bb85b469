import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql.functions import lit

from turnloom.llm import quality, queries
from turnloom.llm.quality import FEATURES, LineCrf, line_features


def features(*texts):
    return line_features(pa.array(texts, pa.large_string()))


def test_lines_of_texts():
    found, sizes, offsets = features("a b\n\nB. ", "", "x\n", "É é 12 !|%")
    assert offsets.tolist() == [0, 3, 4, 6, 7] and sizes.tolist() == [4, 1, 3, 0, 2, 0, 12]
    of = dict(zip(FEATURES, found.T, strict=True))
    assert np.expm1(of["words"]).round().tolist() == [2, 0, 1, 0, 1, 0, 4]
    assert of["upper"].tolist() == [0, 0, 1, 0, 0, 0, 0.5]
    assert of["ends_sentence"].tolist() == [0, 0, 1, 0, 0, 0, 0]
    assert of["starts_upper"].tolist() == [0, 0, 1, 0, 0, 0, 1]
    assert [round(float(of[k][6]) * 10) for k in ("digits", "exclaims", "bars", "symbols")] == [2, 1, 1, 1]


def test_repeats_and_copies():
    found, _, _ = features("aa aa aa ab ba\nx y\nx y\ny x", "x y")
    of = dict(zip(FEATURES, found.T, strict=True))
    assert np.allclose(of["repeats"], [0.4, 0, 0, 0, 0]) and of["copies"].tolist() == [0, 1, 1, 0, 0]
    assert np.allclose(of["pairs"], [0.4, 0.5, 0.5, 0, 0])


def test_rows_do_not_depend_on_their_batch():
    texts = ["One line. Two words", "", "a a a\n!!!\n\n", "É" * 50, "x | y\nx | y"] * 3
    alone = np.concatenate([features(t)[0] for t in texts])
    assert np.allclose(alone, features(*texts)[0])


def test_marginals_against_enumeration():
    model = LineCrf()
    model.moves = np.array([[0.5, -0.3], [0.1, 0.8]])
    odds = np.array([0.3, -1.0, 2.0, 0.7, -0.2, 1.1])
    offsets = np.array([0, 4, 4, 5, 6])
    good, moved = model.marginals(odds, offsets)
    want_moves = np.zeros((2, 2))
    for a, b in itertools.pairwise(offsets):
        paths = list(itertools.product((0, 1), repeat=b - a))
        p = np.array([np.exp(sum(odds[a + i] * y for i, y in enumerate(path)) + sum(model.moves[x, y] for x, y in itertools.pairwise(path))) for path in paths])
        p /= p.sum()
        for i in range(b - a):
            assert np.isclose(good[a + i], sum(q for q, path in zip(p, paths, strict=True) if path[i]))
        for q, path in zip(p, paths, strict=True):
            for x, y in itertools.pairwise(path):
                want_moves[x, y] += q
    assert np.allclose(moved, want_moves)


def test_op2_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = queries.op2_quality_classifier(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) / len(held) > 0.99


def test_odd_rows(spark):
    docs = [(i, f"A fine sentence number {i}.\nAnother good one.", "x") for i in range(40)] + [(40 + i, f"buy!!! now!!! {i} ### %%%\n$$$ !!!", "x") for i in range(40)]
    docs += [(90, None, "x"), (91, "", "x"), (None, "A fine sentence.", "x"), (92, "Long and fine. " * 20_000, "x"), (93, "A fine line.\n" * 5_000, "x"), (0, docs[0][1], "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, quality_score string")
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(80)] + [(5, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train_quality_model(df, labels, lit(True))
    scored = quality.score_quality(df, model)
    assert scored.columns == df.columns
    score = {}
    for r in scored.collect():
        score.setdefault(r.doc_id, r.quality_score)
        assert 0 <= r.quality_score <= 1
    assert min(score[i] for i in range(40)) > 0.7 > 0.3 > max(score[i] for i in range(40, 80))
    assert score[90] == score[91] and score[92] > 0.5 and score[93] > 0.5
    assert quality.score_quality(df.limit(0), model).count() == 0
    untrained = quality.train_quality_model(df, labels.limit(0), lit(True))
    assert {r.quality_score for r in quality.score_quality(df, untrained).collect()} == {0.5}


def test_neighbours_and_transitions_decide_unclear_lines():
    """A line that good and bad documents have alike takes the label of what stands around it."""
    good = "A fine sentence, with some words.\nplain words here\nAnother sentence that ends well."
    bad = "BUY!!! 999 ### %%%\nplain words here\n$$$ !!! CLICK 123 !!!"
    found, sizes, offsets = features(*[good, bad] * 30)
    model = LineCrf().fit(found, sizes, offsets, np.array([1, 0] * 30))

    def unclear():
        n = len(found)
        first, last = np.isin(np.arange(n), offsets[:-1]), np.isin(np.arange(n), offsets[1:] - 1)
        p, _ = model.marginals(model._emission(model._columns(found), first, last), offsets)
        return p[1], p[4]

    together = unclear()
    assert together[0] > 0.9 and together[1] < 0.1
    assert model.moves[0, 0] + model.moves[1, 1] > model.moves[0, 1] + model.moves[1, 0]
    model.weights[1:] = 0  # the transitions alone still tell the two apart
    alone = unclear()
    assert alone[0] - alone[1] > 0.1
    model.moves[:] = 0
    assert np.isclose(*unclear())


def test_training_is_bounded_by_lines(spark, monkeypatch):
    rows = [(k, "one line\n" * (10_000 if k == 3 else 4)) for k in range(30)] + [(5, "again")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    seen = []
    fit = LineCrf.fit
    monkeypatch.setattr(LineCrf, "fit", lambda self, table, *rest: seen.append(len(table)) or fit(self, table, *rest))
    quality.train_quality_model(df, labels, lit(True), max_lines=100)
    quality.train_quality_model(df, labels, lit(True), max_docs=10, max_lines=10_000)
    assert 80 < seen[0] <= 100 and seen[1] <= 50
