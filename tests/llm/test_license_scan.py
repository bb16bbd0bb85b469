import re

import pytest

from turnloom.llm import license_scan, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def expected(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hits = [(i, label) for phrase, label in BASE.items() for p in [phrase.split()] for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def scan(spark, monkeypatch, texts):
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in enumerate(texts)], "doc_id long, text string, template int, w string")
    monkeypatch.setattr(queries, "_table", lambda *_: df)
    return queries.op9_license_scan(spark, "").orderBy("doc_id").collect()


def test_op9_on_the_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op9_license_scan(spark, sf_dir).collect()
    assert len(got) == len(texts) and sum(r.n_base for r in got) > 0
    for r in got:
        assert tuple(r)[1:6] == expected(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_base_phrases_in_odd_texts(spark, monkeypatch):
    texts = [None, "", "mit", "Under  the MIT-License, under the mit license", "under the mit x license", "CC BY-NC cc by nc cc", "apache license version 2.0 É apache license version 20", "under the mit licenseé", "CC BY NK c", "K", "a b", "cc by nc " * 3000, "under the under the mit license"]
    got = scan(spark, monkeypatch, texts)
    assert [tuple(r)[1:6] for r in got] == [expected(t) for t in texts]
    assert len(scan(spark, monkeypatch, [])) == 0


def test_changed_passages_count_for_the_method(spark, monkeypatch):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = [mit, mit.replace("any person", "any natural or legal person"), mit[:60], "GNU General Public License, version 3", "redistribution and use in source " * 3, "x " * 50 + mit + " y " + mit]
    labels = [r.labels for r in scan(spark, monkeypatch, texts)]
    assert labels == ["mit", "mit", "", "gpl-3", "", "mit"]


def test_repeated_rows_and_short_templates(spark):
    df = spark.createDataFrame([(1, "cc by nc"), (1, "cc by nc"), (None, "cc by nc")], "doc_id long, text string")
    assert sorted(len(r.spans) for r in license_scan.scan_licenses(df).collect()) == [1, 1, 1]
    with pytest.raises(ValueError):
        license_scan.scan_licenses(df, templates=(license_scan.Template("x", "two words"),))


def test_labels_need_the_words_that_matter(spark, monkeypatch):
    notice = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License"
    cases = {
        "GNU General Public License version 2": "", "GNU General Public License, version 3": "gpl-3", "GNU Lesser General Public License version 3": "lgpl",
        "the GNU Affero General Public License version 3": "agpl", "Mozilla Public License version 1": "", "Mozilla Public License, version 2.0": "mpl-2",
        notice.format("General"): "gpl", notice.format("Lesser General"): "lgpl", notice.format("Affero General"): "agpl", notice.format("General").replace("is free", "is a free"): "gpl",
        "the Lesser General Public License": "lgpl", "released into the public": "", "put into the public domain": "public-domain",
        "permission is hereby granted free of charge " * 6: "", "permission is hereby permission is hereby permission is hereby granted free of charge granted free of charge": "",
    }
    assert {t: r.labels for t, r in zip(cases, scan(spark, monkeypatch, list(cases)), strict=True)} == cases


def test_long_templates_are_counted_in_full(spark):
    words = [f"w{i}" for i in range(200)]
    long = license_scan.Template("long", " ".join(words), True)
    texts = [" ".join(words), " ".join(words[:199]), " ".join(["x", *words, *words])]
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates=(long,)).orderBy("doc_id").collect()
    assert [[(s.start, s.score) for s in r.spans] for r in got] == [[(0, 1.0)], [], [(1, 1.0), (201, 1.0)]]
