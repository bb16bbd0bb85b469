import zlib

import numpy as np
import pyarrow as pa
import pytest

from turnloom.llm import language_id, queries
from turnloom.llm.language_id import HyperModel, letters_of


def letters(text):
    return letters_of(pa.array([text], pa.large_string()))[0].tolist()


def test_letters():
    assert letters("aÀ1 Kß") == [ord("a"), ord("à"), 0, 0, ord("k"), ord("ß")]
    assert letters("日😀𝒜") == [ord("日"), 0, ord("𝒜")]


def by_hand(model, text):
    s, last = [0], 0
    for ch in text.lower():
        x = ord(ch) if ch.isalpha() else 0
        if x or last:
            s.append(x)
        last = x
    base = {c: model.letter_vectors(np.array([c]))[0].astype(int) for c in set(s)}
    return sum((np.roll(base[s[i]], 2) * np.roll(base[s[i + 1]], 1) * base[s[i + 2]] for i in range(len(s) - 2) if s[i + 1]), np.zeros(model.dimensions, int))


def test_bundles_against_brute_force():
    texts = ["", "ab", "A, b--c!", "...", "abcab abc", "é", "x" * 3000, "日本 𝒜b"]
    model = HyperModel(dimensions=96)
    got = model.bundles(*letters_of(pa.array(texts, pa.large_string())))
    for text, vector in zip(texts, got, strict=True):
        assert vector.tolist() == by_hand(model, text).tolist(), text


def test_many_letters_are_counted_without_overflow():
    model = HyperModel(dimensions=64, n=5)
    texts = ["".join(chr(0x4E00 + 37 * k % 20000) for k in range(9000)), "ab" * 40]
    got = model.bundles(*letters_of(pa.array(texts, pa.large_string())))
    assert np.abs(got[1]).max() > 30 and np.isfinite(got).all()


def test_letter_vectors_differ_between_all_letters():
    vectors = HyperModel().letter_vectors(np.arange(0x300, 0x700)).astype(int)
    overlap = vectors @ vectors.T - 512 * np.eye(len(vectors), dtype=int)
    assert np.abs(overlap).max() < 300 and abs(vectors.mean()) < 0.01


def invented(seed, alphabet, n):
    """Texts of a language with 300 words of its own over an alphabet."""
    random = np.random.default_rng(seed)
    words = ["".join(random.choice(list(alphabet), random.integers(2, 8))) for _ in range(300)]
    return [" ".join(words[int(i)] for i in random.zipf(1.4, 25) % 300) for _ in range(n)]


def test_small_languages_in_five_scripts(spark):
    scripts = {"en": "abcdefghijklmnopqrstuvwxyzàâçéèêëîïôûùüÿñæœäößåøáíóúčšžřőűłąęśćźżğış", "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "uk": "абвгґдеєжзиіїйклмнопрстуфхцчшщьюя", "el": "αβγδεζηθικλμνξοπρστυφχψω", "hi": "अआइईउऊएऐओऔकखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह", "ar": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"}
    rows = [(k, text, lang) for lang, alphabet in scripts.items() for k, text in enumerate(invented(len(alphabet), alphabet, 2_000 if lang == "en" else 60))]
    df = spark.createDataFrame(rows, "k int, text string, lang string")
    model = language_id.train_language_model(df.where("k % 3 <> 0").select("text", "lang"))
    found = language_id.identify_language(df.where("k % 3 = 0"), model).groupBy("lang").agg({"k": "count"}).collect()
    right = language_id.identify_language(df.where("k % 3 = 0"), model).where("lang = lang_pred").groupBy("lang").count().collect()
    total, right = dict(map(tuple, found)), dict(map(tuple, right))
    assert all(right[lang] / total[lang] >= 0.95 for lang in scripts), right


def test_op6_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op6_language_id(spark, sf_dir).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert sum(right) / len(right) > 0.99
    assert {r.lang_pred for r in got} <= {r.lang for r in docs.values()} | {"und"}


def test_odd_rows(spark):
    rows = [(1, None, "en", "x"), (2, "", "en", "x"), (3, "12 ... 34", "en", "x"), (None, "the cat sat on the mat", "en", "x"), (5, "le chat est sur le lit", "fr", "x"), (6, "the dog sat", None, "x"), (6, "the dog sat", None, "x"), (7, "the mat " * 50_000, "en", "x"), (8, "日本語", "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_score string")
    model = language_id.train_language_model(df.where("lang IS NOT NULL"))
    got = language_id.identify_language(df, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score"]
    found = [(r.doc_id, r.lang_pred, r.lang_score) for r in got.collect()]
    assert found[:3] == [(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)]
    assert [f[1] for f in found[3:8]] == ["en", "fr", "en", "en", "en"]
    assert language_id.identify_language(df.limit(0), model).count() == 0
    none = language_id.train_language_model(df.limit(0))
    assert {r.lang_pred for r in language_id.identify_language(df, none).collect()} == {"und"}


def test_training_sample_is_bounded(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'text' AS text", "'en' AS lang")
    never = df.doc_id < 0
    assert language_id.training_rows(df, never, max_docs=5000).count() == 4000
    assert language_id.training_rows(df, never, max_docs=1000).count() == pytest.approx(1000, rel=0.2)


def test_unidentified_texts_go(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat and the dog sat"), (2, "zqx"), (3, "日本語漢字" * 60), (4, "..."), (5, None)], "doc_id long, text string")
    model = language_id.train_language_model(df.where("doc_id = 1").selectExpr("text", "'en' AS lang"))
    left = language_id.drop_unidentified(df, model)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [1]
    assert language_id.drop_unidentified(df, model, languages=("fr",)).count() == 0
    assert language_id.drop_unidentified(df.limit(0), model).count() == 0


def test_columns_with_clashing_names_and_missing_languages(spark):
    rows = [(1, "the cat sat on the mat", None, "a", 1), (2, "the cat sat", "xx", "b", 2), (3, "...", "en", "c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, `row` string, cosine int")
    model = language_id.train_language_model(df.where("doc_id = 1").selectExpr("text", "'en' AS lang"))
    got = language_id.drop_unidentified(df, model, lang_col="lang")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, rows[0][1], "en", "a", 1), rows[1]]
