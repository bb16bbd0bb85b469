"""Language identification with hyperdimensional n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, buffers, slices

#: Dimensions of the vectors and letters per n-gram.
DIMENSIONS = 512
N = 3
#: Labelled documents that training reads, about: those whose hash falls below a bound.
MAX_TRAINING_DOCS = 20_000
UNDETERMINED = "und"
#: Cosine that a long text must reach with some language, and the number of letters at which half
#: of it is asked; the fewer letters, the less their n-grams can be like a whole language.
LEAST_SCORE = 0.1
HALF_LETTERS = 60
POINTS = 0x110000


@lru_cache(1)
def _letter_table() -> np.ndarray:
    """For each code point: its lower-case form if it is a letter, else 0."""
    table = np.zeros(POINTS, np.uint32)
    for c in range(POINTS):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letter code points (0 for everything else) of all texts, and each text's offset."""
    raw, ends = buffers(text)
    lead = (raw & 0xC0) != 0x80
    of_char = np.concatenate([[0], np.cumsum(lead)])[ends]
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return _letter_table()[points], of_char


class HyperModel:
    """Random letter vectors, their bound n-grams and a bundled prototype for each language.

    The vector of a letter follows from its code point and the seed, so every letter of every
    script has one of its own. An n-gram is the element-wise product of its letters' vectors, each
    rolled by its distance from the last letter. A text is the sum of its n-grams' vectors; letters
    run across other characters as one blank, and texts are compared with prototypes by cosine.
    Because a sum does not ask for order, the n-grams of a text are counted first and each distinct
    one is added once, times its count.
    """

    def __init__(self, dimensions: int = DIMENSIONS, n: int = N, seed: int = 7):
        self.dimensions, self.n, self.seed = dimensions, n, seed
        self.languages: list[str] = []
        self.prototypes = np.zeros((0, dimensions), np.float32)

    def letter_vectors(self, letters: np.ndarray) -> np.ndarray:
        """Vectors of -1 and 1, from the bits of hashes of the code points."""
        lanes = np.arange(-(-self.dimensions // 64), dtype=np.uint64)
        x = letters.astype(np.uint64)[:, None] * np.uint64(4096) + lanes + np.uint64(self.seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(len(letters), -1), axis=1)[:, : self.dimensions]
        return bits.astype(np.int8) * np.int8(2) - np.int8(1)

    def counts(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams of all texts (text, n-gram, count), in order of the texts, and the
        letters of these texts: an n-gram is a number to the base of how many there are."""
        seen = np.zeros(POINTS, bool)
        seen[codes] = seen[0] = True
        letters = np.flatnonzero(seen)
        number = np.zeros(POINTS, np.int32)
        number[letters] = np.arange(len(letters))
        symbols, size = number[codes].astype(np.int64), len(letters)
        doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        # one blank for each run of other characters, and one around each text
        keep = (symbols != 0) | np.concatenate([[True], (symbols[1:] != 0) | (symbols[:-1] != 0)])[: len(symbols)]
        symbols, doc = symbols[keep], doc[keep]
        firsts = np.searchsorted(doc, np.arange(len(ends) - 1))
        symbols, doc = np.insert(symbols, firsts, 0), np.insert(doc, firsts, np.arange(len(ends) - 1))
        if len(symbols) < self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), letters
        m = len(symbols) - self.n + 1
        gram = np.zeros(m, np.int64)
        for k in range(self.n):
            gram = gram * size + symbols[k : k + m]
        inside = (doc[:m] == doc[self.n - 1 :]) & (symbols[(self.n - 1) // 2 :][:m] != 0)
        total = size**self.n
        if total * len(ends) < 1 << 62:
            key, count = np.unique(doc[:m][inside] * total + gram[inside], return_counts=True)
            return key // total, key % total, count, letters
        pairs, count = np.unique(np.stack([doc[:m][inside], gram[inside]], 1), axis=0, return_counts=True)
        return pairs[:, 0], pairs[:, 1], count, letters

    def vectors(self, grams: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The bound vectors of n-grams."""
        base = self.letter_vectors(letters)
        out = np.ones((len(grams), self.dimensions), np.int8)
        for k in range(self.n):
            grams, letter = np.divmod(grams, len(letters))
            out *= np.roll(base, k, 1)[letter]
        return out

    def bundles(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One vector per text."""
        doc, gram, count, letters = self.counts(codes, ends)
        out = np.zeros((len(ends) - 1, self.dimensions), np.float32)
        for first in range(0, len(out), 256):  # a dense table of counts for some texts at a time
            last = min(first + 256, len(out))
            a, b = np.searchsorted(doc, (first, last))
            distinct, at = np.unique(gram[a:b], return_inverse=True)
            table = np.zeros((last - first, len(distinct)), np.float32)
            table[doc[a:b] - first, at] = count[a:b]
            out[first:last] = table @ self.vectors(distinct, letters).astype(np.float32)
        return out

    def predict(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest language (-1 for texts without letters), its cosine from 0 to 1,
        and the number of letters."""
        vectors = self.bundles(codes, ends)
        length = np.linalg.norm(vectors, axis=1)
        cosine = vectors @ self.prototypes.T / np.maximum(length, 1e-9)[:, None]
        letters = np.concatenate([[0], np.cumsum(codes != 0)])
        letters = letters[ends[1:]] - letters[ends[:-1]]
        none = (letters == 0) | (not len(self.languages))
        best = np.where(none, -1, cosine.argmax(1) if len(self.languages) else -1)
        return best, np.where(none, 0.0, np.clip(cosine.max(1, initial=0.0), 0.0, 1.0)), letters


def training_rows(df: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """About ``max_docs`` labelled rows by the hash of their ids, or all where there are fewer.

    Only ids and languages are read to count the labelled rows.
    """
    labelled = df.where(~held_out & F.col(lang_col).isNotNull())
    total = labelled.select(id_col, lang_col).count()
    if total > max_docs:
        labelled = labelled.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1 << 30)) < int(max_docs / total * (1 << 30)))
    return labelled.where(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))


def train_language_model(rows: DataFrame, *, dimensions: int = DIMENSIONS, n: int = N) -> HyperModel:
    """Prototypes from rows (text, lang): each task bundles its texts, the sums are added up.

    The driver receives one vector for each task and language. The rows are read once. Texts
    without letters add nothing; an empty table gives a model without languages.
    """

    bound_batches(rows.sparkSession)
    model = HyperModel(dimensions, n)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch, text in slices(batches, "text"):
            vectors = model.bundles(*letters_of(text))
            # each text counts alike, whatever its length
            vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
            langs = np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), object)
            for lang in set(langs):
                total[lang] = total.get(lang, 0) + vectors[langs == lang].sum(0, dtype=np.float64)
        if total:
            yield pa.RecordBatch.from_pydict({"lang": list(total), "vector": pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))})

    sums: dict[str, np.ndarray] = {}
    for lang, vector in rows.select("text", "lang").mapInArrow(bundle, "lang string, vector array<double>").toLocalIterator():
        sums[lang] = sums.get(lang, 0) + np.array(vector)
    model.languages = sorted(sums)
    if sums:
        model.prototypes = np.array([sums[k] / max(np.linalg.norm(sums[k]), 1e-9) for k in model.languages], np.float32)
    return model


def identify_language(df: DataFrame, model: HyperModel, *, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "lang_score", letters_col: str | None = None) -> DataFrame:
    """All columns of ``df`` with the predicted language and its score, and the number of letters
    where a column is named for it; columns of these names are replaced.

    ``und`` with score 0 stands for null texts, texts without a letter, and any text where the
    model has no language. Ties go to the language that is first in alphabetical order. Whole
    texts are read, however long; equal texts have equal results. Rows are handled one by one in
    Arrow batches, without a shuffle; other columns pass through, and an empty table stays empty.
    """
    bound_batches(df.sparkSession)
    made = [T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())]
    made += [T.StructField(letters_col, T.LongType())] if letters_col else []
    df = df.drop(*[f.name for f in made])
    schema = T.StructType([*df.schema.fields, *made])
    languages = [*model.languages, UNDETERMINED]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, text_col):
            best, score, letters = model.predict(*letters_of(text))
            own = [pa.array([languages[k] for k in best], pa.string()), pa.array(score.astype(np.float64)), pa.array(letters.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own[: len(made)]], names=[*batch.schema.names, *[f.name for f in made]])

    return df.mapInArrow(predict, schema)


def drop_unidentified(df: DataFrame, model: HyperModel, *, text_col: str = "text", lang_col: str | None = None, languages: tuple[str, ...] | None = None, least: float = LEAST_SCORE, half_letters: float = HALF_LETTERS) -> DataFrame:
    """The rows of ``df`` whose text is in some language of the model, all columns kept.

    Rejected are texts without a letter (null and empty ones among them), and those whose cosine
    with every language is below ``least * letters / (letters + half_letters)``: what is asked
    grows smoothly with the letters there are. With ``languages``, texts in any other one go too. Where ``lang_col`` names a column of ``df``, kept
    rows without a language get the predicted one. Repeated rows are judged alike; texts are read
    whole; an empty table stays empty; columns of any name pass through.
    """
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = identify_language(whole, model, pred_col="language", score_col="cosine", letters_col="letters")
    like = F.col("cosine") >= least * F.col("letters") / (F.col("letters") + half_letters)
    kept = found.where((F.col("language") != UNDETERMINED) & like)
    if languages is not None:
        kept = kept.where(F.col("language").isin(*languages))
    if lang_col is None:
        return kept.select("row.*")
    return kept.select(*[F.coalesce(F.col("row")[c], F.col("language")).alias(c) if c == lang_col else F.col("row")[c].alias(c) for c in df.columns])
