"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, buffers, free, materialize, slices

#: Labelled documents that training takes at most: those with the smallest hashes.
MAX_TRAINING_DOCS = 6_000
#: Lines of all training documents together at most; a document that would exceed it is left out.
MAX_TRAINING_LINES = 400_000
#: Lines of a training document that form one chain; longer documents give several.
CHAIN_LINES = 200
BINS = 10
#: Rounds of training at most; it ends when ten of them have lowered the loss by less than this part.
ROUNDS = 240
LEAST_GAIN = 2e-3

FEATURES = ("length", "words", "word_length", "upper", "digits", "marks", "symbols", "exclaims", "bars", "repeats", "pairs", "ends_sentence", "starts_upper", "space", "copies")

# Byte classes: 0 rest of a character, 1 upper case, 2 other letters, 3 digits, 4 space, 5 marks of
# normal sentences, 6 symbols, 7 exclamation mark, 8 bar.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("a") : ord("z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[0x20, *range(9, 14)]] = 4
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5
_CLASS[ord("!")] = 7
_CLASS[ord("|")] = 8
_CLASS[0x80:0xC0] = 0
_CLASS[0xC0:] = 2
_WORD_CODE = np.random.default_rng(3).integers(0, 1 << 62, 256, dtype=np.int64)


def line_features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text, the lines' bytes, and offsets of texts in the lines.

    Lines end at a line feed; an empty text has one empty line.
    """
    raw, ends = buffers(text)
    breaks = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([ends[:-1], breaks + 1]), kind="stable")
    n = len(starts)
    bounds = np.append(starts, len(raw))
    sizes = np.diff(bounds)
    of_doc = np.concatenate([[0], np.cumsum(1 + np.diff(np.searchsorted(breaks, ends)))])
    kind = _CLASS[raw]
    if len(raw) > 1:  # capital letters of two bytes, from À to Þ
        kind[:-1][(raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)] = 1
    line = np.repeat(np.arange(n, dtype=np.int64), sizes)
    count = np.bincount(line * 9 + kind, minlength=9 * n).reshape(n, 9).astype(np.float64)
    chars = np.maximum(count[:, 1:].sum(1), 1)
    letters = np.maximum(count[:, 1] + count[:, 2], 1)

    blank = kind == 4
    first = ~blank
    first[1:] &= blank[:-1] | (line[1:] != line[:-1])
    at = np.flatnonzero(first)
    word_line = line[at]
    words = np.bincount(word_line, minlength=n).astype(np.float64)
    code = np.where(blank, 0, _WORD_CODE[raw])
    # each byte turns with its place in the word, so that anagrams differ
    place = np.arange(len(raw)) - np.repeat(at, np.diff(np.append(at, len(raw)))) if len(at) and at[0] == 0 else np.arange(len(raw)) - (at[np.maximum(np.searchsorted(at, np.arange(len(raw)), side="right") - 1, 0)] if len(at) else 0)
    code = code * (2 * place + 1)
    hashes = np.add.reduceat(code, at) if len(at) else np.zeros(0, np.int64)
    repeats = np.bincount(word_line[1:][(hashes[1:] == hashes[:-1]) & (word_line[1:] == word_line[:-1])], minlength=n)
    pairs = np.zeros(n)
    if len(at) > 1:
        pair = hashes[1:] * 31 + hashes[:-1]
        same = word_line[1:] == word_line[:-1]
        doc_of_line = np.repeat(np.arange(len(of_doc) - 1), np.diff(of_doc))
        key = pair[same] ^ (doc_of_line[word_line[1:][same]] * 0x9E3779B97F4A7C1 & 0x3FFFFFFFFFFFFFFF)
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        pairs = np.bincount(word_line[1:][same], weights=times[inverse] > 1, minlength=n)
    nth = np.arange(len(at)) - np.searchsorted(word_line, word_line)
    line_hash = np.bincount(word_line, weights=(hashes % 1_000_003 * (nth % 9973 + 1)).astype(np.float64), minlength=n)
    copies = np.zeros(n)
    doc_line = np.repeat(np.arange(len(of_doc) - 1), np.diff(of_doc))
    order = np.lexsort((line_hash, doc_line))
    equal = (line_hash[order][1:] == line_hash[order][:-1]) & (doc_line[order][1:] == doc_line[order][:-1]) & (words[order][1:] > 0)
    copies[order[1:]] += equal
    copies[order[:-1]] += equal

    visible = np.flatnonzero(~blank)
    closing, opening = np.zeros(n), np.zeros(n)
    if len(visible):
        line_visible = line[visible]
        last = np.flatnonzero(np.append(line_visible[1:] != line_visible[:-1], True))
        closing[line_visible[last]] = np.isin(raw[visible[last]], [ord(c) for c in ".?!\"')"])
        opening[word_line] = 0
        lead = np.flatnonzero(np.append(True, line_visible[1:] != line_visible[:-1]))
        opening[line_visible[lead]] = kind[visible[lead]] == 1
    features = np.stack(
        [
            np.log1p(chars), np.log1p(words), chars / np.maximum(words, 1), count[:, 1] / letters, count[:, 3] / chars, count[:, 5] / chars, count[:, 6] / chars,
            count[:, 7] / chars, count[:, 8] / chars, repeats / np.maximum(words, 1), pairs / np.maximum(words, 1), closing, opening, count[:, 4] / chars, np.minimum(copies, 2),
        ], 1,
    )
    return features.astype(np.float32), sizes, of_doc


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class LineCrf:
    """Two labels, bad 0 and good 1; binned features of a line and of both neighbours."""

    def __init__(self, bins: int = BINS, rounds: int = ROUNDS, decay: float = 1e-3):
        self.bins, self.rounds, self.decay = bins, rounds, decay
        self.edges = [np.zeros(0)] * len(FEATURES)
        self.weights = np.zeros((3, len(FEATURES) * (bins + 1) + 1))
        self.moves = np.zeros((2, 2))
        self.scale = np.array([1.0, 0.0])

    def _columns(self, features: np.ndarray) -> np.ndarray:
        width = self.bins + 1
        return np.stack([f * width + np.searchsorted(e, c, side="left") for f, (e, c) in enumerate(zip(self.edges, features.T, strict=True))], 1)

    def _emission(self, columns: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log-odds of good for each line; a missing neighbour has a weight of its own."""
        own, before, after = (w[columns].sum(1) for w in self.weights)
        edge = self.weights[:, -1]
        before = np.where(first, edge[1], np.append(0, before[:-1]))
        after = np.where(last, edge[2], np.append(after[1:], 0))
        return own + before + after + edge[0]

    def marginals(self, odds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over all chains at once: P(good) per line and P(move) sums per pair."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = offsets[:-1][order], lengths[order]
        top = int(lengths.max(initial=0))
        active = np.searchsorted(-lengths, -np.arange(top), side="left")
        score = np.stack([np.zeros(len(odds)), odds], 1)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        for t in range(top):
            at = starts[: active[t]] + t
            if t:
                x = forward[at - 1][:, :, None] + self.moves
                forward[at] = score[at] + np.logaddexp(x[:, 0], x[:, 1])
            else:
                forward[at] = score[at]
        for t in range(top - 2, -1, -1):
            at = starts[: active[t + 1]] + t
            x = (backward[at + 1] + score[at + 1])[:, None, :] + self.moves
            backward[at] = np.logaddexp(x[:, :, 0], x[:, :, 1])
        both = forward + backward
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -60, 60)))
        inner = np.ones(len(odds), bool)
        inner[offsets[:-1][np.diff(offsets) > 0]] = False
        b = np.flatnonzero(inner)
        pair = forward[b - 1][:, :, None] + self.moves + (score[b] + backward[b])[:, None, :]
        pair -= np.logaddexp(both[b][:, 0], both[b][:, 1])[:, None, None]
        return good, np.exp(np.minimum(pair, 0)).sum(0)

    def fit(self, features: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, good: np.ndarray) -> LineCrf:
        """Maximum likelihood with lines labelled like their documents, by Adam.

        Chains count alike whatever their number of lines; inside a chain lines count by length,
        as they do in the score.
        """
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in features.T]
        if not len(features):
            return self
        columns = self._columns(features)
        lengths = np.diff(offsets)
        weight = np.maximum(sizes, 1).astype(float)
        weight /= np.repeat(np.add.reduceat(weight, offsets[:-1]), lengths)
        target = np.repeat(good.astype(float), lengths)
        first, last = np.zeros(len(features), bool), np.zeros(len(features), bool)
        first[offsets[:-1][lengths > 0]], last[offsets[1:][lengths > 0] - 1] = True, True
        inner = np.flatnonzero(~first)
        want = np.zeros((2, 2))
        np.add.at(want, (target[inner - 1].astype(int), target[inner].astype(int)), 1)
        parameters = [self.weights, self.moves]
        mean = [np.zeros_like(p) for p in parameters]
        square = [np.zeros_like(p) for p in parameters]
        total, losses = weight.sum(), []
        for step in range(1, self.rounds + 1):
            p, moved = self.marginals(self._emission(columns, first, last), offsets)
            losses.append(-float((weight * np.log(np.clip(np.where(target > 0.5, p, 1 - p), 1e-9, 1))).sum()))
            if step > 20 and losses[-11] - losses[-1] < LEAST_GAIN * losses[-11]:
                break
            gap = (target - p) * weight
            grad = np.zeros_like(self.weights)
            size = self.weights.shape[1]
            shifted = (gap, np.where(last, 0, np.append(gap[1:], 0)), np.where(first, 0, np.append(0, gap[:-1])))
            for k, g in enumerate(shifted):
                grad[k] = np.bincount(columns.ravel(), np.repeat(g, columns.shape[1]), size)
            grad[0, -1], grad[1, -1], grad[2, -1] = gap.sum(), gap[first].sum(), gap[last].sum()
            for q, g, m, s in zip(parameters, (grad / total - self.decay * self.weights, (want - moved) / max(1, len(inner)) - 0.05 * self.moves), mean, square, strict=True):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                q += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        p, _ = self.marginals(self._emission(columns, first, last), offsets)
        full = np.flatnonzero(lengths)
        self._calibrate(np.add.reduceat(p * weight, offsets[:-1][full]), good[full].astype(float))
        return self

    def _calibrate(self, mean: np.ndarray, good: np.ndarray) -> None:
        """Logistic regression of the labels on the log-odds of the weighted mean, by Newton steps."""
        x = np.stack([_log_odds(mean), np.ones(len(mean))], 1)
        for _ in range(20):
            p = 1 / (1 + np.exp(-np.clip(x @ self.scale, -60, 60)))
            hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 0.1
            self.scale = self.scale + np.linalg.solve(hess, x.T @ (good - p) - 0.1 * (self.scale - [1.0, 0.0]))

    def score(self, text: pa.Array) -> np.ndarray:
        """P(good) of each text: its lines' marginals, weighted by their lengths, calibrated."""
        features, sizes, offsets = line_features(text)
        first, last = np.zeros(len(features), bool), np.zeros(len(features), bool)
        first[offsets[:-1]], last[offsets[1:] - 1] = True, True
        good, _ = self.marginals(self._emission(self._columns(features), first, last), offsets)
        weight = np.maximum(sizes, 1).astype(np.float64)
        if not len(text):
            return np.zeros(0)
        mean = np.add.reduceat(good * weight, offsets[:-1]) / np.add.reduceat(weight, offsets[:-1])
        return 1 / (1 + np.exp(-np.clip(_log_odds(mean) * self.scale[0] + self.scale[1], -60, 60)))


def train_quality_model(df: DataFrame, labels: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_docs: int = MAX_TRAINING_DOCS, max_lines: int = MAX_TRAINING_LINES) -> LineCrf:
    """Fit on at most ``max_docs`` labelled documents that ``learn``, a condition on ``id``, allows.

    ``labels`` holds (id, 0 or 1); a document labelled both ways counts as good, and of texts with
    equal ids the first in order is taken. The texts are read once, into a table of the sample; the
    line features of its documents, in the order of their hashes and up to ``max_lines`` lines, come
    to the driver, which the two bounds make small. Null texts count as empty; null ids are left
    out; empty tables give a model that scores all texts alike.
    """
    bound_batches(df.sparkSession)
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good"))
        .where(learn & F.col("good").isin(0, 1) & F.col("id").isNotNull())
        .groupBy("id").agg(F.max("good").alias("good"))
        .orderBy(F.xxhash64("id"), "id").limit(max_docs)
    )
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    sample = materialize(rows.groupBy("id").agg(F.min("text").alias("text"), F.first("good").alias("good")), "quality-sample")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    taken, total = set(), 0
    for key, n, _ in sorted(sample.select(F.col("id").cast("string"), lines, F.xxhash64("id")).collect(), key=lambda r: (r[2], r[0])):
        if total + n <= max_lines:
            taken.add(key)
            total += n

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, "text", 1 << 20):
            found, sizes, offsets = line_features(text)
            found = np.column_stack([found, sizes.astype(np.float32)])
            packed = [found[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], names=["id", "features", "good"])

    parts, lengths, good = [], [], []
    wanted = sample.select(F.col("id").cast("string").alias("id"), "text", "good").where(F.col("id").isin(*taken) if taken else F.lit(False))
    for r in sorted(wanted.mapInArrow(features, "id string, features binary, good int").collect(), key=lambda r: r[0]):
        table = np.frombuffer(r[1], np.float32).reshape(-1, len(FEATURES) + 1)
        for a in range(0, len(table), CHAIN_LINES):
            parts.append(table[a : a + CHAIN_LINES])
            lengths.append(len(parts[-1]))
            good.append(r[2])
    free(sample)
    table = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES) + 1), np.float32)
    return LineCrf().fit(table[:, :-1], table[:, -1], np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), np.array(good))


def score_quality(df: DataFrame, model: LineCrf, *, text_col: str = "text", score_col: str = "quality_score") -> DataFrame:
    """All columns of ``df`` with a score, 0 to 1, higher where good is likelier.

    Null counts as the empty text, which is one empty line. Whole texts are read, however long, in
    Arrow batches, without a shuffle; equal texts have equal scores; repeated rows all stay. A
    column of the score's name is replaced, others pass through; an empty table stays empty.
    """
    bound_batches(df.sparkSession)
    df = df.drop(score_col)
    schema = T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in slices(batches, text_col, 1 << 20):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(text))], names=[*batch.schema.names, score_col])

    return df.mapInArrow(score, schema)
