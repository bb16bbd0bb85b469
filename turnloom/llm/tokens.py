"""Token ids of whole texts through the tokenizers library, one distinct word at a time.

A tokenizer of the kind of ``word_bpe`` normalises by NFC, white space to blanks and lower case,
drops white space and never merges across it, nor across the border between a letter and a
following full stop or comma. So the ids of a text are the ids of its pieces in order, and each
distinct piece needs encoding once per worker; the library normalises each piece itself. A letter
counts as such here only if its normalised form ends in one whatever stands before it, which ASCII
and Latin-1 letters do. Texts that hold ``<|`` may contain special tokens, which are matched before
any of this: those go to the library whole, as do all texts with any other kind of tokenizer.
"""

from __future__ import annotations

import json
import os
import sys
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged

#: Distinct pieces that a worker remembers; the memory of the cache is bounded by it.
CACHE_PIECES = 300_000
TOKENIZER = "word_bpe_49k.json"

# The normaliser and the pre-tokenizer for which texts may be cut into pieces, and
# the parts of a tokenizer that must be empty.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_EMPTY = ("truncation", "padding", "post_processor")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def splits_into_pieces(tokenizer: dict) -> bool:
    """Whether the ids of a text are those of its pieces, for a tokenizer file's content."""
    plain = all(not t["normalized"] and "<|" in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in tokenizer["added_tokens"])
    return plain and tokenizer["normalizer"] == _NORMALIZER and tokenizer["pre_tokenizer"] == _PRE_TOKENIZER and not any(tokenizer.get(k) for k in _EMPTY)


class Encoder:
    """Encodes Arrow text arrays to flat ids; by pieces where the tokenizer is of the kind above."""

    def __init__(self, path: str | None = None, by_piece: bool | None = None, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        if by_piece is None:
            with open(path or default_path(), encoding="utf-8") as file:
                by_piece = splits_into_pieces(json.load(file))
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_piece, self.cache_pieces = by_piece, cache_pieces
        self.place: dict[str, int] = {}  # of a piece in sizes and starts
        self.sizes, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    @classmethod
    def of_worker(cls, path: str | None = None) -> Encoder:
        """The encoder that this Python process keeps from task to task, with its cache."""
        kept = sys.modules.setdefault("_turnloom_worker", ModuleType("_turnloom_worker")).__dict__
        if ("encoder", path) not in kept:
            kept["encoder", path] = cls(path)
        return kept["encoder", path]

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each text."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _pieces(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.replace_substring_regex(text, "[\n\t\r]", " ")
        plain = pc.replace_substring_regex(plain, "([A-Za-zÀ-ÖØ-öø-ÿ])([.,])", r"\1 \2")
        words = pc.split_pattern(plain, " ")
        of_doc = words.offsets.to_numpy().astype(np.int64)
        coded = words.values.slice(of_doc[0], of_doc[-1] - of_doc[0]).dictionary_encode()
        known = coded.dictionary.to_pylist()
        found = self.place.get
        at = np.fromiter((found(w, -1) for w in known), np.int64, len(known))
        missing = np.flatnonzero(at < 0)
        flat, sizes, starts = self.flat, self.sizes, self.starts
        if len(missing):
            new = [known[i] for i in missing]
            ids, counts = self._whole(new)
            at[missing] = len(sizes) + np.arange(len(new))
            starts = np.concatenate([starts, len(flat) + np.cumsum(counts) - counts])
            sizes, flat = np.concatenate([sizes, counts]), np.concatenate([flat, ids])
            n = min(self.cache_pieces, len(sizes))
            if n > len(self.sizes):  # pieces beyond the bound are encoded anew each time
                self.place.update(zip(new[: n - len(self.sizes)], range(len(self.sizes), n), strict=True))
                self.sizes, self.starts = sizes[:n].copy(), starts[:n].copy()
                self.flat = flat[: starts[n - 1] + sizes[n - 1]].copy()
        at = at[coded.indices.to_numpy()]
        counts = sizes[at]
        out = flat[ragged(starts[at], counts)]
        return out, np.concatenate([[0], np.cumsum(counts)])[of_doc - of_doc[0]]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the int64 offsets of each text in them."""
        if len(text) == 0:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        special = pc.match_substring(text, "<|").to_numpy(zero_copy_only=False) if self.by_piece else np.ones(len(text), bool)
        if not special.any():
            return self._pieces(text)
        if special.all():
            ids, sizes = self._whole(text.to_pylist())
            return ids, np.concatenate([[0], np.cumsum(sizes)])
        parts = [self.encode(text.slice(i, 1) if special[i] else text.slice(i, j - i)) for i, j in _runs(special)]
        bases = np.cumsum([0] + [p[1][-1] for p in parts])
        return np.concatenate([p[0] for p in parts]), np.concatenate([[0]] + [p[1][1:] + b for p, b in zip(parts, bases, strict=False)])


def _runs(special: np.ndarray) -> list[tuple[int, int]]:
    """Each special row alone, and the longest runs of others between them."""
    runs, start = [], 0
    for i in np.flatnonzero(special):
        if start < i:
            runs.append((start, int(i)))
        runs.append((int(i), int(i) + 1))
        start = int(i) + 1
    if start < len(special):
        runs.append((start, len(special)))
    return runs
