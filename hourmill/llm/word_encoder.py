"""Whole-text encoding with the tokenizers library, each distinct word encoded once per worker.

The tokenizer file's normaliser and pre-tokeniser never join characters across
white space, so a text's ids are its words' ids in a row. A worker keeps the
ids of the words it has seen (bounded; emptied when full) and hands only new
ones to the library. A tokenizer file of another shape, a text with a special
token's string, or one with the rare separators U+001C to U+001F goes to the
library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

import numpy as np

# The normaliser and word pattern for which words can be encoded one by one.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SEPARATORS = re.compile("[\x1c-\x1f]").search  # white space to str.split, not to the tokenizer
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: The same pattern for text of ASCII and the letters U+00C0..U+00FF, lower-cased.
_LATIN = "a-zß-öø-ÿ"
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^\s{_LATIN}0-9]+").findall
_SIMPLE = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*").fullmatch


class WordEncoder:
    def __init__(self, path: str, most_words: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers
        from tokenizers import pre_tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.by_word = self._words_apart(spec)
        # For words that are already normalised and parted: the same model alone.
        self.model_only = tokenizers.Tokenizer(self.tokenizer.model)
        self.model_only.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.most = most_words
        self._clear()

    @staticmethod
    def _words_apart(spec: dict) -> bool:
        norm, pre, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
        steps = pre.get("pretokenizers") or [{}]
        return (
            [n["type"] for n in norm.get("normalizers", [])] == _NORMALIZERS
            and (steps[0].get("pattern") or {}).get("Regex") == _PATTERN
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and model.get("end_of_word_suffix") == "</w>"
            and not model.get("dropout")
            and not spec.get("truncation")
        )

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.used = np.empty(1 << 21, self.dtype), 0
        self.starts = np.empty(1 << 20, np.int64)
        self.sizes = np.empty(1 << 20, np.int64)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, k = len(self.index), len(keys)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while n + k > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.empty_like(self.sizes)])
        self.flat[self.used : self.used + len(ids)] = ids
        ends = np.cumsum(sizes)
        self.starts[n : n + k] = self.used + ends - sizes
        self.sizes[n : n + k] = sizes
        self.used += len(ids)
        self.index.update(zip(keys, range(n, n + k), strict=True))

    def _learn(self, keys: list[str]) -> None:
        """Keys are words that went through the pattern, or a blank and a raw word for the library."""
        raw = [k for k in keys if k[0] == " "]
        if raw:
            found = self._library([k[1:] for k in raw])
            self._store(raw, np.array([i for f in found for i in f], dtype=self.dtype), np.array([len(f) for f in found]))
        parted = [k for k in keys if k[0] != " "]
        step = 500
        lines = [parted[i : i + step] for i in range(0, len(parted), step)]
        for part, e in zip(lines, self.model_only.encode_batch_fast([" ".join(p) for p in lines], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=self.dtype)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                raise AssertionError("a word did not end with one end-of-word token")
            self._store(part, ids, np.diff(cuts, prepend=0))

    def _keys(self, text: str) -> list[str]:
        if _SIMPLE(text):
            return _PIECES(text.lower())
        keys: list[str] = []
        for w in text.split():
            if _SIMPLE(w):
                keys += _PIECES(w.lower())
            else:
                keys.append(" " + w)
        return keys

    def encode(self, texts: Sequence[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of each; null is empty; ``end`` is appended to each."""
        if len(self.index) > self.most:
            self._clear()
        tail = np.array([] if end is None else [end], dtype=self.dtype)
        keys: list[str] = []
        first = [0]
        whole: dict[int, np.ndarray] = {}
        for i, t in enumerate(texts):
            t = t or ""
            if not self.by_word or any(s in t for s in self.specials) or _SEPARATORS(t):
                whole[i] = np.array(self._library([t])[0], dtype=self.dtype)
            else:
                keys += self._keys(t)
            first.append(len(keys))
        get = self.index.get
        at = np.array([get(k, -1) for k in keys], dtype=np.int64)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [keys[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(new)))
            at[missing] = [self.index[k] for k in new]
        sizes, starts = self.sizes[at], self.starts[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]
        before = np.concatenate([[0], ends])[first]
        if not whole and end is None:
            return ids, np.diff(before)
        if not whole:
            return np.insert(ids, before[1:], tail[0]), np.diff(before) + 1
        parts, counts = [], []
        for i in range(len(first) - 1):
            own = whole.get(i, ids[before[i] : before[i + 1]])
            parts += [own, tail]
            counts.append(len(own) + len(tail))
        return np.concatenate(parts), np.array(counts, dtype=np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
