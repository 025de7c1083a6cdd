"""Language identification by rank-order profiles of character n-grams.

Training: 1- to 3-grams of letters (words padded with a blank) are counted in
each Arrow batch, summed per (language, n-gram) in Spark, and the most
frequent ones of each language, in rank order, are its profile. Prediction: a
document's most frequent n-grams are ranked the same way; its out-of-place
distance to a profile sums the differences of rank, an absent n-gram counting
the profile's length. The nearest profile wins, ties by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmill.llm.common import SLICE_BYTES, bounded_batches, crc32_mod, mix64

_BITS = np.int64(21)  # of a code point


@dataclass(frozen=True)
class ProfileSpec:
    length: int = 400
    folds: int = 4  # crc32(doc_id) mod folds = held_out is not learnt from
    held_out: int = 2
    most_languages: int = 1000  # bounds the broadcast profiles; more raise an error


_IS_LETTER = np.zeros(0x110000, dtype=bool)


def _letters() -> np.ndarray:
    if not _IS_LETTER[ord("a")]:
        for i in range(0x110000):
            if chr(i).isalpha():
                _IS_LETTER[i] = True
    return _IS_LETTER


def ngrams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the lower-cased letters of a text, runs of other characters as one blank.

    An n-gram is one integer of n code points; the blank is 0 and alone is none.
    """
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    code = np.where(_letters()[code], code, 0)
    code = np.concatenate([[0], code, [0]])
    keep = (code != 0) | np.concatenate([[True], code[:-1] != 0])
    code = code[keep]
    one = code[code != 0]
    two = (code[:-1] << _BITS) | code[1:]
    middle = code[1:-1]
    three = ((code[:-2] << (2 * _BITS)) | (middle << _BITS) | code[2:])[middle != 0]
    return np.concatenate([one, two | (np.int64(1) << 62), three])


def _tie(grams: np.ndarray) -> np.ndarray:
    return mix64(grams.astype(np.uint64)).view(np.int64)


def ranked(text: str, length: int) -> np.ndarray:
    """The most frequent n-grams in falling order; ties by a fixed hash of the n-gram."""
    grams = ngrams(text)
    if not len(grams):
        return grams
    own, counts = np.unique(grams, return_counts=True)
    if len(own) > length:
        least = -np.partition(-counts, length - 1)[length - 1]
        own, counts = own[counts >= least], counts[counts >= least]
    return own[np.lexsort((_tie(own), -counts))][:length]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of about SLICE_BYTES characters at a time."""

    def flush(held):
        for lang, grams in held.items():
            own, counts = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(counts.astype(np.int64)), pa.array(_tie(own))],
                names=["lang", "gram", "n", "tie"],
            )

    held, size = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(ngrams(text))
            size += len(text)
            if size > 4 * SLICE_BYTES:
                yield from flush(held)
                held, size = {}, 0
    yield from flush(held)


def profiles(docs: DataFrame, spec: ProfileSpec, lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Language to its ranked n-grams, from ``doc_id``, ``text`` and the language column; null in any is skipped."""
    counts = (
        docs.select(F.col(lang_col).cast("string").alias("lang"), "text")
        .filter("lang is not null and text is not null")
        .mapInArrow(_counter, "lang string, gram long, n long, tie long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.first("tie").alias("tie"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "tie")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= spec.length)
    rows = top.select("lang", "gram", "rank").limit(spec.length * spec.most_languages + 1).collect()
    if len(rows) > spec.length * spec.most_languages:
        raise ValueError(f"more than {spec.most_languages} languages")
    out: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


class Identifier:
    def __init__(self, known: dict[str, np.ndarray], spec: ProfileSpec):
        self.names, self.length = sorted(known), spec.length
        self.tables = []
        for name in self.names:
            order = np.argsort(known[name])
            self.tables.append((known[name][order], order))

    def __call__(self, text: str | None) -> tuple[str, float]:
        own = ranked(text, self.length) if text else np.empty(0, np.int64)
        if not len(own) or not self.names:
            return "und", 0.0
        place, worst = np.arange(len(own)), self.length * len(own)
        distance = []
        for grams, ranks in self.tables:
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            found = grams[at] == own
            distance.append(int(np.where(found, np.abs(ranks[at] - place), self.length).sum()))
        best = int(np.argmin(distance))
        rest = min((x for i, x in enumerate(distance) if i != best), default=worst)
        near = 1 - distance[best] / worst
        lead = (rest - distance[best]) / max(rest, 1)
        return self.names[best], float(min(1.0, max(0.0, 0.5 * near + 0.5 * lead)))


def identify_languages(
    docs: DataFrame, spec: ProfileSpec | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything when nothing could be learnt. Rows with a null id are learnt
    from if their language is known, as crc32 of the empty text is 0. Other
    columns are ignored; an empty table gives an empty result. The score is
    half closeness to the best profile, half its lead over the second.
    """
    spec = spec or ProfileSpec()
    bounded_batches(docs.sparkSession)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    held = crc32_mod(F.col("doc_id"), spec.folds) == spec.held_out
    known = profiles(narrow.filter(~held), spec)
    identify = Identifier(known, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [identify(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    out = narrow.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
