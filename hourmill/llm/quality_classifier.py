"""Document quality: ridge regression on random Fourier features, isotonic calibration.

Each text becomes twelve statistics (one pass, numpy on Arrow batches). After
standardising, D random Fourier features cos(Wx + b) stand for a Gaussian
kernel. The normal equations are summed inside each partition and then by
row of the matrix in Spark; the driver solves one D x D system whatever the
number of rows. Calibration takes labelled rows that the fit has not seen,
binned by raw score in Spark, and pools adjacent violators over the bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmill.llm.common import bounded_batches, crc32_mod, doc_slices, text_buffer, word_hashes, word_spans, write_scratch
from hourmill.llm.quality_rules import STOP_WORDS

FEATURES = (
    "log_words", "word_bytes", "upper", "symbols", "digits", "marks",
    "plain_words", "stop_words", "distinct_words", "top_word", "repeats", "line_words",
)


@dataclass(frozen=True)
class ClassifierSpec:
    features: int = 192
    width: float = 2.0  # of the Gaussian kernel, in standard deviations of a statistic
    ridge: float = 1e-3  # per training row
    seed: int = 7
    folds: int = 5  # crc32(doc_id) mod folds = 0 is held out
    calibration_fold: int = 4  # held back from the fit, used to calibrate
    bins: int = 2000
    threshold: float = 0.3


def _class_table(chars: str) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[[ord(c) for c in chars]] = True
    return t


_UPPER = _class_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class_table("0123456789")
_SYMBOL = _class_table("#*$%&|<>{}[]=~^\\_@")
_MARK = _class_table(".,;:!?\"'()-")
_LETTER = _class_table("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER[128:] = True
_NEWLINE = _class_table("\n")


def _hash_words(words: list[str]) -> np.ndarray:
    raw, offsets = text_buffer(pa.array([" ".join(words)]))
    starts, ends, _ = word_spans(raw, offsets)
    return np.unique(word_hashes(raw, starts, ends))


def text_statistics(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; an empty or null text has zeros."""
    raw_all, offsets_all = text_buffer(column)
    out = np.zeros((len(column), len(FEATURES)))
    stop = _hash_words(STOP_WORDS)
    for a, b in doc_slices(offsets_all):
        raw = raw_all[offsets_all[a] : offsets_all[b]]
        offsets = offsets_all[a : b + 1] - offsets_all[a]
        starts, ends, first = word_spans(raw, offsets)
        if not len(starts):
            continue

        def per_doc(table, raw=raw, offsets=offsets):
            total = np.concatenate([[0], np.cumsum(table[raw])])
            return total[offsets[1:]] - total[offsets[:-1]]

        letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
        marks = np.concatenate([[0], np.cumsum(_MARK[raw])])
        inner = letters[ends] - letters[starts] + marks[ends] - marks[starts]
        plain = (inner == ends - starts) & (letters[ends] > letters[starts])
        hashes = word_hashes(raw, starts, ends)
        is_stop = np.isin(hashes, stop)
        same = np.zeros(len(hashes), dtype=bool)
        same[1:] = hashes[1:] == hashes[:-1]
        same[first[:-1][np.diff(first) > 0]] = False  # the word before is another document's
        n_words = np.maximum(np.diff(first), 1)
        n_bytes = np.maximum(np.diff(offsets), 1)
        by_word = lambda flag, first=first: np.diff(np.concatenate([[0], np.cumsum(flag)])[first])
        rows = out[a:b]
        rows[:, 0] = np.log1p(np.diff(first))
        rows[:, 1] = by_word(ends - starts) / n_words
        rows[:, 2] = per_doc(_UPPER) / n_bytes
        rows[:, 3] = per_doc(_SYMBOL) / n_words
        rows[:, 4] = per_doc(_DIGIT) / n_bytes
        rows[:, 5] = per_doc(_MARK) / n_words
        rows[:, 6] = by_word(plain) / n_words
        rows[:, 7] = by_word(is_stop) / n_words
        rows[:, 10] = by_word(same) / n_words
        rows[:, 11] = np.log1p(n_words / (1 + per_doc(_NEWLINE)))
        for d in np.flatnonzero(np.diff(first)):
            _, counts = np.unique(hashes[first[d] : first[d + 1]], return_counts=True)
            rows[d, 8] = len(counts) / n_words[d]
            rows[d, 9] = counts.max() / n_words[d]
        rows[np.diff(first) == 0] = 0  # without a word
    return out


class FourierMap:
    """Standardised statistics to 1 and D cosines; the same on every executor by its seed."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, spec: ClassifierSpec):
        rng = np.random.default_rng(spec.seed)
        self.mean, self.scale = mean, 1 / np.where(std > 1e-9, std, 1.0)
        self.w = rng.normal(size=(len(FEATURES), spec.features)) / (spec.width * np.sqrt(len(FEATURES) / 4))
        self.b = rng.uniform(0, 2 * np.pi, spec.features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -8, 8)
        phi = np.cos(z @ self.w + self.b) * np.sqrt(2 / self.w.shape[1])
        return np.concatenate([np.ones((len(x), 1)), phi], axis=1)


@dataclass
class QualityModel:
    fourier: FourierMap
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        return self.fourier(statistics) @ self.weights

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(statistics), self.knots, self.levels), 0.0, 1.0)


def statistics_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its FEATURES as array<double> ``x``, one row per input row."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = text_statistics(batch.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], names=["doc_id", "x"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, x array<double>")


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _pool(score: np.ndarray, total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic levels of binned 0/1 labels: adjacent bins that fall are pooled."""
    blocks: list[list[float]] = []
    for s, n, k in zip(score, total, ones, strict=True):
        blocks.append([n, k, s, s])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, k2, _, hi = blocks.pop()
            blocks[-1][0] += n2
            blocks[-1][1] += k2
            blocks[-1][3] = hi
    knots = np.array([e for b in blocks for e in (b[2], b[3] + 1e-9)])
    return knots, np.repeat([(b[1]) / b[0] for b in blocks], 2)


def fit(statistics: DataFrame, labels: DataFrame, spec: ClassifierSpec | None = None, label_col: str = "quality") -> QualityModel | None:
    """A model of P(label = 1) from all labelled rows outside the held-out fold.

    Rows with a null id or label, or a label other than 0 and 1, are not used.
    An id labelled twice counts twice. None if no labelled row is left.
    """
    spec = spec or ClassifierSpec()
    wanted = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y in (0, 1)")
    fold = crc32_mod(F.col("doc_id"), spec.folds)
    rows = write_scratch(
        wanted.filter(fold != 0).join(statistics, "doc_id").select("x", "y", fold.alias("fold")), "labelled"
    )
    d = len(FEATURES)
    moments = rows.agg(
        F.count("*").alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    ).first()
    if not moments["n"]:
        return None
    fourier = FourierMap(np.array([moments[f"m{i}"] for i in range(d)]), np.array([moments[f"s{i}"] for i in range(d)]), spec)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = spec.features + 1
        normal, n = np.zeros((size, size + 1)), 0
        for batch in batches:
            if batch.num_rows:
                phi, y = fourier(_matrix(batch, 0)), batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                normal += phi.T @ np.concatenate([phi, y[:, None]], axis=1)
                n += batch.num_rows
        if n:
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, normal.size + 1, size + 1, dtype=np.int32)), pa.array(normal.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), flat], names=["i", "row"])

    def add(pdf):
        import pandas as pd

        return pd.DataFrame({"i": [pdf["i"].iloc[0]], "row": [np.sum(np.stack(pdf["row"].to_list()), axis=0)]})

    fit_on = rows.filter(F.col("fold") != spec.calibration_fold).select("x", "y")
    calibrate_on = rows.filter(F.col("fold") == spec.calibration_fold).select("x", "y")
    if fit_on.isEmpty():
        fit_on = rows.select("x", "y")
    if calibrate_on.isEmpty():
        calibrate_on = rows.select("x", "y")
    parts = fit_on.mapInArrow(sums, "i int, row array<double>").groupBy("i").applyInPandas(add, "i int, row array<double>")
    # D + 1 rows of D + 2 numbers, whatever the input.
    normal = np.array([r["row"] for r in sorted(parts.collect(), key=lambda r: r["i"])])
    gram, target = normal[:, :-1], normal[:, -1]
    weights = np.linalg.solve(gram + np.eye(len(gram)) * spec.ridge * max(gram[0, 0], 1.0), target)
    model = QualityModel(fourier, weights, np.array([0.0]), np.array([0.0]))

    def raw_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch, 0)), -0.5, 1.5)
            bins = np.round((raw + 0.5) * spec.bins / 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], names=["bin", "y"])

    # At most spec.bins + 1 rows.
    binned = (
        calibrate_on.mapInArrow(raw_scores, "bin long, y int")
        .groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("k")).orderBy("bin").collect()
    )
    at = np.array([r["bin"] for r in binned]) * 2 / spec.bins - 0.5
    model.knots, model.levels = _pool(at, np.array([r["n"] for r in binned], float), np.array([r["k"] for r in binned], float))
    return model


def score_documents(
    docs: DataFrame, labels: DataFrame, spec: ClassifierSpec | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted.

    Null and empty texts are scored from their statistics, all zero. A null
    id is held out. Without any usable label the score is 0.5. Other columns,
    whatever their names, are not read; an empty table gives an empty result.
    """
    spec = spec or ClassifierSpec()
    stats = write_scratch(statistics_table(docs, id_col, text_col), "text-statistics")
    model = fit(stats, labels, spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_matrix(batch, 1)) if model and batch.num_rows else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        (crc32_mod(F.col("doc_id"), spec.folds) == 0).alias("held_out"),
        "score",
        (F.col("score") >= spec.threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, spec: ClassifierSpec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` scored at or above the threshold, with their own columns.

    Whole rows pass through the scoring pass, so no join shuffles the texts.
    """
    spec = spec or ClassifierSpec()
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    sample = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stats = write_scratch(statistics_table(sample), "text-statistics")
    model = fit(stats.join(known, "doc_id", "left_semi"), labels, spec)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and model:
                good = model.score(text_statistics(batch.column(at).cast(pa.string()))) >= spec.threshold
                batch = batch.filter(pa.array(good))
            yield batch

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema.fields])
    return docs.mapInArrow(run, schema)
