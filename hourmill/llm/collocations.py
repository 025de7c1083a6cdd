"""Phrase collocations from n-gram count streams kept in prefix and in suffix order.

1. Counting. A first pass adds unigrams and bigrams up in an array of counters,
   by hash; a second one trigrams whose bigrams' counters reach the least count
   (one more pass for each further word). A last pass counts, as text, the
   n-grams whose counters all do. The arrays have a fixed size and only save
   rows: a counter is never below the count of an n-gram in it, and whatever is
   let through beyond is dropped by its exact count.
2. Streams. Counts are laid out by range in prefix order (lang, w1, w2, w3), where
   every phrase follows its first words: one lockstep reading of the merged
   unigram, bigram and trigram streams gives each phrase the counts of its first
   words, its left counts, and each (n-1)-gram the counts of its right extensions.
   Laid out once more in suffix order (lang, w3, w2, w1) they give the right counts
   and the left extensions. Nothing is looked up by hash, and as ranges cut a word's
   extensions anywhere, a frequent first word is spread over tasks; a range gets
   the counts of the words it begins within from the ends of the ranges before it.
3. Scores are whole numbers of 38 digits; the best of each language are ranked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmill.llm.common import CHUNKS, array_chunks, bounded_batches, mix64, summed_array, text_buffer, word_hashes, write_scratch
from hourmill.session import shared_root


@dataclass(frozen=True)
class PhraseSpec:
    words: int = 3  # of the longest phrase
    least: int = 10  # occurrences of a candidate
    nested: int = 50  # percent: a phrase goes if a longer candidate around it has so much of its count
    keep: int = 2000  # phrases of a language
    slice_bytes: int = 4 << 20  # text counted at once
    most_bits: int = 26  # 2**most_bits counters at most; fewer for small tables


_KIND = np.zeros(256, dtype=np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class _Slice:
    """N-grams of some documents: ``tokens`` numbers each word by (language, word), ``joined`` says which touch."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        raw, offsets = text_buffer(texts)
        kind = _KIND[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[offsets] = True
        inside = kind == 0
        starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1] | edge[1:-1]]) if len(raw) else np.empty(0, np.int64)
        ends = np.flatnonzero(inside & np.r_[~inside[1:] | edge[1:-1], True]) + 1 if len(raw) else np.empty(0, np.int64)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        cuts = np.r_[0, np.cumsum(kind == 2)]
        self.joined = (owner[1:] == owner[:-1]) & (cuts[starts[1:]] == cuts[ends[:-1]])
        data = _LOWER[raw[inside]]
        bounds = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        lang = pc.fill_null(langs, "und").dictionary_encode()
        self.langs = lang.dictionary
        spoken = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
        width = max(len(words.dictionary), 1)
        pairs, self.tokens = np.unique(spoken * width + words.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        self.words, self.lang = words.dictionary.take(pa.array(pairs % width)), pairs // width
        self.totals = np.bincount(spoken, minlength=len(self.langs))

    def hashes(self) -> np.ndarray:
        """Of each token; used for the counters only."""
        flat, at = text_buffer(self.words)
        own = np.zeros(len(self.words), dtype=np.uint64)
        full = np.flatnonzero(np.diff(at))
        own[full] = word_hashes(flat, at[:-1][full], at[1:][full])
        flat, at = text_buffer(self.langs)
        salt = np.array([hash_bytes(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], dtype=np.uint64)
        return mix64(own + salt[self.lang]) if len(own) else own

    def grams(self, sketches: list[np.ndarray], longest: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places, their hashes) of n-grams up to ``longest`` words whose parts' counters reach ``least``.

        Counters of one and two words are in the first sketch, of three in the second, and so on.
        """
        if not len(self.tokens):
            return
        own = self.hashes()[self.tokens]
        h, runs = own, np.ones(len(own), dtype=bool)
        for length in range(1, longest + 1):
            if length > 1:
                h = _pair_hash(h[:-1], own[length - 1 :])
                runs = runs[:-1] & runs[1:]
                if length == 2:
                    runs &= self.joined
            if max(0, length - 2) < len(sketches):
                sketch = sketches[max(0, length - 2)]
                at = np.flatnonzero(runs)
                runs = np.zeros(len(runs), dtype=bool)
                runs[at[sketch[_slots(h[at], sketch)] >= min(least, 255)]] = True
            places = np.flatnonzero(runs)
            yield length, places, h[places]


def _slots(h: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    return (h & np.uint64(len(sketch) - 1)).astype(np.int64)


def hash_bytes(data: bytes) -> int:
    import zlib

    return int(mix64(np.array([zlib.crc32(data) + 1], dtype=np.uint64))[0])


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * np.uint64(0xD1B54A32D192ED03) + mix64(b))


def _slices(batches: Iterator[pa.RecordBatch], spec: PhraseSpec) -> Iterator[_Slice]:
    """Batches (text, lang) gathered to about ``slice_bytes`` of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= spec.slice_bytes:
            table = pa.Table.from_batches(held).combine_chunks()
            yield _Slice(table.column(0).chunk(0), table.column(1).chunk(0))
            held, size = [], 0
    rows = sum(b.num_rows for b in held)
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield _Slice(table.column(0).chunk(0), table.column(1).chunk(0))


def _sketcher(sketches, length: int, bits: int, spec: PhraseSpec):
    """(text, lang) to CHUNKS of counters of n-grams of ``length`` words (of two: and of one), each stopping at 255."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint8)
        for s in _slices(batches, spec):
            for n, _, h in s.grams([b.value for b in sketches], length, spec.least):
                if n == length or length == 2:
                    at, c = np.unique(_slots(h, counters), return_counts=True)
                    counters[at] = np.minimum(counters[at] + c, 255).astype(np.uint8)
        yield from array_chunks(counters)

    return count


def _text_counter(sketches, spec: PhraseSpec):
    """(text, lang) to (lang, phrase, c): counts of a slice's n-grams that the sketches let through, and its words by language (phrase null)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches, spec):
            yield pa.RecordBatch.from_arrays([s.langs.cast(pa.string()), pa.nulls(len(s.langs), pa.string()), pa.array(s.totals, pa.int64())], names=["lang", "phrase", "c"])
            gram = np.zeros(len(s.tokens), dtype=np.int64)  # the n-gram that begins at each place, numbered
            for length, places, _ in s.grams([b.value for b in sketches], spec.words, spec.least):
                if not len(places):
                    break
                keys = gram[places] * len(s.words) + s.tokens[places + length - 1]
                keys, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
                one = np.zeros(len(keys), dtype=np.int64)
                one[inverse] = places  # a place where each occurs
                yield _phrases(s, [s.tokens[one + j] for j in range(length)], n)
                gram = np.zeros(len(gram), dtype=np.int64)
                gram[places] = inverse

    return count


def _phrases(s: _Slice, tokens: list[np.ndarray], n: np.ndarray) -> pa.RecordBatch:
    parts = [s.words.take(pa.array(t)).cast(pa.large_string()) for t in tokens]
    phrase = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
    lang = s.langs.take(pa.array(s.lang[tokens[0]]))
    return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "c"])


def frequent_phrases(texts: DataFrame, spec: PhraseSpec) -> tuple[DataFrame, DataFrame]:
    """((lang, words, n, f) of all n-grams that occur ``least`` times, (lang, total) words of a language)."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(spec.most_bits, max(16, (int(size) // 32).bit_length()))
    sketches = []
    for length in range(2, spec.words + 1):
        counted = texts.mapInArrow(_sketcher(list(sketches), length, bits, spec), CHUNKS)
        sketches.append(spark.sparkContext.broadcast(summed_array(counted, 1 << bits, "uint8", "uint8")))  # 2**most_bits bytes at most
    counted = texts.mapInArrow(_text_counter(sketches, spec), "lang string, phrase string, c long").groupBy("lang", "phrase").agg(F.sum("c").alias("f"))
    grams = write_scratch(counted.filter(f"phrase is null or f >= {spec.least}"), "phrase-counts")
    totals = grams.filter("phrase is null").select("lang", F.col("f").alias("total"))
    words = grams.filter("phrase is not null").withColumn("words", F.split("phrase", " "))
    return words.select("lang", "words", F.size("words").alias("n"), "f"), totals


def _in_order(stream: DataFrame, order) -> DataFrame:
    """Laid out by range and sorted; a reliable checkpoint keeps ranges, their order and their rows."""
    shared_root(stream.sparkSession)
    keyed = stream.withColumn("order", order)
    return keyed.repartitionByRange("lang", "order").sortWithinPartitions("lang", "order").drop("order").checkpoint()


def _ends(lengths: int):
    """(n, f) of a range to one row: its number and its last count of each length (null: none)."""

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[int | None] = [None] * lengths
        for batch in batches:
            n, f = (np.asarray(c) for c in batch.columns)
            for k in range(lengths):
                found = np.flatnonzero(n == k + 1)
                if len(found):
                    last[k] = int(f[found[-1]])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([last], pa.list_(pa.int64()))], names=["range", "last"])

    return end


def _reader(carried: dict[int, list[int | None]], lengths: int):
    """A range in order, read in lockstep: (lang, words, n, f, ..) and the last count of each length up to each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = list(carried.get(TaskContext.get().partitionId(), [None] * lengths))
        for batch in batches:
            n, f = np.asarray(batch.column("n")), np.asarray(batch.column("f"))
            heads = []
            for k in range(lengths):
                at = np.maximum.accumulate(np.where(n == k + 1, np.arange(len(n)), -1))
                counts = np.where(at >= 0, f[at], last[k] or 0)
                heads.append(pa.array(counts, pa.int64()))
                last[k] = int(counts[-1]) if len(counts) and counts[-1] else last[k]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1) * lengths, pa.int32()), pa.array(np.stack([np.asarray(h) for h in heads], axis=1).ravel(), pa.int64())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "heads"])

    return read


def with_heads(stream: DataFrame, order, out: str, lengths: int) -> DataFrame:
    """The stream plus ``out``: for k = 1.. ``lengths`` the count of the k words that begin its phrase in this order.

    Each such part is itself in the stream (it is no rarer) and comes before the
    phrase, so reading in order the last k-gram passed is the right one.
    """
    laid = _in_order(stream, order)
    ends = {r["range"]: r["last"] for r in laid.select("n", "f").mapInArrow(_ends(lengths), "range int, last array<long>").collect()}  # one row a range
    carried: dict[int, list[int | None]] = {}
    last: list[int | None] = [None] * lengths
    for part in sorted(ends):
        carried[part] = list(last)
        last = [own if own is not None else old for own, old in zip(ends[part], last, strict=True)]
    schema = laid.schema.simpleString()[len("struct<") : -1]
    return laid.mapInArrow(_reader(carried, lengths), f"{schema},heads:array<bigint>").withColumnRenamed("heads", out)


def collocations(docs: DataFrame, spec: PhraseSpec | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    Null and empty texts have no words; a null language is ``und``, as the text
    ``und`` itself. Repeated rows count as often as they stand there. A language
    without a candidate gives no rows, nor does an empty table. Other columns are
    ignored, whatever their names. Counts up to 10**16 are exact.
    """
    spec = spec or PhraseSpec()
    if spec.words < 2:
        raise ValueError("phrases have two words at least")
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    grams, totals = frequent_phrases(texts, spec)
    left = with_heads(grams, F.col("words"), "lefts", spec.words - 1)
    both = write_scratch(with_heads(left, F.reverse("words"), "rights", spec.words - 1).filter("n > 1"), "phrase-parts")

    cuts = []
    for k in range(1, spec.words):
        r = f"element_at(rights, n - {k})"
        score = f"(cast(f as decimal(16,0)) * cast(f as decimal(16,0)) * 1000000) div (cast(lefts[{k - 1}] as decimal(16,0)) * cast({r} as decimal(16,0)))"
        cuts.append(f"case when n > {k} then named_struct('score', {score}, 'k', {k}, 'l', lefts[{k - 1}], 'r', {r}) end")
    worst = F.expr(f"array_min(filter(array({', '.join(cuts)}), x -> x is not null))")
    # A longer phrase leaves out one end or the other; one that is two words longer holds such a phrase, no rarer.
    longer = both.filter("n > 2")
    gone = (
        longer.filter(f"100 * f >= {spec.nested} * element_at(lefts, n - 1)").select("lang", F.expr("slice(words, 1, n - 1)").alias("words"))
        .unionByName(longer.filter(f"100 * f >= {spec.nested} * element_at(rights, n - 1)").select("lang", F.expr("slice(words, 2, n - 1)").alias("words")))
    )
    scored = both.join(gone, ["lang", "words"], "left_anti").select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), worst.alias("w"))
    scored = scored.select("lang", "phrase", "a", "w.l", "w.r", "w.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= spec.keep)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
