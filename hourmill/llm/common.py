"""Helpers the text operators share: Arrow buffers, word hashes, scratch tables, an id filter.

Words are runs of bytes outside ``\\x20\\x09-\\x0D``. Python code here only
ever sees one Arrow batch of a partition; Spark deals the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmill.session import remove_path, scratch_path

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A") : ord("Z") + 1] += 32
LOWER += np.uint64(1)

#: Documents are worked on in slices of about this many bytes.
SLICE_BYTES = 1 << 20
#: Rows in one Arrow batch; Spark's own default (10,000) would be 1 GB of long documents.
BATCH_ROWS = 512

def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for documents; a lower setting of the user's stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def write_scratch(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(*frames: DataFrame) -> None:
    """Delete what ``write_scratch`` wrote for frames that nothing reads any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 2)[-2] == "hourmill":
                remove_path(df.sparkSession, folder)


def release_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of finished jobs once the driver collects their plans; loops call for it."""
    spark.sparkContext._jvm.System.gc()


def crc32_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as remainder of the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def id_prefilter(df: DataFrame, id_col: str, wanted: DataFrame, bits: int = 24) -> DataFrame:
    """Drop most rows whose id is not in ``wanted`` before an exact join shuffles them.

    The wanted ids are hashed into a bitmap of 2**bits bits, at most
    2**(bits - 6) rows of 64 bits: a broadcast of fixed size whatever the
    input. It may pass extra rows (all of them once it is full) and never
    drops a wanted one.
    """
    marked, bitmap = _bitmap(df, id_col, wanted, bits)
    return marked.join(F.broadcast(bitmap), "_word").filter(_HIT).select(*df.columns)


def id_outside(df: DataFrame, id_col: str, others: DataFrame, bits: int = 24) -> DataFrame:
    """The rows that ``id_prefilter`` would drop: all have ids that are not in ``others``."""
    marked, bitmap = _bitmap(df, id_col, others, bits)
    return marked.join(F.broadcast(bitmap), "_word", "left").filter(f"_bits is null or not ({_HIT})").select(*df.columns)


_HIT = "(shiftrightunsigned(_bits, cast(_slot & 63 as int)) & 1) = 1"


def _bitmap(df: DataFrame, id_col: str, ids: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """``df`` with each row's slot, and the bitmap of ``ids``."""
    slot = F.xxhash64(F.col(id_col)).bitwiseAND(F.lit((1 << bits) - 1))
    bitmap = (
        ids.select(slot.alias("_slot"))
        .groupBy(F.shiftright("_slot", 6).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 as int))")).alias("_bits"))
    )
    return df.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6)), bitmap


#: Slots of an array that travel as one row.
CHUNK = 1 << 16


def array_chunks(counts: np.ndarray, together: int = 64) -> Iterator[pa.RecordBatch]:
    """(chunk, slots, counts) rows of an array: what is not zero of each chunk; a chunk that is mostly filled goes whole, slots null."""
    names = ["chunk", "slots", "counts"]
    for group in range(0, len(counts), CHUNK * together):
        chunks, slots, values = [], [], []
        for at in range(group, min(len(counts), group + CHUNK * together), CHUNK):
            part = counts[at : at + CHUNK]
            some = np.flatnonzero(part)
            if not len(some):
                continue
            whole = len(some) * (2 + counts.itemsize) >= len(part) * counts.itemsize
            chunks.append(at)
            slots.append(None if whole else some.astype(np.uint16).tobytes())
            values.append((part if whole else part[some]).tobytes())
        if chunks:
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(slots, pa.binary()), pa.array(values, pa.binary())], names=names)


CHUNKS = "chunk int, slots binary, counts binary"


def _add_chunks(kind: str, total_kind: str):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        most = np.iinfo(total_kind).max
        for batch in batches:
            for chunk, slots, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = sums.setdefault(chunk, np.zeros(CHUNK, total_kind))
                n = np.frombuffer(counts, kind)
                at = np.arange(len(n)) if slots is None else np.frombuffer(slots, np.uint16)
                total[at] += np.minimum(n, most - total[at]).astype(total_kind)  # stops at the largest number
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums, pa.int32()), pa.nulls(len(sums), pa.binary()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                names=["chunk", "slots", "counts"],
            )

    return add


def summed_array(rows: DataFrame, size: int, kind: str, total_kind: str) -> np.ndarray:
    """The sum of arrays of ``size`` that travel as ``array_chunks``, of fixed size on the driver.

    Each chunk is added up in one task, row by row as rows come.
    """
    out = np.zeros(max(size, CHUNK), total_kind)
    for r in rows.repartition("chunk").mapInArrow(_add_chunks(kind, total_kind), CHUNKS).collect():
        out[r["chunk"] : r["chunk"] + CHUNK] = np.frombuffer(r["counts"], total_kind)
    return out[:size]


def document_key(id_col: Column, text: Column) -> Column:
    """25 bytes that sort as documents do: by id, null ids last, then by digest of the text."""
    number = F.unhex(F.lpad(F.hex(F.coalesce(id_col, F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    null = F.when(id_col.isNull(), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    return F.concat(null, number, F.unhex(F.md5(text.cast("binary"))))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    base = int(offsets[0]) if len(offsets) else 0
    end = int(offsets[-1]) if len(offsets) else 0
    raw = np.frombuffer(data, dtype=np.uint8)[base:end] if data is not None and end > base else np.empty(0, np.uint8)
    return raw, offsets - base


def doc_slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``size`` bytes each; a longer document is alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (plus the total)."""
    inside = ~SPACE[raw]
    n = len(raw)
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < n)]
    start[cut] = inside[cut]
    stop[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = np.empty(0, np.uint64)


def _factors(n: int) -> np.ndarray:
    """A fixed random odd-or-even factor for each place of a word's letters."""
    global _FACTORS
    if len(_FACTORS) < n:
        _FACTORS = mix64(np.arange(1, max(n, 4096) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _FACTORS[:n]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased.

    Multilinear: every place has a factor of its own, so no pattern of letters
    (as with powers of one base) makes long words alike.
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    ahead = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(ahead, sizes)
    letters = LOWER[raw[place + np.repeat(starts, sizes)]] * _factors(int(sizes.max()))[place]
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(letters, out=sums[1:], dtype=np.uint64)
    return mix64(sums[ahead + sizes] - sums[ahead] + sizes.astype(np.uint64))
