"""Token-id output: flat unsigned integer files with 64-bit document offsets.

A store is a folder on the shared file system:

    part-00000.bin   ids of the part's documents in a row, little-endian, 16
                     bits if the vocabulary fits, else 32
    part-00000.idx   int64 pairs (doc_id, ids of the part before it), one for
                     each document, then (0, ids of the part)

Parts follow ascending doc_id (Spark's range partitioning); a part's base, the
number of ids in all parts before it, comes from the prefix sums of the part
totals. A task writes to a name of its attempt and renames it, so a part that
is written again by another executor is replaced by the same bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmill.llm.common import bounded_batches, write_scratch
from hourmill.llm.word_encoder import encoder

NULL_ID = np.iinfo(np.int64).min


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder's URI or path, and the path in it."""
    if ":" not in uri.split("/", 1)[0]:
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class TokenStore:
    path: str
    dtype: str
    bases: tuple[int, ...]  # ids before each part, then the total


def _names(folder: str, part: int) -> tuple[str, str]:
    return f"{folder}/part-{part:05d}.bin", f"{folder}/part-{part:05d}.idx"


def _writer(uri: str, tokenizer: str, end: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        fs, folder = open_folder(uri)
        fs.create_dir(folder, recursive=True)
        data, index = _names(folder, part)
        encode = encoder(tokenizer)
        total, rows = 0, 0
        with fs.open_output_stream(f"{data}.{attempt}") as ids_out, fs.open_output_stream(f"{index}.{attempt}") as index_out:
            for batch in batches:
                ids, counts = encode.encode(batch.column(1).to_pylist(), end=end)
                ids_out.write(ids.astype(encode.dtype).tobytes())
                doc_ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                before = total + np.cumsum(counts) - counts
                index_out.write(np.stack([doc_ids, before], axis=1).astype("<i8").tobytes())
                total += int(counts.sum())
                rows += batch.num_rows
            index_out.write(np.array([0, total], dtype="<i8").tobytes())
        fs.move(f"{data}.{attempt}", data)
        fs.move(f"{index}.{attempt}", index)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total], pa.int64())], names=["part", "total"])

    return write


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 16 << 20
) -> TokenStore:
    """Encode every text, append ``end``, and write a store in ascending doc_id order.

    Rows of one id lie side by side, in the order of a hash of their texts.
    Null ids come first, null texts are empty, other columns are ignored. An
    empty table gives a store of no ids.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(size) // part_bytes))
    tie = F.xxhash64("text")
    ordered = narrow.withColumn("tie", tie).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    written = write_scratch(
        ordered.select("doc_id", "text").mapInArrow(_writer(path, tokenizer, end), "part int, total long"), "token-parts"
    )
    # One row for each part.
    totals = {r["part"]: r["total"] for r in written.collect()}
    bases = np.concatenate([[0], np.cumsum([totals.get(i, 0) for i in range(max(totals, default=-1) + 1)])]).astype(int)
    return TokenStore(path, encoder(tokenizer).dtype.str, tuple(bases.tolist()))


def _mapped(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """Memory-mapped where the file system is local, read whole (one part) where not."""
    if fs.get_file_info(path).size == 0:
        return np.empty(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def read_tokens(spark: SparkSession, store: TokenStore) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read from the files."""
    uri, dtype, bases = store.path, store.dtype, np.array(store.bases, dtype=np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(uri)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                data, index = _names(folder, part)
                if bases[part] == bases[part + 1]:
                    continue
                ids, pairs = _mapped(fs, data, dtype), _mapped(fs, index, "<i8").reshape(-1, 2)
                for lo in range(0, len(pairs) - 1, 4096):
                    own = pairs[lo : lo + 4097]
                    cuts = own[:, 1]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    n = len(crc)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own[:n, 0], pa.int64(), mask=own[:n, 0] == NULL_ID),
                            pa.array(bases[part] + cuts[:n]),
                            pa.array(np.diff(cuts)),
                            pa.array(crc, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = len(bases) - 1
    rows = spark.range(0, parts, 1, max(1, parts))
    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
