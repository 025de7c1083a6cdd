"""Hard negatives by a vertical scan of columnar vector blocks, with branch and bound.

Components are whole numbers floor(256 x). Vectors of one label are packed in
blocks, dimension by dimension (a column of a block lies together). An anchor
reads the columns of a block in the order of its own component magnitudes,
largest first. After each few columns every row still in the candidate bitmap
has a score so far; the smallest and largest value of each unread column, times
the anchor's component, bound what the rest can add. Rows whose bounds cannot
reach the asked window, or the k-th best score inside it, leave the bitmap;
whoever is left after the last column has its exact score.

Two scans: positives (blocks of the anchor's label, the best 5), then, with the
positives' scores known, negatives (blocks of other labels, the best 10 of each
positive's score window). Anchors travel in groups to the blocks by a join on
block numbers; each block answers with at most k rows for each window, and a
rank over the blocks' answers decides. Anchors are a stated set, one in
``anchor_step`` rows, held against all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmill.llm.common import bounded_batches, write_scratch


@dataclass(frozen=True)
class NegativeSpec:
    anchor_step: int = 100  # anchors: ids divisible by this
    relabel_step: int = 7  # ids divisible by this get label (label + 1) % labels
    labels: int = 10
    positives: int = 5
    negatives: int = 10
    least: int = 30  # percent of the positive's score
    most: int = 90
    block_rows: int = 8192
    group_rows: int = 256  # anchors that travel together
    columns: int = 8  # read between two looks at the bitmap


def _clean(vectors: DataFrame, spec: NegativeSpec, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label, tie, vec: rows that take part, components as whole numbers, repeated rows once."""
    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    raw = raw.filter("vec_id is not null and label is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    label = F.expr(f"case when vec_id % {spec.relabel_step} = 0 then pmod(label + 1, {spec.labels}) else label end")
    # No score may pass 2**63 / 100: |a . b| is at most the larger of the rows' size * max**2.
    big = F.expr("size(v) * power(256 * array_max(transform(v, x -> abs(x))) + 1, 2) > 9e16")
    vec = F.when(big, F.raise_error(F.lit("components too large: 100 scores would not fit 64 bits"))).otherwise(F.transform("v", lambda x: F.floor(x * 256)))
    return raw.select("vec_id", label.alias("label"), vec.cast("array<long>").alias("vec")).distinct().withColumn("tie", F.xxhash64("vec"))


def _packer(*columns: str):
    """Rows of one (label, blk) to one row: ids, ties and a matrix of the vectors, one dimension after the other."""
    import pandas as pd

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for width, part in pdf.groupby(pdf["vec"].map(len), sort=True):  # vectors of other lengths have no inner product
            part = part.sort_values(["vec_id", "tie"])
            matrix = np.array(part["vec"].tolist(), dtype=np.int32).reshape(len(part), width)
            extra = [part[c].to_numpy(np.int64) if c in ("vec_id", "tie") else np.concatenate([*part[c]]).astype(np.int64) for c in columns]
            out.append((part["label"].iloc[0], part["blk"].iloc[0], width, *[e.tobytes() for e in extra], np.ascontiguousarray(matrix.T).tobytes()))
        return pd.DataFrame(out, columns=["label", "blk", "width", *columns, "vecs"])

    return pack


def _blocks(rows: DataFrame, size: int, columns: tuple[str, ...] = ("vec_id", "tie")) -> DataFrame:
    """Rows packed by label in blocks of about ``size``; a label of many rows is many blocks."""
    counts = rows.groupBy("label").agg(F.count("*").alias("n"))
    blk = F.expr(f"pmod(xxhash64(vec_id, tie), cast(ceil(n / {size}) as long))")
    dealt = rows.join(counts, "label").withColumn("blk", blk).drop("n")
    schema = "label long, blk long, width int, " + ", ".join(f"{c} binary" for c in columns) + ", vecs binary"
    return dealt.groupBy("label", "blk").applyInPandas(_packer(*columns), schema)


def scan(
    anchor: np.ndarray, block: np.ndarray, ends: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int, step: int
) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of ``block`` (dimensions x rows) among the k best scores in each window [low, high].

    ``ends`` holds the smallest and the largest value of each dimension. Returns
    for each window the positions, ascending, of its k best rows and of those
    tied with the last, and all rows' scores (right for the positions returned).
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    adds = np.sort(a * ends[:, order], axis=0)  # least and most that each dimension adds
    can_add = np.zeros((2, len(a) + 1), dtype=block.dtype)
    can_add[:, :-1] = adds[:, ::-1].cumsum(axis=1)[:, ::-1]
    alive = np.arange(block.shape[1])
    score = np.zeros(block.shape[1], dtype=block.dtype)
    for at in range(0, len(a), step):
        read = order[at : at + step]
        score[alive] += a[at : at + step] @ (block[read] if len(alive) == block.shape[1] else block[np.ix_(read, alive)])
        after = min(at + step, len(a))
        lo, hi = score[alive] + can_add[0, after], score[alive] + can_add[1, after]
        stay = np.zeros(len(alive), dtype=bool)
        for low, high in zip(lows, highs, strict=True):
            within = (hi >= low) & (lo <= high)
            sure = lo[(lo >= low) & (hi <= high)]
            if len(sure) > k:
                within &= hi >= np.partition(sure, len(sure) - k)[len(sure) - k]
            stay |= within
        alive = alive[stay]
        if not len(alive):
            break
    out = []
    for low, high in zip(lows, highs, strict=True):
        s = score[alive]
        mine = alive[(s >= low) & (s <= high)]
        if len(mine) > k:
            mine = mine[score[mine] >= np.partition(score[mine], len(mine) - k)[len(mine) - k]]
        out.append(mine)
    return out, score


def _ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


FOUND = "anchor_id long, anchor_tie long, slot int, vec_id long, tie long, score long"
FULL = 1 << 60


def _searcher(spec: NegativeSpec, k: int, windows: bool):
    """(a_id, a_tie, a_vecs, [lows, highs], width, vec_id, tie, vecs) to FOUND: every anchor of a group in one block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, ties = _ids(row["vec_id"]), _ids(row["tie"])
                a_ids, a_ties = _ids(row["a_id"]), _ids(row["a_tie"])
                width = row["width"]
                block = np.frombuffer(row["vecs"], np.int32).reshape(width, len(ids))
                anchors = np.frombuffer(row["a_vecs"], np.int32).reshape(width, len(a_ids))
                # Doubles add whole numbers exactly up to 2**53, and faster than longs.
                exact = width * float(np.abs(block).max(initial=0)) * float(np.abs(anchors).max(initial=0)) < 1 << 53
                block, anchors = (block.astype(float), anchors.astype(float)) if exact else (block.astype(np.int64), anchors.astype(np.int64))
                ends = np.stack([block.min(axis=1), block.max(axis=1)])
                n = spec.positives if windows else 1
                lows = _ids(row["lows"]).reshape(-1, n) if windows else np.full((len(a_ids), 1), -FULL)
                highs = _ids(row["highs"]).reshape(-1, n) if windows else np.full((len(a_ids), 1), FULL)
                out: list[list[np.ndarray]] = [[] for _ in range(6)]
                for i in range(len(a_ids)):
                    asked = np.flatnonzero(lows[i] <= highs[i])
                    # One more than k in the anchor's own label: the anchor itself is among them.
                    best, score = scan(anchors[:, i], block, ends, lows[i][asked], highs[i][asked], k + (not windows), spec.columns)
                    for slot, mine in zip(asked.tolist(), best, strict=True):
                        mine = mine[(ids[mine] != a_ids[i]) | (ties[mine] != a_ties[i])]
                        # Blocks are in the order of (vec_id, tie), so a stable sort settles ties.
                        mine = mine[np.argsort(-score[mine], kind="stable")][:k]
                        for column, x in zip(out, (a_ids[i], a_ties[i], slot, ids[mine], ties[mine], score[mine].astype(np.int64)), strict=True):
                            column.append(np.broadcast_to(x, len(mine)))
                flat = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(flat, kinds, strict=True)], names=["anchor_id", "anchor_tie", "slot", "vec_id", "tie", "score"]
                )

    return search


def _held_against(groups: DataFrame, blocks: DataFrame, same_label: bool, spec: NegativeSpec, k: int, windows: bool) -> DataFrame:
    """FOUND for every anchor group and every block of the same (or of another) label.

    Pairs of (group, block) names are few; the groups' and blocks' contents join
    on their names, so no side is broadcast and a task holds one of each.
    """
    lanes = max(1, blocks.count() // 64)  # names of blocks meet those of groups in as many places
    a = groups.select(F.col("label").alias("a_label"), F.col("blk").alias("a_blk"), "width", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    b = blocks.select("label", "blk", "width", F.expr(f"cast(pmod(xxhash64(label, blk), {lanes}) as int)").alias("lane"))
    pairs = a.join(b, ["width", "lane"]).filter("a_label = label" if same_label else "a_label <> label").drop("lane")
    # Each block meets all its groups in one task and each group is read once per block.
    held = groups.select(F.col("label").alias("a_label"), F.col("blk").alias("a_blk"), "width", F.col("vec_id").alias("a_id"), F.col("tie").alias("a_tie"),
                         F.col("vecs").alias("a_vecs"), *[c for c in ("lows", "highs") if windows])
    met = pairs.join(held, ["a_label", "a_blk", "width"]).join(blocks, ["label", "blk", "width"])
    return met.drop("a_label", "a_blk", "label", "blk").mapInArrow(_searcher(spec, k, windows), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "anchor_tie", "slot").orderBy(F.desc("score"), "vec_id", "tie")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, spec: NegativeSpec | None = None, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component take
    no part; a component of 2**22 or more raises an error. Rows repeated with id,
    label and vector count once. Different rows of one id are different rows:
    equal scores and ids are settled by a hash of the vector. Vectors of another
    length than the anchor's (empty ones too) are not compared with it. A window
    that holds no row (a positive of negative score has none) gives no rows.
    Other columns are ignored, whatever their names. An empty table gives none.
    """
    spec = spec or NegativeSpec()
    bounded_batches(vectors.sparkSession)
    rows = write_scratch(_clean(vectors, spec, id_col, vec_col, label_col).filter("size(vec) > 0"), "negatives-rows")
    blocks = write_scratch(_blocks(rows, spec.block_rows), "negatives-blocks")
    anchors = rows.filter(F.col("vec_id") % spec.anchor_step == 0)
    groups = write_scratch(_blocks(anchors, spec.group_rows), "negatives-anchors")
    positives = write_scratch(_best(_held_against(groups, blocks, True, spec, spec.positives, False), spec.positives), "positives")

    # The window of each positive's score: least * p <= 100 * s <= most * p; slots without a positive ask for nothing.
    slots = F.array(*[F.coalesce(F.max(F.when(F.col("rank") == i + 1, F.col("score"))), F.lit(-1)) for i in range(spec.positives)])
    scored = positives.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_tie").alias("tie")).agg(slots.alias("p"))
    windowed = anchors.join(scored, ["vec_id", "tie"]).select(
        "vec_id", "tie", "label", "vec",
        F.expr(f"transform(p, x -> case when x < 0 then 1L else (x * {spec.least} + 99) div 100 end)").alias("lows"),
        F.expr(f"transform(p, x -> case when x < 0 then 0L else (x * {spec.most}) div 100 end)").alias("highs"),
    )
    asking = write_scratch(_blocks(windowed, spec.group_rows, ("vec_id", "tie", "lows", "highs")), "negatives-windows")
    found = _best(_held_against(asking, blocks, False, spec, spec.negatives, True), spec.negatives)
    p = positives.select("anchor_id", "anchor_tie", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(p, ["anchor_id", "anchor_tie", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
