"""Substring dedup by seed and extend: repeats of 20 words or more across and inside documents.

1. Every document is winnowed: of the 8-word seeds in each 20-word window the
   one of the least hash is an anchor. Equal windows choose the same anchor at
   the same place, so every repeat of 20 words shares one.
2. Anchors are joined on their hash with the earliest place of that hash, its
   hub: (document, place) pairs a diagonal apart, never all pairs of a group.
3. The hub's words around its anchors are shipped in blocks to the documents
   that named them; each diagonal is extended both ways word by word, across
   blocks, and its maximal runs of 20 words or more are repeats. Words are
   compared, not hashes, so a collision of anchors costs time only.
4. Windows whose anchor has an earlier hub with other words around it (two
   passages that share eight words only) are joined once more on the digest of
   their 20 words. The earliest window of equal ones is always among them: had
   it matched the hub, all of them would have.

What one task holds is bounded by single documents: the blocks a document gets
are at most two for each of its anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmill.llm.common import SPACE, bounded_batches, doc_slices, document_key, id_prefilter, mix64, text_buffer, word_hashes, word_spans, write_scratch


@dataclass(frozen=True)
class RepeatSpec:
    length: int = 20  # words of a repeat
    seed: int = 8  # words of a seed; seeds in one window: length - seed + 1, at most 64
    block: int = 64  # words shipped together

    def __post_init__(self):
        if not 1 <= self.seed <= self.length <= self.seed + 63:
            raise ValueError("a window must hold 1 to 64 seeds")


def winnow(raw: np.ndarray, offsets: np.ndarray, spec: RepeatSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each row, window starts, anchor of each window, hash of each seed); places count over all rows."""
    starts, ends, first = word_spans(raw, offsets)
    words = word_hashes(raw, starts, ends)
    m = len(words) - spec.length + 1
    if m < 1:
        return first, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    weights = mix64(np.arange(1, spec.seed + 1, dtype=np.uint64) * np.uint64(0x9E6C63D0676A9A99)) | np.uint64(1)
    n = len(words) - spec.seed + 1
    rolled = np.zeros(n, dtype=np.uint64)
    for j in range(spec.seed):
        rolled += words[j : j + n] * weights[j]
    rolled = mix64(rolled)
    high = rolled & ~np.uint64(63)  # the low six bits give way to the place: the leftmost of equal seeds wins
    least = high[:m].copy()
    for o in range(1, spec.length - spec.seed + 1):
        np.minimum(least, high[o : o + m] | np.uint64(o), out=least)
    at = np.arange(m, dtype=np.int64)
    end = np.repeat(first[1:], np.diff(first))[:m]  # where the row of each word ends
    at = at[at + spec.length <= end]
    return first, at, at + (least[at] & np.uint64(63)).astype(np.int64), rolled


def _kept(words: list[bytes], cover: list[tuple[int, int]]) -> tuple[int, str]:
    """(words removed, sha256 of the others) for disjoint ascending spans."""
    kept, at = [], 0
    for a, b in cover:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


ANCHORS = "key binary, doc_id long, n_words long, kept_sha256 string, hs array<long>, ps array<int>"


def _anchorer(spec: RepeatSpec):
    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw_all, offsets_all = text_buffer(batch.column(2))
            counts, shas, sizes, hashes, places = [], [], [], [], []
            for a, b in doc_slices(offsets_all):
                raw = raw_all[offsets_all[a] : offsets_all[b]]
                offsets = offsets_all[a : b + 1] - offsets_all[a]
                first, _, anchors, rolled = winnow(raw, offsets, spec)
                anchors = anchors[np.r_[True, anchors[1:] != anchors[:-1]]] if len(anchors) else anchors
                owner = np.searchsorted(first, anchors, side="right") - 1
                counts.append(np.diff(first))
                sizes.append(np.bincount(owner, minlength=b - a))
                hashes.append(rolled[anchors].view(np.int64) if len(anchors) else np.empty(0, np.int64))
                places.append(anchors - first[owner])
                data = raw.tobytes()
                shas += [hashlib.sha256(b" ".join(data[x:y].split())).hexdigest() for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            if not shas:
                continue
            ends = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(np.concatenate(counts), pa.int64()), pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(hashes), pa.int64())),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(places), pa.int32())),
                ],
                names=["key", "doc_id", "n_words", "kept_sha256", "hs", "ps"],
            )

    return anchor


def _block_cutter(spec: RepeatSpec):
    """(key, text, js) to (hkey, j, words): the blocks asked for that the document has."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, int, bytes]] = []
            for key, text, js in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode().split()
                out += [(key, j, b" ".join(words[j * spec.block : (j + 1) * spec.block])) for j in js if j * spec.block < len(words)]
            if out:
                keys, js, words = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(js, pa.int32()), pa.array(words, pa.binary()).cast(pa.string())], names=["hkey", "j", "words"]
                )

    return cut


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, and for each text the index of its first word (plus the total)."""
    starts, ends, first = word_spans(raw, offsets)
    sizes = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    letters = raw[~SPACE[raw]]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(letters)]), first


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. (sizes[0] of them), starts[1], .."""
    ahead = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(starts - ahead, sizes)


def equal_runs(ours: np.ndarray, theirs: np.ndarray, at: np.ndarray, there: np.ndarray, sizes: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) in ``ours`` of words equal to those of ``theirs``.

    Piece i holds sizes[i] words from at[i] and there[i] on; pieces of one line
    (one diagonal of one document) stand in order, and a run goes on from one
    to the next if they touch.
    """
    places = _spread(at, sizes)
    same = np.flatnonzero(ours[places] == theirs[_spread(there, sizes)])
    places, lines = places[same], np.repeat(line, sizes)[same]
    if not len(places):
        return places, places
    breaks = np.flatnonzero((places[1:] != places[:-1] + 1) | (lines[1:] != lines[:-1]))
    return places[np.r_[0, breaks + 1]], places[np.r_[breaks, len(places) - 1]] + 1


RUNS = "key binary, n_removed long, kept_sha256 string, cover array<struct<a:int,b:int>>, rest array<struct<digest:binary,s:int>>"


def _extender(spec: RepeatSpec):
    """(key, text, got) to RUNS: the repeats that extend seeds, and windows whose hub has other words."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = batch.column(2)
            shipped = np.r_[0, np.cumsum(pc.list_value_length(got).to_numpy(zero_copy_only=False))]
            _, texts_at = text_buffer(batch.column(1))
            _, blocks_at = text_buffer(pc.struct_field(pc.list_flatten(got), "words"))
            for a, b in doc_slices(texts_at + blocks_at[shipped], EXTEND_BYTES):
                yield _extended(batch.slice(a, b - a), spec)

    return extend


#: Texts and blocks compared at once.
EXTEND_BYTES = 4 << 20


def _extended(batch: pa.RecordBatch, spec: RepeatSpec) -> pa.RecordBatch:
    raw, offsets = text_buffer(batch.column(1))
    own, first = _words(raw, offsets)
    got = pc.list_flatten(batch.column(2))
    counts = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(counts)), counts)
    hub = pc.struct_field(got, "hkey").dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    diag = np.asarray(pc.struct_field(got, "diag"), dtype=np.int64)
    j = np.asarray(pc.struct_field(got, "j"), dtype=np.int64)
    theirs, block_first = _words(*text_buffer(pc.struct_field(got, "words")))
    codes = pa.concat_arrays([own, theirs]).dictionary_encode().indices.to_numpy(zero_copy_only=False)

    # Pieces in the order of their diagonals, without what lies outside the document.
    order = np.lexsort((j, diag, hub, doc))
    at = (j * spec.block + diag)[order]
    sizes = np.diff(block_first)[order]
    cut = np.maximum(0, -at)
    sizes = np.minimum(sizes, np.diff(first)[doc[order]] - at) - cut
    line = np.r_[0, np.cumsum((np.diff(doc[order]) != 0) | (np.diff(hub[order]) != 0) | (np.diff(diag[order]) != 0))] if len(order) else order
    some = sizes > 0
    starts, ends = equal_runs(
        codes[: len(own)], codes[len(own) :], (first[doc[order]] + at + cut)[some], (block_first[:-1][order] + cut)[some], sizes[some], line[some]
    )
    long = ends - starts >= spec.length
    starts, ends = starts[long], ends[long]

    # Windows within a repeat are known; of the others those whose anchor is a seed are left to compare.
    _, windows, anchors, _ = winnow(raw, offsets, spec)
    seeds = pc.struct_field(got, "ps")
    seeded = np.zeros(len(own) + 1, dtype=bool)
    seeded[np.repeat(first[doc], pc.list_value_length(seeds).to_numpy(zero_copy_only=False)) + np.asarray(pc.list_flatten(seeds), dtype=np.int64)] = True
    turns = np.zeros(len(own) + 2, dtype=np.int64)
    np.add.at(turns, starts, 1)
    np.add.at(turns, ends - spec.length + 1, -1)
    known = np.cumsum(turns) > 0
    rest = windows[seeded[anchors] & ~known[windows]]

    data, out = raw.tobytes(), []
    by_doc, rest_of = np.searchsorted(first, starts, side="right") - 1, np.searchsorted(rest, first)
    in_order = np.argsort(by_doc, kind="stable")
    span_of = np.searchsorted(by_doc[in_order], np.arange(len(counts) + 1))
    for d, key in enumerate(batch.column(0).to_pylist()):
        words = data[offsets[d] : offsets[d + 1]].split()
        mine = in_order[span_of[d] : span_of[d + 1]]
        cover = _merged_spans(list(zip((starts[mine] - first[d]).tolist(), (ends[mine] - first[d]).tolist(), strict=True)))
        left = (rest[rest_of[d] : rest_of[d + 1]] - first[d]).tolist()
        digests = [hashlib.blake2b(b" ".join(words[s : s + spec.length]), digest_size=16).digest() for s in left]
        out.append((key, *_kept(words, cover), [{"a": a, "b": b} for a, b in cover], [{"digest": x, "s": s} for x, s in zip(digests, left, strict=True)]))
    key, removed, sha, cover, left = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key, pa.binary()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
            pa.array(cover, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
            pa.array(left, pa.list_(pa.struct([("digest", pa.binary()), ("s", pa.int32())]))),
        ],
        names=["key", "n_removed", "kept_sha256", "cover", "rest"],
    )


def _finisher(spec: RepeatSpec):
    """(key, text, cover, more) to (key, n_removed, kept_sha256) with the windows that step 4 adds."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, cover, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = [(c["a"], c["b"]) for c in cover] + [(s, s + spec.length) for s in more]
                out.append((key, *_kept(text.encode().split(), _merged_spans(spans))))
            if out:
                key, removed, sha = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.binary()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], names=["key", "n_removed", "kept_sha256"]
                )

    return finish


def remove_repeats(docs: DataFrame, spec: RepeatSpec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A window is ``spec.length`` consecutive words of one document; each word of
    a window that also starts earlier (smaller id, or earlier in the same
    document) is removed. Null and empty texts have no words; shorter texts than
    a window no window. Rows with a null id come after all others. An id
    repeated with different texts is as many documents, in the order of their
    text's digest; rows repeated with id and text are one document, each with
    its result. Other columns are ignored, whatever their names. An empty table
    gives an empty result.
    """
    spec = spec or RepeatSpec()
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = narrow.select(document_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text")
    signed = write_scratch(texts.mapInArrow(_anchorer(spec), ANCHORS), "repeat-anchors")

    # Places whose anchor occurs again, each with the earliest place of that anchor.
    places = signed.select("key", F.explode(F.arrays_zip("hs", "ps")).alias("x")).select(F.col("x.hs").alias("h"), "key", F.col("x.ps").alias("p"))
    again = write_scratch(places.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "repeat-again")
    places = id_prefilter(places, "h", again)
    # Written, as the blocks are, so that their joins see plain shuffles, of which Spark can split a hot anchor's.
    hubs = write_scratch(places.groupBy("h").agg(F.min(F.struct("key", "p")).alias("hub")), "repeat-hubs")
    seeds = places.join(hubs, "h").filter("not (key = hub.key and p = hub.p)").select(
        "key", "p", F.col("hub.key").alias("hkey"), F.col("hub.p").alias("hp"), (F.col("p") - F.col("hub.p")).alias("diag")
    )
    reach = spec.length - spec.seed
    j = F.explode(F.expr(f"sequence(cast(greatest(hp - {reach}, 0) div {spec.block} as int), cast((hp + {spec.length - 1}) div {spec.block} as int))"))
    pieces = (
        seeds.select("key", "hkey", "diag", "p", "hp", j.alias("j"))
        .groupBy("key", "hkey", "diag", "j")
        .agg(F.collect_set(F.expr(f"case when cast(hp div {spec.block} as int) = j then p end")).alias("ps"))
    )
    pieces = write_scratch(pieces, "repeat-pieces")

    # Blocks of the hubs' words, one of each however many documents name it.
    asked = pieces.groupBy("hkey").agg(F.collect_set("j").alias("js"))
    found = id_prefilter(texts.select("key", "text"), "key", asked.select(F.col("hkey").alias("key")))
    found = found.join(asked.withColumnRenamed("hkey", "key"), "key").select("key", "text", "js")
    blocks = found.mapInArrow(_block_cutter(spec), "hkey binary, j int, words string").groupBy("hkey", "j").agg(F.min("words").alias("words"))
    blocks = write_scratch(blocks, "repeat-blocks")
    shipped = pieces.join(blocks, ["hkey", "j"])
    got = shipped.groupBy("key").agg(F.collect_list(F.struct("hkey", "diag", "j", "ps", "words")).alias("got"))
    wanted = id_prefilter(texts.select("key", "text"), "key", pieces.select("key"))
    runs = wanted.join(got, "key").select("key", "text", "got").mapInArrow(_extender(spec), RUNS)
    runs = write_scratch(runs, "repeat-runs")

    # Windows whose hub has other words: equal ones among themselves.
    rest = runs.select("key", F.explode("rest").alias("r")).select(F.col("r.digest").alias("digest"), "key", F.col("r.s").alias("s"))
    heads = rest.groupBy("digest").agg(F.min(F.struct("key", "s")).alias("head"), F.max(F.struct("key", "s")).alias("_last")).filter("head <> _last")
    later = rest.join(heads.select("digest", "head"), "digest").filter("not (key = head.key and s = head.s)")
    more = write_scratch(later.groupBy("key").agg(F.collect_set("s").alias("more")), "repeat-more")
    one = runs.groupBy("key").agg(F.first("n_removed").alias("n_removed"), F.first("kept_sha256").alias("sha"), F.first("cover").alias("cover"))
    held = id_prefilter(texts.select("key", "text"), "key", more.select("key"))
    mended = held.join(more, "key").join(one.select("key", "cover"), "key").select("key", "text", "cover", "more")
    mended = mended.mapInArrow(_finisher(spec), "key binary, n_removed long, kept_sha256 string")
    mended = mended.groupBy("key").agg(F.first("n_removed").alias("n2"), F.first("kept_sha256").alias("sha2"))
    changed = one.select("key", "n_removed", "sha").join(mended, "key", "left")
    changed = changed.select("key", F.coalesce("n2", "n_removed").alias("n_removed"), F.coalesce("sha2", "sha").alias("sha"))
    out = signed.select("key", "doc_id", "n_words", "kept_sha256").join(changed, "key", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("sha", "kept_sha256").alias("kept_sha256"))
