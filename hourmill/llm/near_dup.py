"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts gives each document's number of distinct 5-word
   shingles, a digest of its words, 200 minima as 40 band keys of 5 minima, and
   the low 4 bits of each minimum packed into 13 longs.
2. Documents with equal digests are one class, numbered in the order of the
   smallest id and text in it; only that one goes on. Every text of an id that
   has several is a document here; an id joins its texts' components at the end.
3. Classes meet in band buckets. Each is paired with the smallest class of
   each of its buckets. A pair goes on if the similarity that XOR and bit
   counts of the packed minima estimate, corrected for chance collisions of
   4-bit values (1/16), and the set sizes allow the threshold.
4. Pairs that go on are verified on the full shingle sets, nearest first, and
   links joined into components; pairs inside a component need no test. A pair
   that links by its shingles' hashes is confirmed on their bytes.
5. Members of one bucket that are still in different components are then
   compared the same way, so no link of a bucket is lost, while a large group
   of near copies, joined by step 4, is never expanded into all its pairs.

Figures: a pair at the threshold of 0.75 shares none of the 40 bands with
probability (1 - 0.75**5)**40 = 2e-5. The estimate has a standard deviation of
0.033 there; the filter at 0.55 lies six of them below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmill.llm.common import (
    bounded_batches,
    doc_slices,
    document_key,
    id_prefilter,
    mix64,
    text_buffer,
    word_hashes,
    word_spans,
    write_scratch,
)
from hourmill.llm.components import connected_components


@dataclass(frozen=True)
class MinHashSpec:
    shingle: int = 5
    percent: int = 75  # link when 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 5
    least_estimate: float = 0.55
    rounds: int = 2  # of testing only each document's nearest candidate
    block: int = 64  # members verified against one hub in one group

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    @property
    def words64(self) -> int:
        return -(-self.hashes // 16)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row's text, in row order.

    A text of fewer than k words is one shingle of all its words; a null text
    or one without words has none.
    """
    raw_all, offsets_all = text_buffer(column)
    weights = mix64(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    for a, b in doc_slices(offsets_all):
        raw = raw_all[offsets_all[a] : offsets_all[b]]
        offsets = offsets_all[a : b + 1] - offsets_all[a]
        starts, ends, first = word_spans(raw, offsets)
        words = word_hashes(raw, starts, ends)
        n = len(words) - k + 1
        rolled = np.full(max(n, 0), k, dtype=np.uint64)
        for j in range(k):
            if n > 0:
                rolled += words[j : j + n] * weights[j]
        rolled = mix64(rolled)
        for d in range(b - a):
            lo, hi = first[d], first[d + 1]
            if hi - lo >= k:
                yield np.unique(rolled[lo : hi - k + 1])
            elif hi > lo:
                yield mix64(np.array([(words[lo:hi] * weights[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)]))
            else:
                yield np.empty(0, np.uint64)


def _minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[i : i + 1024, None] * a + b).min(axis=0), out=least)
    return least


#: Bits of the parity sketch: bit h mod ODD_BITS is turned by each shingle hash h.
ODD_BITS = 1024


def _parity(shingles: np.ndarray) -> np.ndarray:
    bits = np.bincount((shingles & np.uint64(ODD_BITS - 1)).astype(np.int64), minlength=ODD_BITS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _words_digest(text: str) -> bytes:
    """Of the words with A-Z lower-cased: equal ones have equal shingle sets."""
    return hashlib.blake2b(b" ".join(text.encode().lower().split()), digest_size=16).digest()


def byte_shingles(text: str, k: int) -> frozenset[bytes]:
    """The distinct shingles themselves."""
    words = text.encode().lower().split()
    if 0 < len(words) < k:
        return frozenset([b" ".join(words)])
    return frozenset(b" ".join(words[i : i + k]) for i in range(len(words) - k + 1))


def _signer(spec: MinHashSpec):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix64(np.arange(1, 2 * spec.hashes + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
        a, b = seeds[: spec.hashes] | np.uint64(1), seeds[spec.hashes :]
        salt = mix64(np.arange(7, 7 + spec.bands, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
        turn = mix64(np.arange(3, 3 + spec.rows, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
        shift = (np.arange(16, dtype=np.uint64) * np.uint64(4))[None, :]
        for batch in batches:
            counts, digests, bands, packed, odd = [], [], [], [], []
            for text, shingles in zip(batch.column(2), shingle_sets(batch.column(2), spec.shingle), strict=True):
                counts.append(len(shingles))
                if not len(shingles):
                    digests.append(None)
                    bands.append(None)
                    packed.append(None)
                    odd.append(None)
                    continue
                least = _minima(shingles, a, b)
                keys = mix64((least.reshape(spec.bands, spec.rows) * turn).sum(axis=1, dtype=np.uint64) + salt)
                low = np.zeros(spec.words64 * 16, dtype=np.uint64)
                low[: spec.hashes] = (least ^ (least >> np.uint64(32))) & np.uint64(15)
                digests.append(_words_digest(text.as_py()))
                bands.append(keys.view(np.int64))
                odd.append(_parity(shingles))
                packed.append((low.reshape(-1, 16) << shift).sum(axis=1, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(packed, pa.list_(pa.int64())),
                    pa.array(odd, pa.list_(pa.int64())),
                ],
                names=["key", "doc_id", "n_shingles", "digest", "bands", "packed", "odd"],
            )

    return sign


def signatures(texts: DataFrame, spec: MinHashSpec) -> DataFrame:
    """(key, doc_id, text) to key, doc_id, n_shingles, digest, bands, packed, odd (the last four null for an empty set)."""
    schema = "key binary, doc_id long, n_shingles long, digest binary, bands array<long>, packed array<long>, odd array<long>"
    return texts.mapInArrow(_signer(spec), schema)


def _unequal(spec: MinHashSpec, a: str, b: str) -> str:
    """SQL for the number of minima that differ in their low bits: nibbles of XOR that are not zero."""
    return " + ".join(
        "bit_count((x | shiftrightunsigned(x, 1) | shiftrightunsigned(x, 2) | shiftrightunsigned(x, 3)) & 1229782938247303441L)".replace(
            "x", f"({a}.packed[{i}] ^ {b}.packed[{i}])"
        )
        for i in range(spec.words64)
    )


def _may_link(spec: MinHashSpec, a: str, b: str) -> str:
    """SQL test of a pair: sizes within the threshold's ratio, and the b-bit estimate high enough.

    1/16 of unequal minima agree in 4 bits by chance, so the share of equal
    nibbles e gives the similarity (e - 1/16) / (15/16). Each shingle that only
    one set has turns one bit of the parity sketches, so their XOR counts at
    most the symmetric difference, which a link bounds: a pair over the bound
    is no link for certain.
    """
    most = spec.hashes * (1 - (spec.least_estimate * 15 / 16 + 1 / 16))
    sizes = f"100 * least({a}.n, {b}.n) >= {spec.percent} * greatest({a}.n, {b}.n)"
    odd = " + ".join(f"bit_count({a}.odd[{i}] ^ {b}.odd[{i}])" for i in range(ODD_BITS // 64))
    apart = f"({odd}) * {100 + spec.percent} <= ({a}.n + {b}.n) * {100 - spec.percent}"
    return f"{sizes} and ({_unequal(spec, a, b)}) <= {most:.6f} and {apart}"


def _verifier(spec: MinHashSpec):
    import pandas as pd

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = dict(zip(pdf["node"], pdf["text"], strict=True))
        sets = dict(zip(texts, shingle_sets(pa.array(texts.values(), pa.string()), spec.shingle), strict=True))
        hub = pdf["hub"].iloc[0]
        base, out, base_bytes = sets.get(hub), [], None
        for member, own in sets.items():
            if member == hub or base is None:
                continue
            both = len(np.intersect1d(base, own, assume_unique=True))
            if 100 * both >= spec.percent * (len(base) + len(own) - both):
                if base_bytes is None:
                    base_bytes = byte_shingles(texts[hub], spec.shingle)
                own_bytes = byte_shingles(texts[member], spec.shingle)
                both = len(base_bytes & own_bytes)
                if 100 * both >= spec.percent * (len(base_bytes) + len(own_bytes) - both):
                    out.append((member, hub))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return verify


def verified(pairs: DataFrame, texts: DataFrame, names: DataFrame, spec: MinHashSpec) -> DataFrame:
    """Pairs (u, v) of classes whose full shingle sets meet the threshold.

    ``names`` gives a class (cls) the key of its document, ``texts`` a key its
    text. v is the hub of a star; its members are dealt into blocks of about
    ``spec.block``, and the hub's text goes to each block. A text that no pair
    names is not shuffled as long as the bitmap of wanted keys has room.
    """
    sizes = pairs.groupBy("v").agg(F.count("*").alias("n"))
    dealt = pairs.join(sizes, "v").select(
        "u", "v", F.expr(f"pmod(xxhash64(u), cast(ceil(n / {spec.block}) as long))").alias("blk")
    )
    dealt = write_scratch(dealt, "star-pairs")
    need = dealt.select(F.col("u").alias("node"), F.col("v").alias("hub"), "blk").unionByName(
        dealt.select(F.col("v").alias("node"), F.col("v").alias("hub"), "blk").distinct()
    )
    named = names.join(need.select(F.col("node").alias("cls")).distinct(), "cls").select(F.col("cls").alias("node"), F.col("rep").alias("key"))
    held = id_prefilter(texts.select("key", "text"), "key", named.select("key")).join(named, "key").groupBy("node").agg(F.min("text").alias("text"))
    return need.join(held, "node").groupBy("hub", "blk").applyInPandas(_verifier(spec), "u long, v long")


def _merged(joined: DataFrame, moved: DataFrame) -> DataFrame:
    """Components after ``moved`` gives old components (and single nodes, which are their own) their new ones."""
    m = moved.select(F.col("node").alias("_old"), F.col("component_id").alias("_new"))
    kept = joined.join(m, F.col("component_id") == F.col("_old"), "left").select("node", F.coalesce("_new", "component_id").alias("component_id"))
    return write_scratch(kept.unionByName(moved.join(joined, "node", "left_anti")), "components")


def _settle(pairs: DataFrame, joined: DataFrame, texts: DataFrame, names: DataFrame, spec: MinHashSpec) -> DataFrame:
    """Components (node, component_id) after all links among the candidate ``pairs`` (u, v, far).

    In each of ``spec.rounds`` rounds every document verifies only its nearest
    candidate by the estimate that is in another component and untested; then
    whatever pairs still lie between components are all verified. Pairs inside
    a component need no test, so a group of n near copies costs about n tests.
    The links found join whole components, so only those are searched anew.
    """
    tested = None
    for turn in range(spec.rounds + 1):
        u, v = joined.select(F.col("node").alias("u"), F.col("component_id").alias("cu")), joined.select(F.col("node").alias("v"), F.col("component_id").alias("cv"))
        placed = pairs.select("u", "v", "far").join(u, "u", "left").join(v, "v", "left").select("u", "v", "far", F.coalesce("cu", "u").alias("cu"), F.coalesce("cv", "v").alias("cv"))
        apart = placed.filter("cu <> cv")
        pairs = write_scratch(apart.join(tested, ["u", "v"], "left_anti") if tested is not None else apart, "pairs-apart")
        if pairs.isEmpty():
            break
        now = pairs.groupBy("u").agg(F.min(F.struct("far", "v", "cu", "cv")).alias("n")).select("u", "n.v", "n.cu", "n.cv") if turn < spec.rounds else pairs.drop("far")
        now = write_scratch(now, "pairs-now")
        tested = now.select("u", "v")
        links = write_scratch(verified(tested, texts, names, spec).join(now, ["u", "v"]).select(F.col("cu").alias("u"), F.col("cv").alias("v")), "links-now")
        if not links.isEmpty():
            joined = _merged(joined, write_scratch(connected_components(links), "moved"))
    return joined


def near_duplicates(
    docs: DataFrame, spec: MinHashSpec | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_id, text_kept.

    Empty or null texts (no words) link with nothing. Rows with a null id link
    with nothing, have a null component_id and are kept. Repeated rows each get
    the row of their document. An id repeated with different texts stands for
    all of them: whatever one of its texts links with is one component, and
    ``kept`` is that of the id. ``text_id`` names the row's id and text;
    ``text_kept`` judges the text alone, without the links an id makes between
    its texts: true for one text_id of each group of near duplicates, and for
    texts that belong to none. Other columns are ignored, whatever their names.
    An empty table gives an empty result.
    """
    spec = spec or MinHashSpec()
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = narrow.select(document_key(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("key"), "doc_id", "text")
    signed = write_scratch(signatures(texts, spec), "minhash")

    # Classes of equal words, numbered in the order of their first document's key.
    classes = signed.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("key").alias("rep"), F.min("doc_id").alias("rep_id"))
    classes = classes.repartitionByRange("rep").sortWithinPartitions("rep").withColumn("cls", F.monotonically_increasing_id())
    classes = write_scratch(classes, "classes")
    names = classes.select("cls", "rep")
    reps = write_scratch(
        signed.join(names, F.col("key") == F.col("rep"))
        .select(F.col("cls").alias("rep"), F.col("n_shingles").cast("int").alias("n"), "bands", "packed", "odd")
        .dropDuplicates(["rep"]),  # repeated rows are alike here
        "reps",
    )
    rep_packed = reps.select("rep", "n", "packed", "odd")
    by_band = reps.select("rep", F.explode("bands").alias("band"))
    hubs = by_band.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("_top")).filter("hub <> _top")
    shared = write_scratch(by_band.join(hubs.select("band", "hub"), "band"), "buckets")

    first = shared.filter("rep <> hub").select("rep", "hub").distinct()
    a, b = rep_packed.alias("a"), rep_packed.select(F.col("rep").alias("hub"), "n", "packed", "odd").alias("b")
    stars = write_scratch(
        first.join(a, "rep")
        .join(b, "hub")
        .filter(_may_link(spec, "a", "b"))
        .select(F.col("rep").alias("u"), F.col("hub").alias("v"), F.expr(_unequal(spec, "a", "b")).alias("far")),
        "star-candidates",
    )
    none = docs.sparkSession.createDataFrame([], "node long, component_id long")
    joined = _settle(stars, none, texts, names, spec)

    # Buckets whose members are still in different components.
    placed = shared.select("band", "rep").join(joined, F.col("rep") == F.col("node"), "left").select(
        "band", "rep", F.coalesce("component_id", "rep").alias("comp")
    )
    open_bands = placed.groupBy("band").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).filter("_a <> _b").select("band")
    still = placed.join(open_bands, "band").join(rep_packed, "rep")
    x, y = still.alias("x"), still.alias("y")
    rest = (
        x.join(y, F.expr("x.band = y.band and x.comp < y.comp and " + _may_link(spec, "x", "y")))
        .select(F.greatest("x.rep", "y.rep").alias("u"), F.least("x.rep", "y.rep").alias("v"), F.expr(_unequal(spec, "x", "y")).alias("far"))
        .distinct()
        .join(stars, ["u", "v"], "left_anti")
    )
    joined = _settle(write_scratch(rest, "cross-candidates"), joined, texts, names, spec)

    # The group of each class, and the key that stays of it.
    placed = classes.join(joined, F.col("cls") == F.col("node"), "left").select("digest", F.coalesce("component_id", "cls").alias("comp"))
    heads = classes.select(F.col("cls").alias("comp"), F.col("rep").alias("head"), F.col("rep_id").alias("head_id"))
    found = write_scratch(placed.join(heads, "comp").select(F.col("digest").alias("_digest"), "comp", "head", "head_id"), "class-groups")
    out = signed.select("key", "doc_id", "n_shingles", "digest").join(found, (F.col("digest") == F.col("_digest")) & F.col("doc_id").isNotNull(), "left")
    out = write_scratch(out.drop("digest", "_digest"), "document-groups")

    # An id with several texts joins their groups.
    several = out.filter("comp is not null").groupBy("doc_id").agg(F.min("comp").alias("least"), F.max("comp").alias("_most")).filter("least <> _most")
    several = write_scratch(several.select("doc_id", "least"), "ids-of-several")
    if not several.isEmpty():
        links = out.join(several, "doc_id").filter("comp <> least").select(F.col("comp").alias("u"), F.col("least").alias("v")).distinct()
        moved = connected_components(links).join(heads.select(F.col("comp").alias("component_id"), F.col("head_id").alias("_joined")), "component_id")
        moved = write_scratch(moved.select(F.col("node").alias("comp"), "_joined"), "joined-groups")
        out = out.join(moved, "comp", "left").withColumn("head_id", F.coalesce("_joined", "head_id"))
        # A text without words belongs to its id all the same.
        ids = write_scratch(out.filter("head_id is not null").groupBy("doc_id").agg(F.min("head_id").alias("_id")), "ids")
        out = out.join(ids, "doc_id", "left").withColumn("head_id", F.coalesce("head_id", "_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        F.expr("case when doc_id is null then null else coalesce(head_id, doc_id) end").alias("component_id"),
        F.expr("coalesce(doc_id = coalesce(head_id, doc_id), true)").alias("kept"),
        F.col("key").alias("text_id"),
        F.expr("coalesce(key = head, true)").alias("text_kept"),
    )


def keep_one_of_each(docs: DataFrame, spec: MinHashSpec | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: one (id, text) of each group, and one row of repeated ones.

    Decided by id and text together: an id's other texts are judged by
    themselves. Rows with a null id, and texts without words, stay. Of repeated
    rows (id and text alike) the one whose other columns are least stays. All
    columns are kept as they are, whatever their names.
    """
    found = write_scratch(near_duplicates(docs, spec, id_col, text_col).select("doc_id", F.col("text_id").alias("_hm_gone"), "text_kept"), "near-duplicates")
    key = document_key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    gone = found.filter("not text_kept").select("_hm_gone").distinct()
    kept = docs.withColumn("_hm_key", key).join(gone, F.col("_hm_key") == F.col("_hm_gone"), "left_anti")
    again = found.filter("doc_id is not null and text_kept").groupBy("_hm_gone").agg(F.count("*").alias("_hm_n")).filter("_hm_n > 1").select("_hm_gone")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if again.isEmpty():
        return kept.select(*columns)
    once = kept.join(again, F.col("_hm_key") == F.col("_hm_gone"), "left_anti").select(*columns)
    copies = kept.join(again, F.col("_hm_key") == F.col("_hm_gone"), "left_semi")
    one = copies.groupBy("_hm_key").agg(F.min(F.struct(*columns)).alias("_hm_row"))
    return once.unionByName(one.select(*[F.col("_hm_row").getField(c).alias(c) for c in docs.columns]))
