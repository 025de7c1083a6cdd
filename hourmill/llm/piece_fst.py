"""SentencePiece encoding and decoding as shortest paths in a transducer.

The model file is compiled into: a normaliser (a blank in front, blanks to
U+2581), an arc for every piece that its merges can reach, and byte-fallback
arcs for characters that are no piece. The pieces' scores are merge ranks, not
additive costs, so the plain sum of scores would not give the library's ids.
Arcs therefore carry weights of the tropical semiring between neighbours: 0 if
merging the two pieces' characters alone gives these two pieces back, else
infinite. A path of weight 0 is the encoding, and there is exactly one: a
sequence of pieces is what merging produces if and only if each adjacent pair
is. Each prefix of the input then has one best last piece, so the search
settles each position at most once.

No piece joins a U+2581 to characters before it, so the input is composed
unit by unit (blanks and what follows), cut again between characters that no
piece joins. A worker keeps the paths of the units it has seen lately.
Decoding inverts the transducer.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmill.llm.common import bounded_batches

_BLANK = "▁"
_UNITS = re.compile(f"{_BLANK}+[^{_BLANK}]*|[^{_BLANK}]+").findall


def read_model(path: str) -> tuple[list[tuple[str, float, int]], bool]:
    """Pieces (text, score, type) and whether a blank is put in front."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
        raise ValueError("only merge models with byte fallback are compiled")
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
        raise ValueError("only models that keep characters and blanks are compiled")
    pieces = [(p.piece, p.score, p.type) for p in model.pieces]
    if any(t == 4 for _, _, t in pieces) or any(re.search(f"[^{_BLANK}]{_BLANK}", p) for p, _, t in pieces if t == 1):
        raise ValueError("a piece crosses a blank")
    return pieces, spec.add_dummy_prefix


class PieceTransducer:
    def __init__(self, path: str, most_units: int = 300_000, most_pairs: int = 1_000_000):
        pieces, self.prefix = read_model(path)
        normal = {p: (i, s) for i, (p, s, t) in enumerate(pieces) if t == 1}
        self.score = {p: s for p, (_, s) in normal.items()}
        self.text = [p for p, _, _ in pieces]
        self.byte = [0] * 256
        self.value: dict[int, int] = {}
        for i, (p, _, t) in enumerate(pieces):
            if t == 6:
                self.byte[int(p[3:5], 16)] = i
                self.value[i] = int(p[3:5], 16)
        self.arcs = {p: i for p, (i, _) in normal.items() if self._merge(p) == [p]}
        self.joins = {p[i : i + 2] for p in normal for i in range(len(p) - 1)}
        self.chars = {p for p in normal if len(p) == 1}
        self.reach: dict[str, int] = {}  # two characters to the length of the longest arc they begin
        for p in self.arcs:
            self.reach[p[:2]] = max(len(p), self.reach.get(p[:2], 1))
        self.raw = [bytes([self.value[i]]) if i in self.value else p.encode() for i, p in enumerate(self.text)]
        self.most_units, self.most_pairs = most_units, most_pairs
        self.units: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}  # units of the last full round: frequent ones move on
        self.pairs: dict[tuple[int, int], bool] = {}

    def _merge(self, text: str) -> list[str]:
        """Characters merged by the best score, leftmost first: what defines an arc and a pair."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, a: int, b: int) -> bool:
        """Computes and keeps the weight between two pieces."""
        if len(self.pairs) > self.most_pairs:
            self.pairs.clear()
        x, y = self.text[a], self.text[b]
        known = self.pairs[a, b] = self._merge(x + y) == [x, y]
        return known

    def path(self, unit: str) -> tuple[int, ...]:
        """Ids of the shortest path over a unit.

        Only one path of weight 0 leads to any position, so a position is
        settled once: the search takes the longest arc first, and steps back
        from a position that no arc leaves, never to enter it again.
        """
        arcs, chars, pairs, reach, n = self.arcs, self.chars, self.pairs, self.reach, len(unit)
        taken: list[int] = []  # pieces from the start; -1 for a character in bytes
        begins: list[int] = []
        dead: set[int] = set()
        at, before, top = 0, -1, -1
        while at < n:
            if top < 0:
                top = min(n, at + reach.get(unit[at : at + 2], 1))
            if unit[at] not in chars:
                piece, end = -1, at + 1
                found = top > at and end not in dead
            else:
                found = False
                for end in range(top, at, -1):
                    piece = arcs.get(unit[at:end])
                    if piece is None or end in dead:
                        continue
                    if before >= 0:
                        found = pairs.get((before, piece))
                        if found is None:
                            found = self._may_follow(before, piece)
                    else:
                        found = True
                    if found:
                        break
            if found:
                taken.append(piece)
                begins.append(at)
                at, before, top = end, piece, -1
            else:
                dead.add(at)
                taken.pop()
                at, top = begins.pop(), at - 1
                before = taken[-1] if taken else -1
        if -1 not in taken:
            return tuple(taken)
        out: list[int] = []
        for piece, begin in zip(taken, begins, strict=True):
            out += [piece] if piece >= 0 else [self.byte[b] for b in unit[begin].encode()]
        return tuple(out)

    def _find(self, unit: str) -> tuple[int, ...]:
        """Ids of a unit not among the newest ones, cut where no piece joins two neighbours."""
        own = self.older.get(unit)
        if own is None:
            joins, begin, parts = self.joins, 0, []
            for i in range(1, len(unit)):
                if unit[i - 1 : i + 1] not in joins:
                    part = unit[begin:i]
                    parts += self.units.get(part) or self._find(part)
                    begin = i
            if begin:
                part = unit[begin:]
                own = (*parts, *(self.units.get(part) or self._find(part)))
            else:
                own = self.path(unit)
        if len(unit) < 64:
            if len(self.units) >= self.most_units:
                self.older = self.units.copy()
                self.units.clear()
            self.units[unit] = own
        return own

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        normal = (_BLANK if self.prefix else "") + text.replace(" ", _BLANK)
        ids: list[int] = []
        units = self.units
        for unit in _UNITS(normal):
            own = units.get(unit)
            if own is None:
                own = self._find(unit)
            ids += own
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text whose encoding has these ids; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.raw.__getitem__, ids)).decode(errors="replace")
        raw = raw.replace(_BLANK, " ")
        return raw[1:] if self.prefix and raw.startswith(" ") else raw


_LOADED: dict[str, PieceTransducer] = {}


def transducer(path: str) -> PieceTransducer:
    if path not in _LOADED:
        _LOADED[path] = PieceTransducer(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids, normal_crc32 (of the text with U+2581 as blank).

    Null and empty texts have no ids. Repeated rows and null ids are encoded
    like others; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                texts = batch.column(1).slice(lo, 64).to_pylist()
                ids = [np.array(fst.encode(t), dtype=np.int32) for t in texts]
                cuts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                crc = [zlib.crc32(t.replace(_BLANK, " ").encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, 64), pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat)), pa.array(crc, pa.int64())],
                    names=["doc_id", "ids", "normal_crc32"],
                )

    return narrow.mapInArrow(run, "doc_id long, ids array<int>, normal_crc32 long")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, ids and other columns of ``encoded``, with the decoded ``text``; null ids give an empty text."""
    rest = [c for c in encoded.columns if c not in ("ids", "text")]
    schema = encoded.select("ids", *rest).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = transducer(model)
        for batch in batches:
            ids = batch.column(0).fill_null([])
            cuts = ids.offsets.to_pylist()
            texts = []
            for lo in range(0, len(ids), 64):  # Python integers of a few documents at a time
                hi = min(lo + 64, len(ids))
                flat = ids.values.slice(cuts[lo], cuts[hi] - cuts[lo]).to_numpy(zero_copy_only=False).tolist()
                texts += [fst.decode(flat[x - cuts[lo] : y - cuts[lo]]) for x, y in zip(cuts[lo:hi], cuts[lo + 1 : hi + 1], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"])

    return encoded.select("ids", *rest).mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian unsigned 32-bit), round_trip: decoding gives the normalised text back."""
    decoded = decode_documents(encode_documents(docs, model, id_col, text_col), model)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            cuts, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[x:y].tobytes()) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            same = [zlib.crc32(t.encode()) == c for t, c in zip(b.column("text").to_pylist(), b.column("normal_crc32").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(cuts).astype(np.int64)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_crc32", "round_trip"],
            )

    return decoded.mapInArrow(digest, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")
