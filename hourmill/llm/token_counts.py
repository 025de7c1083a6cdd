"""Token counts by a digest cache.

A count belongs to a pair of digests: of the content as the tokenizer
normalises it, and of the tokenizer file. A tokenizer that normalises nothing
needs no Python for the first; a text that holds one of its special strings,
which are cut out before normalising, is digested raw. Documents are joined
with the stored counts; of those without one, each distinct content is encoded
once and appended to the cache, a Parquet folder partitioned by the tokenizer's
digest. Only texts that another row may share leave the task that reads them. A later run, or another corpus with the same texts, finds them there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmill.llm.common import bounded_batches, id_outside, id_prefilter, write_scratch
from hourmill.session import path_exists

CACHE = "digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()[:32]


class CountedTokenizer:
    """Counts with sentencepiece (.model) or tokenizers (.json), no special ids added.

    ``normalise`` gives the content a count depends on; None: the text itself, but for the mark of its blanks.
    """

    def __init__(self, path: str):
        self.normalise = None
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self.count = lambda texts: [len(e.ids) for e in t.encode_batch_fast(texts, add_special_tokens=False)]
            special = [a.content for a in t.get_added_tokens_decoder().values()]
            if t.normalizer is not None:
                normal = t.normalizer.normalize_str
                # The mark keeps a raw text apart from a normalised one of the same letters.
                self.normalise = lambda x: "\0" + x if any(s in x for s in special) else normal(x)
        else:
            import sentencepiece

            t = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = lambda texts: [len(t.encode(x)) for x in texts]
            if any(t.normalize(x) != self.marked(x) for x in _PROBES):
                self.normalise = t.normalize

    @staticmethod
    def marked(text: str) -> str:
        """What a .model does that normalises nothing but blanks."""
        return "\u2581" + text.replace(" ", "\u2581")


#: What normalisers change: compositions, compatibility forms, capitals, blanks.
_PROBES = ("e\u0301", "\ufb01 \uff21", "ABC", "  a  b ", "a\tb\nc", "\u00a0\u200b")


_LOADED: dict[str, CountedTokenizer] = {}


def _loaded(path: str) -> CountedTokenizer:
    if path not in _LOADED:
        _LOADED[path] = CountedTokenizer(path)
    return _LOADED[path]


def _digester(path: str):
    """(doc_id, text) to (doc_id, text, digest) by the tokenizer's normaliser."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normalise = _loaded(path).normalise
        for batch in batches:
            digests = [hashlib.sha256(normalise(x).encode()).digest() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], names=["doc_id", "text", "digest"])

    return digest


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = _loaded(path).count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    return count


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version; two writers may have stored a digest twice."""
    path = f"{cache}/tokenizer={version}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def unseen_texts(texts: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(digest, text) of each content without a stored count, once: those that stay where they are read, and those that travel.

    ``found``: digest, first_id, n (rows), known (null without a stored count).
    A content that no other row has needs no shuffle; a bitmap tells most of
    them. Of the others the text of the first id is sent, once for all its rows.
    """
    others = found.filter("known or n > 1")
    misses = found.filter("known is null")
    first = F.xxhash64("digest", "doc_id").alias("_first")
    rest = id_prefilter(texts, "digest", others).select("digest", "text", first)
    rest = id_prefilter(rest, "_first", misses.select(F.xxhash64("digest", "first_id").alias("_first"))).select("digest", "text")
    rest = rest.dropDuplicates(["digest"]).join(misses.select("digest"), "digest", "left_semi")
    return id_outside(texts, "digest", others).select("digest", "text"), rest


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Null texts are empty and have 0 tokens. Repeated rows, contents that are
    equal once normalised, and null ids share one count. Other columns are
    ignored; an empty table gives an empty result and leaves the cache as it is.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    version = tokenizer_digest(tokenizer)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    if CountedTokenizer(tokenizer).normalise is None:
        texts = texts.withColumn("digest", F.unhex(F.sha2(F.replace(F.col("text"), F.lit(" "), F.lit("\u2581")).cast("binary"), 256)))
    else:
        texts = texts.mapInArrow(_digester(tokenizer), "doc_id long, text string, digest binary")
    keys = write_scratch(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "text-digests")
    stored = read_cache(spark, cache, version)
    found = keys.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    found = write_scratch(found.join(stored.select("digest", F.lit(True).alias("known")), "digest", "left"), "distinct-digests")
    if not found.filter("known is null").isEmpty():
        alone, first = unseen_texts(texts, found)
        counted = alone.unionByName(first).mapInArrow(_counter(tokenizer), CACHE)
        counted.write.mode("append").parquet(f"{cache}/tokenizer={version}")
    # Written, so that the join sees plain shuffles, of which Spark can split a frequent text's.
    known = write_scratch(read_cache(spark, cache, version), "known-counts")
    out = keys.join(known, "digest", "left")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
