"""One registered query per text operator, and the pipeline, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourmill.llm.cap_filters import near_vectors
from hourmill.llm.collocations import collocations
from hourmill.llm.hard_negatives import hard_negatives
from hourmill.llm.language_id import identify_languages
from hourmill.llm.near_dup import near_duplicates
from hourmill.llm.packing import pack_documents
from hourmill.llm.piece_fst import round_trip
from hourmill.llm.pii import replace_entities
from hourmill.llm.quality_classifier import score_documents
from hourmill.llm.quality_rules import apply_rules
from hourmill.llm.repeats import remove_repeats
from hourmill.llm.token_counts import count_tokens
from hourmill.llm.token_files import read_tokens, write_tokens
from hourmill.session import scratch_path

WORDS = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
#: Surrogates are only as secret as this key; pass your own to the operator.
SURROGATE_KEY = "hourmill-registered-query"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = write_tokens(_table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"), tokenizer_path(WORDS), end=1)
    return read_tokens(spark, store)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(WORDS))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replace_entities(_table(spark, sf_dir, "documents"), SURROGATE_KEY, count_col="n_entities")
    return out.select("doc_id", "text", "n_entities")


def op8_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over some documents fills the cache; the second, over all, finds their counts there."""
    docs, cache = _table(spark, sf_dir, "documents"), scratch_path(spark, "token-counts")
    count_tokens(docs.filter("doc_id % 16 = 0"), tokenizer_path(PIECES), cache)
    return count_tokens(docs, tokenizer_path(PIECES), cache)


def op10_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash, op2_token_files, op3_quality_classifier, op4_quality_rules, op5_packing,
        op6_language_id, op7_surrogates, op8_piece_transducer, op9_token_counts, op10_cap_filters,
        op11_repeats, op12_hard_negatives, op13_collocations,
    )
}


def statements() -> dict[str, str]:
    from hourmill.llm.oracle import ORACLES

    return dict(ORACLES)
