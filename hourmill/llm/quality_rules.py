"""Quality rules: a threshold table compiled into one Spark projection.

Everything is DataFrame functions; a document's words are bound once in the
projection and shared by all its measures. No shuffle, no user function.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that parts words, and the symbols counted.
WHITE_SPACE = "\t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that for it was on with as by an be this at or "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le les et en un du une est que pour dans qui au "
    "el los del se las por con para su lo"
).split()


@dataclass(frozen=True)
class Rule:
    """The document fails if ``measure`` is outside [least, most], in hundredths of ``per``.

    Compared as integers: 100 * measure < least * per or 100 * measure > most * per.
    """

    name: str
    measure: str
    per: str
    least: int | None = None
    most: int | None = None

    def fails(self, m: Callable[[str], Column]) -> Column:
        value, base = m(self.measure) * 100, m(self.per)
        low = value < base * self.least if self.least is not None else F.lit(False)
        high = value > base * self.most if self.most is not None else F.lit(False)
        return low | high


#: Base rules: too few words, or too many of them in repeated 8-word windows.
BASE = (
    Rule("short", "n_words", "one", least=2000),
    Rule("repeats", "n_repeat_words", "n_words", most=30),
)
#: The method's own thresholds.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=250, most=1200),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("stop_words", "n_stop_words", "n_words", least=2),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=40),
)
WINDOW = 8


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice: the union of [p, p + WINDOW) over their starts p."""

    def from_sorted(s: Column) -> Column:
        twin = F.filter(
            s, lambda e, k: F.get(s, k - 1)["h"].eqNullSafe(e["h"]) | F.get(s, k + 1)["h"].eqNullSafe(e["h"])
        )
        return _let(
            F.sort_array(F.transform(twin, lambda e: e["p"])),
            lambda at: F.aggregate(
                F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda total, x: total + x,
            ),
        )

    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    ordered = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
    return F.when(some, _let(ordered, from_sorted)).otherwise(F.lit(0).cast("long"))


def measures(text: Column, stop_words: list[str] | None = None) -> Column:
    """A struct of the counts that the rules compare; a null text has no words."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    stop = list(stop_words or STOP_WORDS)

    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        hashes = F.when(
            F.size(w) >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        ).otherwise(F.array().cast("array<bigint>"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(stop))).cast("long").alias("n_stop_words"),
            _let(hashes, _covered).alias("n_repeat_words"),
        )

    blank = F.translate(t, WHITE_SPACE, " " * len(WHITE_SPACE))
    words = F.array_remove(F.split(blank, " "), "")
    no_space = lambda x: F.translate(x, " " + WHITE_SPACE, "")
    lines = F.filter(F.split(t, "\n"), lambda x: no_space(x) != "")
    return F.struct(
        _let(words, of_words).alias("w"),
        F.length(no_space(t)).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("own"))).alias("l"),
    )


def apply_rules(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    base: tuple[Rule, ...] = BASE,
    id_col: str = "doc_id",
    text_col: str = "text",
    stop_words: list[str] | None = None,
) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept and failed_rules.

    Null or empty texts have no words and fail ``short``. Repeated rows and
    null ids are judged like any other row; other columns are ignored; an
    empty table gives an empty result.
    """
    counted = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col), stop_words).alias("m"))
    m = {
        "n_words": F.col("m.w.n_words"),
        "word_chars": F.col("m.word_chars"),
        "n_symbols": F.col("m.n_symbols"),
        "n_dup_lines": (F.col("m.l.all") - F.col("m.l.own")).cast("long"),
        "n_repeat_words": F.col("m.w.n_repeat_words"),
        "n_stop_words": F.col("m.w.n_stop_words"),
        "n_lines": F.col("m.l.all").cast("long"),
    }
    flat = counted.select("doc_id", *[c.alias(k) for k, c in m.items()])
    get = lambda k: F.lit(1) if k == "one" else F.col(k)
    any_base = F.lit(False)
    for r in base:
        any_base = any_base | r.fails(get)
    failed = F.array_compact(F.array(*[F.when(r.fails(get), F.lit(r.name)) for r in (*base, *rules)]))
    return flat.select(
        "*", any_base.alias("base_failed"), (F.size(failed) == 0).alias("kept"), failed.alias("failed_rules")
    )


def keep_passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that fail no rule, with their own columns; a narrow filter, no join."""
    m = measures(F.col(text_col))
    held = "_m"
    while held in docs.columns:
        held += "_"
    get = {
        "n_words": F.col(f"{held}.w.n_words"),
        "word_chars": F.col(f"{held}.word_chars"),
        "n_symbols": F.col(f"{held}.n_symbols"),
        "n_dup_lines": F.col(f"{held}.l.all") - F.col(f"{held}.l.own"),
        "n_repeat_words": F.col(f"{held}.w.n_repeat_words"),
        "n_stop_words": F.col(f"{held}.w.n_stop_words"),
        "n_lines": F.col(f"{held}.l.all"),
        "one": F.lit(1),
    }.__getitem__
    fine = F.lit(True)
    for r in (*base, *rules):
        fine = fine & ~r.fails(get)
    return docs.withColumn(held, m).filter(fine).drop(held)
