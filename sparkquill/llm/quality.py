"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Every signal is a column expression over one row, so the rules add no shuffle and run inside the scan stage.

Defined results: a null text has no words; a text without words has ratio 0 everywhere and fails the length rule;
repeated rows and equal texts get equal verdicts; very long texts are measured whole, as any other; extra columns are
kept, whatever their names, but a column named as the output (``quality``) is replaced by it; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkquill.llm.columns import fresh

SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with be by as this are at from "
    "de la le et les des en un du une que pour est qui dans par sur pas au avec "
    "der die und den von zu das mit sich auf für ist nicht im dem ein eine als "
    "el y los se del las por no con su para es al lo"
).split()


#: As they stand in texts: in lower case or with a capital, alone or before a comma or full stop.
STOP_FORMS = sorted({f + end for w in STOP_WORDS for f in (w, w.capitalize()) for end in ("", ",", ".")})


@dataclass(frozen=True)
class Rule:
    """``signal`` must lie in [least, most]; a missing bound is open."""

    name: str
    signal: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("few_words", "n_words", least=20),
    Rule("word_length", "mean_word_chars", least=2, most=15),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.08),
    Rule("stutters", "stutter_ratio", most=0.3),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
    Rule("exclamations", "exclamation_ratio", most=0.5),
)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, though ``body`` uses it within lambdas."""
    return F.transform(F.array(value), body)[0]


def n_repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words inside windows of ``size`` words that the text has twice or more, the first occurrence included.

    Windows are compared by a 64-bit hash, and a match is confirmed on the words themselves. Only texts in which some
    hash occurs twice are sorted.
    """
    none = F.lit(0).cast("long")

    def hashes(w: Column) -> Column:
        ones = F.transform(w, lambda x: F.xxhash64(x))
        return let(
            ones,
            lambda h: F.slice(F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, size)])), 1, F.size(h) - (size - 1)),
        )

    def positions(s: Column) -> Column:
        def same(e: Column, k: Column) -> Column:
            other = F.get(s, k)
            words_equal = F.forall(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.get(words, other["i"] + j) == F.get(words, e["i"] + j))
            return F.coalesce((other["h"] == e["h"]) & words_equal, F.lit(False))

        return F.sort_array(F.transform(F.filter(s, lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"]))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size))))
        return F.aggregate(steps, none, lambda a, x: a + x)

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: let(positions(s), total))

    return F.when(F.size(words) <= size, none).otherwise(
        let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h)))
    )


def counts(text: Column, words: Column) -> dict[str, Column]:
    """Whole numbers by name; ``words`` is the array of words of ``text``."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(SPACES)) != "")
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    found = {
        "n_words": F.size(words),
        "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")),
        "n_exclamations": F.regexp_count(text, F.lit("!")),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(STOP_FORMS))),
        "n_stutters": F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))),
        "n_repeat_words": n_repeat_words(words),
    }
    return {k: c.cast("long") for k, c in found.items()} | {"lines": of_lines}


def ratios(counted: str) -> dict[str, Column]:
    """Signals of the columns that ``counts`` names, in the struct ``counted``."""
    c = lambda name: F.col(f"{counted}.{name}")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return {
        "n_words": c("n_words"),
        "word_chars": c("word_chars"),
        "n_symbols": c("n_symbols"),
        "n_dup_lines": c("lines.dup"),
        "n_repeat_words": c("n_repeat_words"),
        "mean_word_chars": ratio(c("word_chars"), c("n_words")),
        "symbol_ratio": ratio(c("n_symbols"), c("n_words")),
        "stop_word_ratio": ratio(c("n_stop_words"), c("n_words")),
        "stutter_ratio": ratio(c("n_stutters"), c("n_words")),
        "dup_line_ratio": ratio(c("lines.dup"), c("lines.n")),
        "exclamation_ratio": ratio(c("n_exclamations"), c("n_words")),
    }


def compiled(rules: tuple[Rule, ...], signals_in: str) -> Column:
    """The threshold table as one expression: the names of the rules that a row breaks."""
    broken = []
    for rule in rules:
        signal = F.col(f"{signals_in}.{rule.signal}")
        bounds = [signal < rule.least] if rule.least is not None else []
        bounds += [signal > rule.most] if rule.most is not None else []
        broken += [F.when(bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1], F.lit(rule.name))] if bounds else []
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def measure(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``into`` of all signals."""
    (counted,) = fresh(docs, "counted")
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), lambda w: w != "")
    every = let(words, lambda w: F.struct(*[c.alias(k) for k, c in counts(F.col(text), w).items()]))
    # explode of one element ends the expression: a filter on a verdict is not pushed below it, which would repeat the counts for each signal
    found = docs.select("*", F.explode(F.array(every)).alias(counted))
    return found.withColumn(into, F.struct(*[c.alias(k) for k, c in ratios(counted).items()])).drop(counted)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with ``into``: a struct of the signals, ``base_failed``, the names of ``broken`` rules, and ``kept``."""
    docs = docs.drop(into)
    signals, broken, base = fresh(docs, "signals", "broken", "base")
    base_failed = (F.col(f"{signals}.n_words") < 20) | (100 * F.col(f"{signals}.n_repeat_words") > 30 * F.col(f"{signals}.n_words"))
    found = measure(docs, signals, text).withColumns({broken: compiled(rules, signals), base: base_failed})
    kept = ~F.col(base) & (F.size(broken) == 0)
    verdict = F.struct(f"{signals}.*", F.col(base).alias("base_failed"), F.col(broken).alias("broken"), kept.alias("kept"))
    return found.withColumn(into, verdict).drop(signals, broken, base)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    q = "quality."
    return judge(docs).select(
        "doc_id",
        *[F.col(q + c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
    )
