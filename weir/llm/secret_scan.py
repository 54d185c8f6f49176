"""Secrets in texts: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Two first-order models over letters, digits and marks are counted by Spark: one from the secret values that the patterns
find, one from all other tokens of the corpus. A long token whose log-likelihood ratio favours randomness clearly is a
further span.
Spark functions only; the driver sees two tables of at most 64 x 64 counts.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans
from .common import stored, text_of

KINDS = ["assign", "access", "hex", "random"]
# The patterns of the base kinds.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

TOKEN = "A-Za-z0-9+/_=-"
LEAST_TOKEN, LEAST_WORD = 16, 6
ALPHABET = string.ascii_letters + string.digits + "_"  # every other mark counts as the next symbol
SYMBOLS = len(ALPHABET) + 1
CUT = "\0"  # stands for a base span where ordinary tokens are counted
LEAST_RATIO, LEAST_MEAN = 12.0, 0.5  # of a token, and by character


def base_spans(text: Column) -> Column:
    """The spans of the base kinds; failing matches are dropped and what they covered is not looked at again."""
    assigned = spans.when_any(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), F.filter(
        spans.find(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= 8))
    access = spans.when_any(F.contains(text, F.lit("AKIA")), spans.find(text, ACCESS, 1))
    hexes = spans.when_any(text.rlike(HEX), spans.find(text, HEX, 2))
    return F.concat(assigned, access, hexes)


def token_spans(text: Column) -> Column:
    """Long tokens as spans of the kind ``random``; the ratio alone decides which of them look random."""
    return spans.find(text, rf"{spans.run_start(TOKEN)}[{TOKEN}]{{{LEAST_TOKEN},}}+", 3)


def _without(text: Column, base: Column) -> Column:
    """The text with one mark in place of every base span; spans may overlap."""
    rest = F.aggregate(
        F.array_sort(base), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("kept")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.array_append(acc["kept"], F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))))
            .alias("kept")),
        lambda acc: F.concat(F.array_join(acc["kept"], CUT), F.lit(CUT),
                             F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(base) > 0, rest).otherwise(text)


def ordinary_tokens(text: Column, base: Column) -> Column:
    """Runs of letters, digits and marks that overlap no base span."""
    run = rf"\p{{L}}{TOKEN}"
    pattern = rf"(?<![{CUT}{run}])[{run}]{{{LEAST_WORD},}}+(?!{CUT})"
    return F.regexp_extract_all(_without(text, base), F.lit(pattern), F.lit(0))


def _value(span: Column) -> Column:
    return F.when(span["kind"] == 0, F.regexp_extract(span["match"], ASSIGN, 1)).otherwise(span["match"])


def _codes(word: Column) -> Column:
    """The symbols of a word as numbers; 0 is a mark outside the alphabet."""
    return F.transform(F.split(word, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _steps(word: Column) -> Column:
    """Every step from one symbol to the next as one number."""
    codes = _codes(word)
    return F.zip_with(F.slice(codes, 1, F.length(word) - 1), F.slice(codes, 2, F.length(word) - 1),
                      lambda a, b: a * SYMBOLS + b)


def _counts(words: DataFrame) -> dict[int, int]:
    # Each distinct word is taken apart once.
    distinct = words.where(F.length("word") >= 2).groupBy("word").agg(F.count("*").alias("n"))
    steps = distinct.select(F.explode(_steps(F.col("word"))).alias("step"), "n")
    return {r["step"]: r["n"] for r in steps.groupBy("step").agg(F.sum("n").alias("n")).collect()}


def log_chances(counts: dict[int, int]) -> list[float]:
    """Log chance of each step, smoothed by half a count."""
    totals = [sum(counts.get(a * SYMBOLS + b, 0) for b in range(SYMBOLS)) for a in range(SYMBOLS)]
    return [log((counts.get(a * SYMBOLS + b, 0) + 0.5) / (totals[a] + 0.5 * SYMBOLS))
            for a in range(SYMBOLS) for b in range(SYMBOLS)]


@dataclass
class MarkovModel:
    """Log chance of each step in random strings, its count in ordinary tokens; empty if one side had no samples."""

    random: list[float]
    ordinary: list[int]

    def ratio(self, word: Column) -> Column:
        """Log-likelihood ratio, random against ordinary; the word itself is taken out of the ordinary counts."""
        chances, counts = F.array(*map(F.lit, self.random)), F.array(*(F.lit(n).cast("long") for n in self.ordinary))
        totals = F.array(*(F.lit(sum(self.ordinary[a : a + SYMBOLS])).cast("long")
                           for a in range(0, len(self.ordinary), SYMBOLS)))

        def of_step(acc: Column) -> Column:
            others = F.greatest(F.element_at(counts, acc["step"] + 1) - acc["steps"], F.lit(0))
            return F.when(acc["steps"] > 0, acc["steps"] * (F.element_at(chances, acc["step"] + 1) - F.log(others + 0.5))
                          ).otherwise(0.0)

        def of_symbol(acc: Column) -> Column:
            others = F.greatest(F.element_at(totals, acc["symbol"] + 1) - acc["symbols"], F.lit(0))
            return F.when(acc["symbols"] > 0, acc["symbols"] * F.log(others + 0.5 * SYMBOLS)).otherwise(0.0)

        def add(acc: Column, step: Column) -> Column:
            symbol = F.floor(step / SYMBOLS).cast("int")
            same_step, same_symbol = step == acc["step"], symbol == acc["symbol"]
            return F.struct(
                step.alias("step"), F.when(same_step, acc["steps"] + 1).otherwise(1).alias("steps"),
                symbol.alias("symbol"), F.when(same_symbol, acc["symbols"] + 1).otherwise(1).alias("symbols"),
                (acc["sum"] + F.when(same_step, 0.0).otherwise(of_step(acc))
                 + F.when(same_symbol, 0.0).otherwise(of_symbol(acc))).alias("sum"))

        # In order, equal steps and those from one symbol stand together.
        start = F.struct(*(F.lit(0).alias(n) for n in ("step", "steps", "symbol", "symbols")), F.lit(0.0).alias("sum"))
        return F.aggregate(F.array_sort(_steps(word)), start, add, lambda acc: acc["sum"] + of_step(acc) + of_symbol(acc))

    def added(self, tokens: Column, base: Column) -> Column:
        """The tokens that look random and overlap no base span."""
        if not self.random:
            return spans.none()
        return F.filter(spans.apart(tokens, base), lambda s: self.ratio(s["match"]) >= F.greatest(
            F.lit(LEAST_RATIO), LEAST_MEAN * F.length(s["match"])))


def annotate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, tokens``: base spans and long tokens of every whole text (null: empty)."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), base_spans(text).alias("base"), token_spans(text).alias("tokens"))


def learn(docs: DataFrame, annotated: DataFrame, *, text_col: str = "text") -> MarkovModel:
    """Models of the whole corpus: all its secret values, and all other tokens of its texts."""
    random = annotated.select(F.explode("base").alias("s")).select(_value(F.col("s")).alias("word"))
    text = text_of(text_col)
    ordinary = (docs.select(text.alias("text"), base_spans(text).alias("base"))
                .select(F.explode(ordinary_tokens(F.col("text"), F.col("base"))).alias("word")))
    random_counts, ordinary_counts = _counts(random), _counts(ordinary)
    if not random_counts or not ordinary_counts:
        return MarkovModel([], [])
    return MarkovModel(log_chances(random_counts), [ordinary_counts.get(k, 0) for k in range(SYMBOLS * SYMBOLS)])


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``base`` and ``added`` spans (``start, end, kind, match``) of its whole text.

    Kinds are numbers into ``KINDS``. A null text is empty and has none. Repeated rows give repeated results. An empty
    table gives no rows. Columns other than id and text are not read.
    """
    annotated = stored(annotate(docs, id_col=id_col, text_col=text_col), "secret-spans")
    model = learn(docs, annotated, text_col=text_col)
    return annotated.select(F.col("id").alias(id_col), "base",
                            model.added(F.col("tokens"), F.col("base")).alias("added"))
