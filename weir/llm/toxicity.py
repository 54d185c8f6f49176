"""Toxicity by boosted trees over dense features of a text, with isotonic calibration.

Features: densities and counts of lexicon words and word beginnings, hits only after undoing obfuscation, nearness of hits to
second-person words, shares of capitals, punctuation and obfuscated shapes. The lexicon is learned by Spark from all labelled
rows that neither are held out nor calibrate: words that mark label 1 far beyond chance. The trees are fitted on a sample of
the rows; the calibration gives each class its share among all of them. Labels, language, source and id are never features.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import sieve, stored, text_of

FIT_ROWS = 8000  # at most so many labelled rows are fitted on, a quarter of them with label 1 where there are as many
LEAST_ODDS, LEAST_G2 = 8.0, 20.0
LEXICON_TERMS = 20_000  # of each kind that a model holds at most, those that mark label 1 most surely
NEAR = 5  # words
TOKENS_KEPT = 300_000  # of a worker's memory of tokens; it starts anew beyond, with the same results
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split())
PLAIN = str.maketrans("013457@$!|", "oieastasil")


@dataclass(frozen=True)
class Lexicon:
    words: frozenset
    stems: frozenset  # word beginnings of four or five letters


class Featurizer:
    """Dense features of texts. Each distinct token is looked at once and kept as a byte of flags."""

    NAMES = ("word_share", "words", "stem_share", "stems", "hidden", "second_share", "near_share", "capital_share",
             "marks", "repeated_marks", "odd_shape_share", "length")

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.known = lexicon, {}

    def _flags(self, token: str) -> int:
        word = token.lower().strip("\"'`.,;:!?()[]{}<>*_-~#&%$|/\\")
        # Undoing obfuscation: look-alikes, marks inside the word, letters drawn out.
        plain = re.sub(r"(.)\1{2,}", r"\1", re.sub(r"[^\w]|_", "", word.translate(PLAIN)))
        hit, hidden = word in self.lexicon.words, plain in self.lexicon.words
        stem = any(word[:n] in self.lexicon.stems for n in (4, 5) if len(word) >= n)
        letters = sum(map(str.isalpha, token))
        odd = bool(letters and re.search(r"\w[^\w\s'’.,:;/-]+\w|[^\W\d_]\d+[^\W\d_]|(.)\1{3,}", token))
        return (hit | stem << 1 | (hidden and not hit) << 2 | (word in SECOND_PERSON) << 3
                | (letters > 1 and token.isupper()) << 4 | bool(re.search(r"[!?]{2,}", token)) << 5 | odd << 6)

    def rows(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.NAMES)))
        known = self.known
        for i, text in enumerate(texts):
            tokens = text.split()
            for token in set(tokens).difference(known):
                known[token] = self._flags(token)
            flags = np.frombuffer(bytes(map(known.__getitem__, tokens)), np.uint8)
            n, counts = max(1, len(tokens)), np.bincount(flags, minlength=128)
            by = [int(counts[(np.arange(128) >> b) & 1 == 1].sum()) for b in range(7)]
            near, hits = 0, np.nonzero(flags & 7)[0]
            if len(hits) and by[3]:
                seconds = np.nonzero(flags & 8)[0]
                after = np.searchsorted(seconds, hits)
                gap = np.minimum(np.abs(hits - seconds[np.minimum(after, len(seconds) - 1)]),
                                 np.abs(hits - seconds[np.maximum(after - 1, 0)]))
                near = (gap <= NEAR).mean()
            out[i] = (by[0] / n, np.log1p(by[0]), by[1] / n, np.log1p(by[1]), np.log1p(by[2]), by[3] / n, near, by[4] / n,
                      (text.count("!") + text.count("?")) / n, by[5] / n, by[6] / n, np.log1p(len(tokens)))
            if len(known) > TOKENS_KEPT:
                known.clear()
        return out


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: boosting.Boosted

    def column(self, text_col: str = "text") -> Column:
        """The score of a text, 0 to 1."""
        lexicon, trees = self.lexicon, self.trees

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            featurizer = Featurizer(lexicon)
            for texts in batches:
                yield pd.Series(trees.score(featurizer.rows(texts.to_list())), dtype="float64")

        return score(text_of(text_col))


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Whether a row is kept from all learning: crc32 of the id as text leaves 1 by 3."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def _learn_lexicon(sample: DataFrame, n_zero: int, n_one: int) -> Lexicon:
    """Words and beginnings whose documents have label 1 far more often than chance: odds and a G-test decide."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    stems = F.flatten(F.array(*[
        F.transform(F.filter(words, lambda w, n=n: F.length(w) >= n), lambda w, n=n: F.substring(w, 1, n)) for n in (4, 5)]))
    rows = sample.select("label", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), words.alias("terms")),
        F.struct(F.lit(1).alias("kind"), F.array_distinct(stems).alias("terms")))).alias("part"))
    rows = rows.select("label", "part.kind", F.explode("part.terms").alias("term")).where("term <> ''")
    one, zero = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    n_one, n_zero = max(1, n_one), max(1, n_zero)
    share = n_one / (n_one + n_zero)
    total = F.col("one") + F.col("zero")
    g2 = 2 * (F.col("one") * F.log(F.col("one") / (total * share))
              + F.when(F.col("zero") > 0, F.col("zero") * F.log(F.col("zero") / (total * (1 - share)))).otherwise(0.0))
    odds = ((F.col("one") + 0.5) / (n_one + 1)) / ((F.col("zero") + 0.5) / (n_zero + 1))
    found = stored(rows.groupBy("kind", "term").agg(one.alias("one"), zero.alias("zero"))
                   .where((F.col("one") > 0) & (odds >= LEAST_ODDS) & (g2 >= LEAST_G2)).select("kind", "term", g2.alias("g2")),
                   "toxicity-terms")
    return Lexicon(*(frozenset(r["term"] for r in found.where(F.col("kind") == kind).orderBy(F.desc("g2"), "term")
                               .limit(LEXICON_TERMS).collect()) for kind in (0, 1)))


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """A model from the labelled rows that are not held out.

    All of them count for the lexicon and the shares of the classes, but those that calibrate not for the lexicon, which
    would flatter its words. Trees and calibration take at most ``fit_rows``, chosen by a hash of the id. Labels other
    than 0 and 1 and ids without a document are passed over; an id labelled twice with different labels counts as 1, one
    with several texts by the first of them in order. Without rows of both classes the score is the share of label 1 for every text, or 0.
    """
    marked = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
              .withColumn("turn", F.xxhash64("id")))
    present = stored(docs.select(F.col(id_col).alias("id")).join(marked, "id")
                     .groupBy("id", "label", "turn").agg(F.count("*").alias("copies")), "toxicity-labelled")
    part = lambda label, n: present.where(F.col("label") == label).orderBy("turn", "id").limit(n)
    chosen = stored(part(1, fit_rows // 4).unionByName(part(0, fit_rows - fit_rows // 4))
                    .select("id", "label", (F.pmod("turn", F.lit(4)) == 0).alias("calibrate")), "toxicity-chosen")
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sample = stored(texts.join(F.broadcast(chosen), "id").groupBy("id", "label", "calibrate").agg(F.min("text").alias("text"))
                    .select("text", "label", "calibrate"), "toxicity-sample")

    sizes = {r["label"]: r for r in present.groupBy("label").agg(
        F.count("*").alias("n"), F.max("copies").alias("copies")).collect()}
    totals = tuple(sizes[k]["n"] if k in sizes else 0 for k in (0, 1))
    apart = {r["label"]: r["count"] for r in chosen.where("calibrate").groupBy("label").count().collect()}
    counts = present.join(F.broadcast(chosen.where("calibrate").select("id")), "id", "left_anti").select("id", "label")
    # The same plan at every size: labelled texts meet their labels by a shuffle of their own.
    counted = sieve(texts, counts, "id").join(counts.hint("shuffle_merge"), "id")
    if any(r["copies"] > 1 for r in sizes.values()):
        counted = counted.groupBy("id", "label").agg(F.min("text").alias("text"))
    lexicon = _learn_lexicon(counted, *(totals[k] - apart.get(k, 0) for k in (0, 1)))

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(Featurizer(lexicon).rows(texts.to_list())))

    rows = sample.select(features("text").alias("x"), "label", "calibrate").collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(Featurizer.NAMES))
    y, hold = (np.array([r[c] for r in rows], float) for c in ("label", "calibrate"))
    return ToxicityModel(lexicon, boosting.fit(x, y, hold, totals=totals))


def score_toxicity(docs: DataFrame, model: ToxicityModel, name: str = "score", *, text_col: str = "text") -> DataFrame:
    """The rows with the score of their whole text in column ``name``; a column of that name is replaced.

    A null text counts as empty and is scored like any other. Repeated rows get equal scores. Other columns pass as is.
    """
    return docs.withColumn(name, model.column(text_col))
