"""Personal data in texts: fixed patterns, and candidates that boosted trees accept by format and context.

High-recall generators propose overlapping spans. Candidates that overlap a base span are the positive examples, all
others the negative ones; trees over format and context features, calibrated on examples of their own, select further
spans. Finding and scoring use Spark functions only; the driver fits the trees on a bounded sample of feature rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting, spans
from .common import stored, text_of

KINDS = ["email", "ip", "card", "phone", "other"]
FIT_CANDIDATES = 10_000  # at most so many candidates are fitted on, chosen by a hash
LEAST_CHANCE = 0.9
CONTEXT = 40  # characters before a candidate
HINTS = r"(?i)\b(?:phone|tel|mobile|call|fax|mail|card|visa|account|iban|ssn|passport|address|ip|host)\b"

# Stand-ins that keep the length of a text: a dot between two parts of a name, a separator between two digits.
DOT, SEPARATOR, SPARE = chr(0xE000), chr(0xE001), chr(0xE002)  # private-use characters
LOCAL = rf"A-Za-z0-9._%+{DOT}-"
EMAIL = rf"{spans.run_start(LOCAL)}[{LOCAL}]++@(?=[A-Za-z0-9-]++{DOT})[A-Za-z0-9{DOT}-]++"
IP = rf"{spans.run_start('0-9')}[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
CARD = rf"[0-9][0-9{SEPARATOR}]{{11,}}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Generators: tokens with a digit, groups of digits, names at hosts however spelt, account and network numbers.
GENERATORS = {
    "token": r"(?<!\S)(?=[^\s0-9]*+[0-9])\S{6,}+",
    "digits": rf"{spans.run_start('0-9')}[(+]?[0-9][0-9 ().+/-]{{5,}}[0-9]",
    "name": (rf"{spans.run_start('A-Za-z0-9._%+-')}[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?"
             r"[A-Za-z0-9-]++ ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z]{2,}+"),
    "network": rf"{spans.run_start('0-9A-Fa-f:')}[0-9A-Fa-f]{{1,4}}:[0-9A-Fa-f:]{{6,}}+",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    def worth(c, i):
        n = c.cast("int") * (i % 2 + 1)
        return n - F.when(n > 9, 9).otherwise(0)

    values = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def ip_in_range(match: Column) -> Column:
    return match.rlike(rf"^{IP_PART}\.{IP_PART}\.{IP_PART}\.{IP_PART}$")


def base_spans(text: Column) -> Column:
    """The spans of the base kinds; failing matches are dropped and what they covered is not looked at again."""
    dotted = F.regexp_replace(F.translate(text, DOT, SPARE), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
    email = F.transform(spans.find(dotted, EMAIL, 0), lambda s: s.withField("match", F.translate(s["match"], DOT, ".")))
    ip = F.filter(spans.find(text, IP, 1), lambda s: ip_in_range(s["match"]))
    joined = F.regexp_replace(F.translate(text, SEPARATOR, SPARE), r"(?<=[0-9])[ -](?=[0-9])", SEPARATOR)
    card = F.filter(spans.find(joined, CARD, 2),
                    lambda s: F.length(_digits(s["match"])).between(12, 19) & luhn(_digits(s["match"])))
    phone = F.filter(spans.find(text, PHONE, 3), lambda s: F.length(_digits(s["match"])).between(9, 15))
    return F.concat(
        spans.when_any(F.contains(text, F.lit("@")), email),
        spans.when_any(text.rlike(r"[0-9]\.[0-9]"), ip),
        spans.when_any(text.rlike(r"[0-9](?:[ -]?[0-9]){11}"), card),
        spans.when_any(F.contains(text, F.lit("+")), phone))


def candidates(text: Column) -> Column:
    """Spans of all generators; ``kind`` is the generator's number. They may overlap."""
    numbers = text.rlike("[0-9]")
    found = [spans.find(text, pattern, k) for k, pattern in enumerate(GENERATORS.values())]
    named = F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]")
    return F.concat(spans.when_any(numbers, F.concat(found[0], found[1], found[3])), spans.when_any(named, found[2]))


FEATURES = ["length", "digits", "letters", "groups", "dots", "at", "plus", "luhn", "in_range", "colons", "upper", "hint",
            "generator"]


def features(text: Column, span: Column) -> list[Column]:
    """Numbers for a candidate's format and context, in the order of ``FEATURES``."""
    match = span["match"]
    digits = _digits(match)
    before = F.substring(text, F.greatest(F.lit(1), span["start"] + 1 - CONTEXT), F.least(F.lit(CONTEXT), span["start"]))
    count = lambda pattern: F.regexp_count(match, F.lit(pattern))
    flag = lambda condition: F.when(condition, 1).otherwise(0)
    return [c.cast("double") for c in (
        F.length(match), F.length(digits), count(r"\p{L}"), count("[0-9]+"), count(r"\.|dot"), count("@|[(\\[]at[)\\]]"),
        flag(F.startswith(match, F.lit("+"))), flag(F.length(digits).between(12, 19) & luhn(digits)),
        flag(ip_in_range(F.regexp_replace(match, r"[.,;:!?)]+$", ""))), count(":"), count(r"\p{Lu}"),
        flag(before.rlike(HINTS)), span["kind"])]


def annotate(docs: DataFrame, name: str, *, text_col: str = "text") -> DataFrame:
    """The rows with a struct ``name``: ``base`` spans, and ``proposed`` candidates with features ``x`` and ``known``."""
    text = text_of(text_col)
    work = docs.withColumn(name, F.struct(base_spans(text).alias("base"), candidates(text).alias("proposed")))
    base = F.col(name)["base"]
    proposed = F.transform(F.col(name)["proposed"], lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"),
        F.array(*features(text, s)).alias("x"),
        F.exists(base, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])).alias("known")))
    return work.withColumn(name, F.struct(base.alias("base"), proposed.alias("proposed")))


@dataclass
class PiiModel:
    trees: boosting.Boosted

    def added(self, found: Column) -> Column:
        """The accepted candidates that overlap no base span, and of overlapping ones the likeliest, then the first."""
        scored = F.transform(F.filter(found["proposed"], lambda s: ~s["known"]), lambda s: F.struct(
            self.trees.margin_column([F.get(s["x"], F.lit(i)) for i in range(len(FEATURES))]).alias("margin"),
            s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match")))
        good = F.filter(scored, lambda s: self.trees.chance_column(s["margin"]) >= LEAST_CHANCE)
        # Each span stands against the best, so no two that overlap are kept.
        kept = F.aggregate(
            F.array_sort(good, lambda a, b: F.when(a["margin"] > b["margin"], -1).when(a["margin"] < b["margin"], 1)
                         .otherwise(a["start"] - b["start"])),
            spans.none(),
            lambda acc, s: F.when(
                F.exists(acc, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])), acc,
            ).otherwise(F.array_append(acc, F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(len(KINDS) - 1).alias("kind"),
                s["match"].alias("match")))))
        return kept


def learn(annotated: DataFrame, name: str, *, fit_candidates: int = FIT_CANDIDATES) -> PiiModel:
    """Trees from at most ``fit_candidates`` candidates, half of them overlapping base spans where there are as many.

    With candidates of one kind only nothing can be told apart and no span is added.
    """
    rows = (annotated.select(F.explode(F.col(name)["proposed"]).alias("s")).select("s.x", "s.known", "s.match")
            .withColumn("turn", F.xxhash64("match", "x")))
    part = lambda known: rows.where(F.col("known") == known).orderBy("turn").limit(fit_candidates // 2)
    got = part(True).unionByName(part(False)).select("x", "known", F.pmod("turn", F.lit(4)).alias("quarter")).collect()
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES))
    y, hold = np.array([r["known"] for r in got], float), np.array([r["quarter"] == 0 for r in got])
    model = boosting.fit(x, y, hold, trees=15)
    return PiiModel(model if model.chances is not None else boosting.Boosted(0.0))


def find_personal(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``base`` and ``added`` spans (``start, end, kind, match``) of its whole text.

    Kinds are numbers into ``KINDS``. A null text is empty and has none. Repeated rows give repeated results. An empty
    table gives no rows. Columns other than id and text are not read.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    annotated = stored(annotate(narrow, "found").select("id", "found"), "pii-spans")
    model = learn(annotated, "found")
    return annotated.select(F.col("id").alias(id_col), F.col("found.base").alias("base"),
                            model.added(F.col("found")).alias("added"))


def redact(docs: DataFrame, *, text_col: str = "text", mask: str = "<{}>") -> DataFrame:
    """The rows with every span of the text, base or added, replaced by its kind in the mask.

    Overlapping spans are replaced together, under the kind of the first. A null text stays null; all else passes as is.
    """
    model = learn(annotate(docs.select(F.col(text_col).alias("text")), "found").select("found"), "found")
    name = "__pii__"
    found = annotate(docs, name, text_col=text_col).withColumn(
        name, F.concat(F.col(name)["base"], model.added(F.col(name))))
    names = F.array(*[F.lit(mask.format(k)) for k in KINDS])
    text = text_of(text_col)
    ordered = F.array_sort(F.transform(F.col(name), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    parts = F.aggregate(
        ordered, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))).otherwise(F.struct(
                s["end"].alias("at"),
                F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                                               F.element_at(names, s["kind"] + 1))).alias("parts"))),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    clean = F.when(F.size(name) > 0, parts).otherwise(F.col(text_col))
    return found.withColumn(text_col, clean).drop(name)
