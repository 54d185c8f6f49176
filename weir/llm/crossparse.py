"""Language of a text by cross-parsing: the language whose labelled text explains it in the fewest normalised phrases.

Each language has a suffix automaton of a bounded sample of its labelled text. A text is cut greedily into phrases, each the
longest match in that sample (or one byte that it lacks). A phrase costs the logarithm of the sample's length, as a
pointer into it would, so the entropy estimate in bits a byte is ``phrases * log2(length) / bytes``; the language with the
least wins. Letters are lower case, whatever is no letter or mark counts as one blank, and the rest is parsed as UTF-8, so no
script needs a large alphabet. Texts are parsed in blocks, all blocks of a batch and all languages side by side, a byte a step.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

UNDEFINED = "und"
FIT_BYTES = 40_000  # of labelled text a language is learned from, at most
FIT_TOTAL = 240_000  # of all languages together, at most (one each where there are more languages)
SLICE = 1_000  # characters of one document, from a place its hash names
BLOCK = 2_048  # bytes parsed in one go; each block starts a phrase
LANES = 32_768  # blocks parsed side by side
EVIDENCE = 32  # bytes by which the score weighs differences in bits a byte


class Characters:
    """What becomes of each code point; pages of 256 are filled in when a text has one of their points."""

    def __init__(self):
        self.known = np.zeros(0x1100, bool)
        self.kept = np.full(0x110000, 32, np.uint32)  # its lower case, 32 where it is neither letter nor mark
        self.letter = np.zeros(0x110000, bool)

    def points(self, text: str) -> np.ndarray:
        out = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        for page in np.unique((out >> 8)[~self.known[out >> 8]]):
            self.known[page] = True
            for i in range(int(page) << 8, int(page) + 1 << 8):
                kind = unicodedata.category(chr(i))[0]
                if kind in "LM":
                    low = chr(i).lower()
                    self.kept[i] = ord(low) if len(low) == 1 else i
                    self.letter[i] = kind == "L"
        return out

    def normal(self, points: np.ndarray) -> np.ndarray:
        """UTF-8 of lower case letters and marks, anything between them as one blank, none at the ends."""
        kept = self.kept[points]
        word = kept != 32
        kept = kept[word | np.append(False, word[:-1])[: len(word)]]
        kept = kept[:-1] if len(kept) and kept[-1] == 32 else kept
        text = kept.tobytes().decode("utf-32-le", "surrogatepass")
        return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def automaton(codes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of the suffix automaton of ``codes`` from state 0: from, code, to. Negative codes part the text: no match spans one."""
    steps, link, longest, last = [{}], [-1], [0], 0
    for c in codes:
        if c < 0:
            last = 0
            continue
        known = steps[last].get(c)
        if known is not None:  # as happens behind a part: the longer text is known already, or its state is split
            if longest[known] == longest[last] + 1:
                last = known
            else:
                last = _split(steps, link, longest, last, known, c)
            continue
        new = len(steps)
        steps.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            link[new] = q if longest[q] == longest[p] + 1 else _split(steps, link, longest, p, q, c)
        last = new
    sizes = np.fromiter(map(len, steps), np.int64, len(steps))
    return (np.repeat(np.arange(len(steps), dtype=np.int32), sizes),
            np.array([c for s in steps for c in s], np.int32), np.array([t for s in steps for t in s.values()], np.int32))


def _split(steps: list, link: list, longest: list, p: int, q: int, c: int) -> int:
    twin = len(steps)
    steps.append(dict(steps[q]))
    longest.append(longest[p] + 1)
    link.append(link[q])
    link[q] = twin
    while p >= 0 and steps[p].get(c) == q:
        steps[p][c] = twin
        p = link[p]
    return twin


@dataclass
class LanguageModel:
    """The automata of all languages, as edges; tasks lay them out as one table."""

    names: list[str]  # in order
    lengths: np.ndarray  # bytes of each sample
    edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next place by place and code, as ``~place`` where a phrase starts with that code; the roots; each byte's code.

        A place is a state's row times the number of codes. Code 0 stands for bytes no sample holds.
        """
        seen = np.unique(np.concatenate([code for _, code, _ in self.edges]))
        codes = np.zeros(256, np.int32)
        codes[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        states = np.array([int(to.max()) + 1 for _, _, to in self.edges], np.int64)
        roots = np.cumsum(states) - states
        out = np.empty((int(states.sum()), width), np.int32)
        for root, size, (start, byte, to) in zip(roots, states, self.edges):
            part, code, first = out[root : root + size], codes[byte], start == 0
            ahead = np.full(width, root * width)  # a byte the sample lacks is a phrase by itself
            ahead[code[first]] = (root + to[first]) * width
            part[:] = ~ahead
            part[start[~first], code[~first]] = (root + to[~first]) * width
        return out.reshape(-1), (roots * width).astype(np.int32), codes

    def best(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the language with the least bits a byte, first one in ties, and its score.

        The score is its share of the weights 2 ** (-bits a byte * EVIDENCE).
        """
        bits = phrases * np.log2(self.lengths + 1.0) / np.maximum(sizes, 1)[:, None]
        least = bits.min(axis=1, keepdims=True)
        return bits.argmin(axis=1), 1 / np.exp2((least - bits) * EVIDENCE).sum(axis=1)

    def column(self, text_col: str = "text") -> Column:
        """``struct<lang_pred, score>`` of a text."""
        model = self

        @F.pandas_udf("lang_pred string, score double")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            parser, characters = Parser(model) if model.names else None, Characters()
            for texts in batches:
                yield _predicted(parser, characters, texts)

        return predict(text_of(text_col))


class Parser:
    """Counts phrases of texts in every language of a model."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.table, self.roots, self.code = model.table()

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts by languages; the texts are normal."""
        total = np.zeros((len(texts), len(self.roots)), np.int64)
        lengths = np.array([len(t) for t in texts], np.int64)
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        starts = (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
        codes = self.code[np.concatenate([*texts, np.zeros(0, np.uint8)])]
        begin = starts + (np.cumsum(lengths) - lengths)[owner]
        size = np.minimum(lengths[owner] - starts, BLOCK)
        by_size = np.argsort(-size, kind="stable")
        for first in range(0, len(by_size), LANES):
            part = by_size[first : first + LANES]
            np.add.at(total, owner[part], self._count(codes, begin[part], size[part]))
        return total

    def _count(self, codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each block, the longest block first."""
        ends = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0])), side="right")
        at = np.repeat(self.roots[:, None], len(size), 1)
        count = np.zeros(at.shape, np.int32)
        for step, alive in enumerate(ends):
            after = self.table[at[:, :alive] + codes[begin[:alive] + step]]
            count[:, :alive] += after < 0
            at[:, :alive] = np.where(after < 0, ~after, after)
        return count.T


def _predicted(parser: Parser | None, characters: Characters, texts: pd.Series) -> pd.DataFrame:
    points = [characters.points(t) for t in texts]
    some = np.array([characters.letter[p].any() for p in points], bool) & (parser is not None)
    out = pd.DataFrame({"lang_pred": UNDEFINED, "score": 0.0}, index=range(len(points)))
    if some.any():
        plain = [characters.normal(points[i]) for i in np.nonzero(some)[0]]
        place, score = parser.model.best(parser.phrases(plain), np.array([len(p) for p in plain]))
        out.loc[some, "lang_pred"] = np.array(parser.model.names, object)[place]
        out.loc[some, "score"] = score
    return out


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Whether a row is kept from all learning: crc32 of the id as text leaves 1 by 3."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          fit_bytes: int = FIT_BYTES, fit_total: int = FIT_TOTAL) -> LanguageModel:
    """A model from the rows with a language that are not held out.

    Each language gets at most ``fit_bytes`` bytes (fewer where ``fit_total`` does not reach for all): one slice
    of each of the texts with the smallest hashes, equal texts once. Languages whose texts hold no letter are not learned.
    """
    text = text_of(text_col)
    marked = docs.where(F.col(lang_col).isNotNull() & ~held_out(id_col)).select(F.col(lang_col).alias("lang"), text.alias("text"))
    marked = marked.where(F.col("text").rlike(r"\p{L}"))
    per_text = F.least(F.length("text"), F.lit(SLICE))
    sizes = stored(marked.groupBy("lang").agg(F.sum(per_text).alias("n")), "langid-sizes")
    share = max(1, min(fit_bytes, fit_total // max(1, sizes.count())))
    # Hashes below a border give about three times the text wanted, so copies may go.
    turn = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    at = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - SLICE + 1, F.lit(1)).cast("long")).cast("int")
    borders = sizes.select("lang", ((F.lit(3.0 * share) / F.col("n") + F.lit(20.0 * SLICE) / F.col("n")) * (1 << 40)).alias("border"))
    chosen = (marked.withColumn("turn", turn).join(borders, "lang").where(F.col("turn") < F.col("border"))
              .select("lang", "turn", F.substring("text", at + 1, F.lit(SLICE)).alias("part"))
              .groupBy("lang", "turn").agg(F.min("part").alias("part")))

    def build(key, rows):
        parts, left, characters = [], share, Characters()
        for r in rows.select(["turn", "part"]).sort_by("turn").column("part").to_pylist():
            plain = characters.normal(characters.points(r))[:left]
            left -= len(plain)
            parts += [plain.astype(np.int64), [-1]]
            if not left:
                break
        whole = np.concatenate(parts).astype(np.int64)
        edges = automaton(whole.tolist()) if share - left else [np.zeros(0, np.int32)] * 3
        return pa.table({"lang": [key[0].as_py()], "n": [share - left], **{
            name: pa.array([e.tobytes()], pa.binary()) for name, e in zip(("start", "code", "to"), edges)}})

    built = chosen.groupBy("lang").applyInArrow(build, "lang string, n long, start binary, code binary, to binary")
    rows = sorted((r for r in built.collect() if r["n"]), key=lambda r: r["lang"])
    return LanguageModel([r["lang"] for r in rows], np.array([r["n"] for r in rows], float),
                         [tuple(np.frombuffer(r[c], np.int32) for c in ("start", "code", "to")) for r in rows])


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` of their whole text; columns of these names are replaced.

    A text that is null or holds no letter is ``und`` with score 0, and so is every text where no language was learned.
    Equal texts get equal answers. Other columns, null and repeated ids pass as they are; an empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "__found")]
    found = docs.withColumn("__found", model.column(text_col))
    return found.select(*names, F.col("__found.lang_pred").alias("lang_pred"), F.col("__found.score").alias("score"))
