"""Languages by cross-parsing: phrases against plain search, accuracy on rows kept from learning, awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.llm import crossparse


def plain(text):
    characters = crossparse.Characters()
    return characters.normal(characters.points(text))


def phrases(train: list[bytes], text: bytes, block: int) -> int:
    """Greedy longest matches by substring search."""
    count = 0
    for start in range(0, len(text), block):
        part, i = text[start : start + block], 0
        while i < len(part):
            j = i + 1
            while j < len(part) and any(part[i : j + 1] in t for t in train):
                j += 1
            i, count = j, count + 1
    return count


@pytest.mark.parametrize("block", [7, 50, 2048])
def test_phrases_are_longest_matches(monkeypatch, block):
    monkeypatch.setattr(crossparse, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(15):
        trains = [[plain("".join(rng.choices("abcé", k=rng.randint(1, 60)))).tobytes() for _ in range(rng.randint(1, 4))]
                  for _ in range(3)]
        edges = [crossparse.automaton([c for t in train for c in [*t, -1]]) for train in trains]
        model = crossparse.LanguageModel(["x", "y", "z"], np.array([9.0, 9.0, 9.0]), edges)
        texts = [plain("".join(rng.choices("abcéd .", k=rng.randint(0, 300)))) for _ in range(10)]
        got = crossparse.Parser(model).phrases(texts)
        assert got.tolist() == [[phrases(train, t.tobytes(), block) for train in trains] for t in texts]


def test_an_automaton_knows_every_part_and_nothing_else():
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab", k=12)) for _ in range(4)]
    start, code, to = crossparse.automaton([c for t in texts for c in [*t.encode(), -1]])
    step = {(s, chr(c)): t for s, c, t in zip(start.tolist(), code.tolist(), to.tolist())}

    def known(word):
        state = 0
        for c in word:
            state = step.get((state, c))
            if state is None:
                return False
        return True

    for n in range(1, 9):
        for k in range(1 << n):
            word = format(k, f"0{n}b").translate(str.maketrans("01", "ab"))
            assert known(word) == any(word in t for t in texts)


def test_normal_text():
    assert plain("  Ça VA, n'est-ce pas?! 42́ ").tobytes().decode() == "ça va n est ce pas ́"
    assert plain("12 34").size == 0 and plain("").size == 0
    assert plain("中文 ÄÖ").tobytes().decode() == "中文 äö"


LANGS = {"aa": "lorem ipsum dolor sit amet consectetur adipiscing elit".split(),
         "bb": "der hund lief schnell über die große wiese und bellte".split(),
         "cc": "こんにちは 世界 私 は 猫 が 好き です".split()}


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(5), []
    for i in range(240):
        lang = sorted(LANGS)[i % 3]
        rows.append((i, " ".join(rng.choices(LANGS[lang], k=rng.randint(3, 400))), lang, "s", 1.0))
    rows += [(500, None, "aa", "s", 1.0), (501, "", "bb", "s", 1.0), (502, "123 !!! 4", "cc", "s", 1.0), (503, "hund", None, "s", 1.0),
             (None, "lorem ipsum", "aa", "s", 1.0), (None, "lorem ipsum", "aa", "s", 1.0), (504, "x" * 300_000, None, "s", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")


def test_held_out_rows_are_told_and_odd_ones_defined(docs):
    model = crossparse.learn(docs)
    assert model.names == ["aa", "bb", "cc"]
    got = crossparse.identify(docs, model)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == docs.count()
    rows = got.collect()
    assert all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in rows if r.doc_id is not None and r.doc_id < 240)
    by_id = {r.doc_id: r for r in rows}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (500, 501, 502))
    assert by_id[503].lang_pred == "bb" and by_id[504].lang_pred in model.names
    assert [r.lang_pred for r in rows if r.doc_id is None] == ["aa", "aa"]


def test_labels_of_held_out_rows_and_ids_change_nothing(docs):
    wrong = docs.withColumn("lang", F.when(crossparse.held_out(), "zz").otherwise(F.col("lang")))
    one, other = crossparse.learn(docs), crossparse.learn(wrong)
    assert one.names == other.names and all(
        np.array_equal(x, y) for a, b in zip(one.edges, other.edges) for x, y in zip(a, b))


def test_nothing_to_learn(docs):
    model = crossparse.learn(docs.where("lang = 'zz'"))
    assert model.names == []
    assert {(r.lang_pred, r.score) for r in crossparse.identify(docs, model).collect()} == {("und", 0.0)}
    assert crossparse.identify(docs.limit(0), crossparse.learn(docs)).count() == 0


def test_the_sample_is_bounded(docs):
    model = crossparse.learn(docs, fit_bytes=500, fit_total=900)
    assert model.lengths.max() <= 300


def test_accuracy_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = crossparse.identify(docs, crossparse.learn(docs)).where(crossparse.held_out())
    assert got.where("lang = lang_pred").count() / got.count() > 0.98
