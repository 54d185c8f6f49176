"""Periodic runs against plain comparison of all periods, and the digest against its definition."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from weir.llm import periodic


def plain_runs(words, least=24, exponent=3):
    """Every period by itself; a stretch counts with its smallest one."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        same = [False, *(words[i] == words[i + q] for i in range(n - q)), False]
        first = None
        for i, s in enumerate(same):
            if s and first is None:
                first = i - 1
            elif not s and first is not None:
                run = (first, i - 1 - first + q)
                if run[1] >= max(least, exponent * q):
                    out.setdefault(run, q)
                first = None
    return sorted((s, length, q) for (s, length), q in out.items())


def some_words(rng):
    letters = rng.choice(["0", "01", "012", "abcdefghijklmnop"])
    words = rng.choices(letters, k=rng.randint(0, 130))
    for _ in range(rng.randint(0, 3)):
        at, root = rng.randint(0, max(0, len(words) - 1)), rng.choices("xy0", k=rng.randint(1, 14))
        part = words[at : at + rng.randint(1, 70)]
        words[at : at + len(part)] = [root[i % len(root)] for i in range(len(part))]
    return words


def test_runs_are_those_of_plain_comparison():
    rng, found = random.Random(1), 0
    for _ in range(1500):
        words = some_words(rng)
        want = plain_runs(words)
        got = [tuple(r) for r in periodic.runs([w.encode() for w in words]).tolist()]
        assert sorted(got) == want and got == sorted(got, key=lambda r: (r[0], r[2]))
        found += len(want)
    assert found > 300


@pytest.mark.parametrize("least, exponent", [(2, 2), (6, 3)])
def test_all_runs_of_a_stretch(least, exponent):
    rng = random.Random(least)
    for _ in range(400):
        words = [ord(w) for w in some_words(rng)]
        if words:
            got = periodic.runs_of_stretch(np.array(words), least, exponent)
            assert sorted(map(tuple, got.tolist())) == plain_runs(words, least, exponent)


def test_suffixes_come_in_order():
    rng = random.Random(9)
    for _ in range(100):
        s = [*rng.choices([1, 2, 3], k=rng.randint(0, 40)), 0]
        order, depths = periodic.suffix_order(s)
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        for k in range(1, len(s)):
            a, b = s[order[k - 1]:], s[order[k]:]
            assert depths[k] == next(d for d in range(len(s)) if a[d] != b[d])


def contract(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(s, q, length) for s, length, q in plain_runs(words)]
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in sorted(runs))
    return (len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else [None] * 4),
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_digest(spark):
    rng = random.Random(4)
    tens = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, "  ".join(some_words(rng)) + "\n", "x") for i in range(60)]
    rows += [(i, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 300))), "x") for i in tens[:25]]
    rows += [(tens[30], "", "x"), (tens[31], None, "x"), (tens[32], " \t", "x"), (tens[33], "one", "x"), (9001, None, "x"),
             (9002, "a b c " * 30, "x"), (9003, "a\x0bb\x0cc\rd " * 40, "x"), (9004, "ä ö " * 5000, "x"),
             (9005, "same words here " * 20, "x"), (9005, "same words here " * 20, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = periodic.find_runs(periodic.repeat_tails(df)).select("doc_id", *periodic.digest()).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *contract(i, t)) for i, t, _ in rows), key=str)
    assert sum(r.n_runs > 0 for r in got) > 20


def test_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "z " * 30), (None, "z " * 30), (None, None)], "doc_id long, text string")
    got = periodic.find_runs(periodic.repeat_tails(df)).collect()
    assert sorted((r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [
        (0, [], ""), (30, [(0, 30, 1)], "z"), (30, [(0, 30, 1)], "z")]
    assert periodic.find_runs(periodic.repeat_tails(df.limit(0))).count() == 0
