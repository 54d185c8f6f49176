"""Each corpus operator against a plain form of itself on small tables with the awkward cases."""

import hashlib
import heapq
import math
import re
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from weir.llm import dart_minhash, mixing, neighbours, packing, pii, secret_scan, sharding, suffixes, topk, toxicity  # noqa: E402

DOCS = "doc_id long, text string, source string, key string, score double"  # names the operators use inside, too
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def words(n, seed, size=400):
    rng = np.random.default_rng(seed)
    return " ".join("w" + np.base_repr(int(x), 36).lower() for x in rng.integers(0, size * size, n))


@pytest.fixture(scope="module")
def rows():
    base = words(120, 1)
    near = base.split()
    near[60] = "changed"
    texts = [base, " ".join(near), base, None, "", "", "!!!", "two words", words(3000, 2), words(90, 3), base.upper(),
             "ä ö ü " + words(60, 4), words(50, 5) + " " + base, words(50, 6)]
    return [(i, t, f"s{i % 3}" if i % 5 else None, "x", 1.0) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_sharding(docs, rows, empty):
    got = sharding.lpt_shards(docs, 4).collect()
    assert len(got) == len(rows)
    shard = {r.doc_id: r.shard for r in got}
    assert shard[0] == shard[2] and shard[4] == shard[5]
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.doc_id: r.size for r in got} == {r[0]: len((r[1] or "").encode()) + 1 for r in rows}
    assert all(r.text_crc32 == zlib.crc32((rows[r.doc_id][1] or "").encode()) for r in got)
    assert sharding.lpt_shards(empty).count() == 0


def test_longest_first():
    sizes = {k: int(v) for k, v in enumerate(np.random.default_rng(0).integers(1, 1000, 300))}
    loads = [0] * 7
    for item, shard in sharding.longest_first(sizes, 7).items():
        loads[shard] += sizes[item]
    assert max(loads) - min(loads) <= max(sizes.values())
    heap = [0] * 7
    for size in sorted(sizes.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    assert sorted(heap) == sorted(loads)


@pytest.mark.parametrize("weights", [{1: 3, 2: 5, 3: 1}, {1: 1}, {1: 7, 2: 7}, {1: 500, 2: 1, 3: 499}])
def test_schedule_keeps_weights(weights):
    length = sum(weights.values())
    slots = mixing.one_period(weights)
    assert sorted(x for s in slots.values() for x in s) == list(range(length))
    for source, own in slots.items():
        for k, slot in enumerate(own):
            assert k * length // weights[source] <= slot < math.ceil((k + 1) * length / weights[source])


def test_mixing(docs, rows, empty):
    got = mixing.mix(docs, {"s0": 2, "s1": 1}, block_bytes=200, name="score").collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    assert all(r.score.release <= r.score.slot < r.score.deadline for r in got)
    kind = {r.doc_id: r.source if r.source in ("s0", "s1") else "rest" for r in got}
    seen = {}
    for r in got:  # a slot belongs to one block of one source
        assert seen.setdefault(r.score.slot, (kind[r.doc_id], r.score.block)) == (kind[r.doc_id], r.score.block)
    assert mixing.in_mixed_order(mixing.mix(empty)).count() == 0


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer, capacity = Tokenizer.from_file(TOKENIZER), 512
    got = packing.pack(docs, TOKENIZER, capacity=capacity).collect()
    for doc, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.piece)
        parts = [ids[i : i + capacity] for i in range(0, len(ids), capacity)]
        assert [(r.start, r.length, r.ids_crc32) for r in own] == [
            (i * capacity, len(p), zlib.crc32(p.tobytes())) for i, p in enumerate(parts)]
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_encoder_is_exact():
    texts = ["a<|endoftext|>b <|ENDOFTEXT|> X", "", "  x y", "ΣΑΣ Σ.", "it's IT'S don't, we'll.", "İstanbul, ﬁn. é, ́.",
             "tab\tx\r\ny  z", "日本語。テスト 12,345.67, a., b.,", "École ÀÉÎ, ª º µ ÿ Straße.",
             "one$$$ Two.%%% dogs' 'quoted' end'. it's! x_ _x a|> b<|c> d<| e!?« f´, ...", "$$$ ONE$$$ one,& é&&& É!! Ω!! ñ''"]
    encoder = packing.WordEncoder(TOKENIZER)
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert got == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_best_fit_matches_one_by_one():
    counts = {int(k): int(v) for k, v in zip(*np.unique(np.random.default_rng(3).integers(1, 65, 500), return_counts=True))}
    moves = packing.best_fit(counts, 64)
    assert {n: sum(m[2] for m in moves if m[0] == n) for n in counts} == counts
    bins = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [i for i, gap in enumerate(bins) if gap >= n]
        if fits:
            bins[min(fits, key=bins.__getitem__)] -= n
        else:
            bins.append(64 - n)
    assert 1 + max(m[3] + m[2] - 1 for m in moves) == len(bins)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(rng.normal(size=(400, 16)))]
    data += [(400 + i, data[0][1]) for i in range(30)]  # ties
    data += [(500, None), (501, [float("nan")] + [1.0] * 15), (502, [None] + [1.0] * 15), (503, [0.0] * 16), (504, []),
             (505, [1.0, 2.0]), (None, [1.0] * 16), (3, data[3][1])]
    return spark.createDataFrame([(i, v, "c") for i, v in data], "vec_id long, embedding array<float>, vec string"), {
        i: np.array(v) for i, v in data if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all()}


def test_nearest(vectors):
    df, exact = vectors
    got = {}
    for r in neighbours.nearest(df, F.col("id") % 10 == 0, 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    exact = {i: v for i, v in exact.items() if v.any()}
    hit = total = 0
    for q in (i for i in exact if i % 10 == 0):
        cos = {i: float(v @ exact[q] / np.linalg.norm(v) / np.linalg.norm(exact[q])) for i, v in exact.items() if i != q}
        best = sorted(cos, key=lambda i: (-round(cos[i], 12), i))[:5]
        assert [x[0] for x in sorted(got[q])] == [1, 2, 3, 4, 5]
        assert all(abs(cos[i] - s) < 1e-12 for _, i, s in got[q])
        hit, total = hit + len({x[1] for x in got[q]} & set(best)), total + 5
    assert hit >= 0.9 * total
    assert neighbours.nearest(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_top_products(vectors):
    df, exact = vectors
    whole = {i: np.floor(64 * v).astype(int) for i, v in exact.items()}
    got = {}
    for r in topk.top_products(df, F.col("id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (i for i in whole if i % 20 == 0):
        best = sorted(((-int(v @ whole[q]), i) for i, v in whole.items() if i != q))[:20]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


def test_near_duplicates(docs, rows, empty):
    got = {r.doc_id: r.class_id for r in dart_minhash.near_duplicates(docs).collect()}
    assert len(got) == len(rows)
    classes = [{i for i in got if got[i] == c} for c in set(got.values())]
    assert {0, 1, 2, 10} in classes and {3, 4, 5} in classes and {6} in classes and {12} in classes
    assert dart_minhash.near_duplicates(empty).count() == 0
    kept = dart_minhash.keep_first(docs, dart_minhash.near_duplicates(docs))
    assert kept.columns == docs.columns and kept.count() == len(classes)


@pytest.mark.parametrize("weighted", [False, True])
def test_blocks_connect_the_classes_that_all_pairs_connect(weighted):
    import pyarrow as pa

    rng = np.random.default_rng(11)
    bases = [np.unique(rng.integers(0, 2**63, 60).astype(np.uint64)) for _ in range(4)]
    sets = [np.sort(rng.choice(bases[k % 4], 50 + k % 9, replace=False)) for k in range(60)]
    counts = [rng.integers(1, 3, len(x)).astype(np.int32) for x in sets]
    side = [k % 3 for k in range(60)]
    rows = {"id": list(range(60)), "root": [k if k > 7 else k % 4 for k in range(60)], "left": [s < 2 for s in side],
            "right": [s > 0 for s in side], "x": [x.tobytes() for x in sets], "w": [w.tobytes() for w in counts]}
    found = dart_minhash._block_links(0.8, weighted)(pa.table(rows)).to_pylist()

    def classes(links):
        own = dict(enumerate(rows["root"]))
        for a, b in links:
            own = {k: own[a] if v == own[b] else v for k, v in own.items()}
        return {frozenset(k for k in own if own[k] == v) for v in own.values()}

    alike = [(a, b) for a in range(60) for b in range(60) if rows["left"][a] and rows["right"][b] and
             dart_minhash.similarity(sets[a], counts[a], sets[b], counts[b], weighted) >= 0.8]
    assert classes([(r["a"], r["b"]) for r in found]) == classes(alike)
    assert len(found) < len(set(rows["root"])) and set((r["a"], r["b"]) for r in found) <= set(alike)


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(7)
    x = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    w, v = rng.integers(1, 9, len(x)).astype(float), rng.integers(1, 9, len(x)).astype(float)
    true = np.minimum(w, v).sum() / np.maximum(w, v).sum()
    k = 2048
    same = (dart_minhash.signature(x, w, k) == dart_minhash.signature(x, v, k)).mean()
    assert abs(same - true) < 5 * (true * (1 - true) / k) ** 0.5


TEXTS = ["password = 'abcdefgh12' and token: short", "AKIA" + "Z" * 16 + " AKIA12", "x" + "0123456789abcdef" * 2, "", None,
         "token=secret=abcdefghij secret: secret: abcdefghijk", "é" * 50 + " api_key:ABCDEFGH", "b@c.d e@f g@h..i a@b.c_d@e.f",
         "1.2.3.4 256.1.1.1 1.2.3.4.5", "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559",
         "+1 (988) 555-2485, +49 30 1234567 +1", "1 " * 5000, "a.b" * 3000 + "@x.y", "😀 x@y.zz 😀"]


def test_base_spans_match_plain_patterns(spark):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(x):
        return sum(n - 9 * (n > 9) for n in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(x)))) % 10 == 0

    secret = [(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
              ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("[0-9a-f]+", lambda m: len(m[0]) >= 32)]
    personal = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
                (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
                (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
                (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    for scan, kinds in ((secret_scan.scan, secret), (pii.find_personal, personal)):
        for r in scan(df).collect():
            want = {(m.start(), m.end(), k) for k, (p, ok) in enumerate(kinds)
                    for m in re.finditer(p, TEXTS[r.doc_id] or "") if ok(m)}
            assert {(s.start, s.end, s.kind) for s in r.base} == want, TEXTS[r.doc_id]
        assert scan(df.limit(0)).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "write to a.b@c.de or +1 (988) 555-2485 now"), (2, None), (3, "plain")], "doc_id int, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "write to <email> or <phone> now", 2: None, 3: "plain"}


def test_markov_ratio_tells_random_from_words(spark):
    rng = np.random.default_rng(9)
    key = lambda n: "".join(rng.choice(list("0123456789abcdefGHIJKLMNOPQRSTUVWXYZ"), n))
    texts = [f"some ordinary sentence number with words password={key(24)}" for _ in range(60)] + [f"lost {key(30)} here", "anotherVeryOrdinaryIdentifier"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in secret_scan.scan(df).collect()}
    assert [s.start for s in got[60].added] == [5] and not got[61].added


def test_repeats(docs, rows, empty):
    got = {r.doc_id: r for r in suffixes.remove_repeats(docs).collect()}
    seen = set()
    for doc, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        r = got[doc]
        assert (r.n_bytes, r.n_removed, bytes(r.kept)) == (len(data), sum(gone), kept)
        assert r.n_spans == len(re.findall(b"\1+", bytes(gone))) and r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert suffixes.remove_repeats(empty).count() == 0


def test_repeats_in_crowds(spark):
    line = words(40, 11)  # a passage with other words around it, in many documents
    texts = [f"{words(30, 100 + i)} {line} {words(30, 500 + i)}" for i in range(150)] + ["ab" * 400, "a" * 350]
    got = {r.doc_id: r.n_removed for r in suffixes.remove_repeats(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    seen = set()
    for doc, text in enumerate(texts):
        gone = bytearray(len(text))
        for s in range(len(text) - 99):
            if text[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(text[s : s + 100])
        assert got[doc] == sum(gone)


def test_toxicity(spark, empty):
    texts = [(i, words(40, i, 20) + (" you vilest grobbet" if i % 4 == 0 else "")) for i in range(400)]
    df = spark.createDataFrame(texts + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(1000, 1), (3, None)], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(df, toxicity.learn(df, labels)).collect()}
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((scores[i] >= 0.7) == (i % 4 == 0) for i in out) >= 0.95 * len(out)
    assert all(0 <= s <= 1 for s in scores.values()) and scores[900] == scores[901]
    none = toxicity.learn(empty, labels.limit(0))
    assert {r.score for r in toxicity.score_toxicity(df, none).collect()} == {0.0}


def test_pipeline_keeps_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert sorted(after.columns) == sorted(start.columns), name
        docs = spark.createDataFrame(after.collect(), start.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).select("doc_id").distinct().count() == docs.count()


def test_pipeline_mixture_reaches_the_sequences(spark, sf_dir, tmp_path):
    import corpus_pipeline

    data = [(i, words(150 + i % 7, 700 + i), f"s{i % 2}", "x", 1.0) for i in range(300)]
    docs, packed = spark.createDataFrame(data, DOCS), []
    for k, weights in enumerate(({"s0": 9, "s1": 1}, {"s0": 1, "s1": 9})):
        mixed = mixing.mix(docs, weights, block_bytes=2000)
        place = {r.doc_id: (r.mix.slot, r.mix.start) for r in mixed.collect()}
        mixing.in_mixed_order(mixed).write.parquet(str(tmp_path / str(k)))
        got = corpus_pipeline.pack_sequences(spark, spark.read.parquet(str(tmp_path / str(k))), sf_dir).collect()
        assert sorted(r.doc_id for r in got) == list(range(300))
        members = {}
        for r in got:
            members.setdefault(r.sequence_id, set()).add(r.doc_id)
        first = [min(place[d] for d in members[s]) for s in range(len(members))]
        assert first == sorted(first)
        packed.append(members)
    assert packed[0] != packed[1]
    early = [sum(d % 2 == 0 for s in range(3) for d in p[s]) / sum(len(p[s]) for s in range(3)) for p in packed]
    assert early[0] > 0.6 > 0.4 > early[1]


def test_top_products_below_zero():
    rng = np.random.default_rng(2)
    angles = np.pi + rng.uniform(-1, 1, 60)  # all opposed to the query, lengths within a tenth
    near = np.floor(rng.uniform(92, 100, 60)[:, None] * np.stack([np.cos(angles), np.sin(angles)], 1))
    vectors = np.concatenate([[[-60.0, 80.0]] * 9, [[-59.0, 74.0]], [[-95.0, 0.0]] * 6, near[(near[:, 0] < -62) & (np.hypot(*near.T) < 94)]])
    queries, ids = np.array([[64.0, 0.0]]), np.arange(1, len(vectors) + 1)
    for k in (1, 2, 5, 12):
        _, found, scores = topk._finder(k, 8)(np.array([0]), queries, ids, vectors)
        best = sorted((-int(v @ queries[0]), i) for i, v in zip(ids, vectors, strict=True))[:k]
        assert sorted((-int(s), i) for s, i in zip(scores, found, strict=True)) == best


def test_ordinary_tokens_have_digits_and_marks_and_touch_no_base_span(spark):
    text = "plain_snake_case2 my_long_password=abcdefgh12 a/path/to-x7 " + "0" * 40 + "GHIJKL xyz tail_password='abcdefgh'"
    col = F.lit(text)
    got = spark.range(1).select(secret_scan.ordinary_tokens(col, secret_scan.base_spans(col)).alias("t")).first().t
    assert got == ["plain_snake_case2", "a/path/to-x7"]


def test_markov_ratio_alone_decides_and_every_document_counts(spark):
    rng = np.random.default_rng(12)
    key = lambda n: "".join(rng.choice(list("bcdfghjkmpqrtvwxz"), n))
    names = [f"row_{i % 90:02d}_of_table_{i % 70:02d}" for i in range(5000)]
    texts = [f"{n} password={key(24)}" if i < 300 else f"{n} {n}" for i, n in enumerate(names)]
    texts.append(f"lost {key(30)} here row_17_of_table_23")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: [s.match for s in r.added] for r in secret_scan.scan(df).collect()}
    assert got.pop(5000) == [texts[-1].split()[1]]  # no digit and no capital, yet random
    assert not any(got.values())
    model = secret_scan.learn(df, secret_scan.annotate(df))
    mark, digit = (secret_scan.ALPHABET.index(c) + 1 for c in "_1")
    # A step of ordinary names, counted in every document.
    assert model.ordinary[mark * secret_scan.SYMBOLS + digit] == sum(len(re.findall("_(?=1)", t)) for t in texts)


def test_calibration_keeps_the_true_shares():
    from weir.llm import boosting

    rng = np.random.default_rng(4)
    y = (np.arange(8000) % 4 == 0).astype(float)  # a quarter of the sample, a tenth of the rows it stands for
    x = np.where(rng.random(8000) < 0.2, 1 - y, y)[:, None]
    model = boosting.fit(x, y, np.arange(8000) % 5 == 0, totals=(90_000, 10_000))
    low, high = model.score(np.array([[0.0], [1.0]]))
    assert abs(high - 0.08 / (0.08 + 0.18)) < 0.05 and abs(low - 0.02 / (0.02 + 0.72)) < 0.02


def test_lexicon_counts_every_labelled_row(spark):
    # 90 toxic words, each in a dozen of the toxic rows: hardly one passes the tests in a sample of 800 rows.
    data = [(i, f"{words(6, i, 20)} {'grob' + np.base_repr(1000 + i // 10 % 90, 36).lower() if i % 10 == 0 else ''}",
             int(i % 10 == 0)) for i in range(16_000)]
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    found = toxicity.learn(df, df, fit_rows=800).lexicon.words
    assert found >= {t.split()[-1] for _, t, k in data if k}


def test_mixing_of_more_sources_than_the_driver_schedules(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 6)
    # 6 large sources, 20 of 8 blocks each and an unnamed one; every row fills half a block.
    data = [(i, "x" * 99, f"big{i % 6}") for i in range(6 * 60)]
    data += [(1000 + i, "x" * 99, f"t{i % 20}" if i < 320 else None) for i in range(336)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix(df, block_bytes=200).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in data)
    assert all(r.mix.release <= r.mix.slot < r.mix.deadline for r in got)
    owner = {}
    for r in got:
        assert owner.setdefault(r.mix.slot, (r.source, r.mix.block)) == (r.source, r.mix.block)
    assert sorted(owner) == list(range(len(owner)))
    tail = [owner[s] for s in sorted(owner) if not str(owner[s][0]).startswith("big")]
    for source in {s for s, _ in tail}:
        at = [k for k, (s, _) in enumerate(tail) if s == source]
        assert [tail[k][1] for k in at] == list(range(8))
        assert all(abs(n - k * 8 / len(tail)) < 3 for n, k in enumerate(at))  # below one block at each of three levels
