"""Hard negatives, mixing and spelling variants against brute force and SQL, on small hand-made tables."""

from __future__ import annotations

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives, mixing, variants

SF = "/root/testdata/sf0.001"


# -------------------------------------------------------------- hard negatives

def brute_negatives(rows, anchors, positives=5, negatives=5, window=(80, 100)):
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    own = {}
    for i, label, v in sorted(anchors):
        own.setdefault(i, (label, v))
    for i, (label, v) in own.items():
        scored = sorted((-dot(v, w), j, k) for j, k, w in rows if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [x for x in scored if x[2] != label and window[0] * -s <= 100 * -x[0] <= window[1] * -s][:negatives]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(fits, 1)]
    return sorted(out)


def vectors(kind):
    rng = np.random.default_rng(7)
    if kind == "clusters":                                                          # near copies in a few directions, labels mixed
        base = rng.integers(-200, 200, (6, 8))
        v = base[rng.integers(0, 6, 300)] + rng.integers(-6, 7, (300, 8))
    elif kind == "ties":
        v = rng.integers(-1, 2, (300, 3))
    elif kind == "copies":                                                          # a third of all rows are one vector
        v = rng.integers(-50, 50, (300, 5))
        v[::3] = 7
    else:                                                                           # beyond what a double holds exactly
        v = rng.integers(-2 ** 27, 2 ** 27, (120, 4))
    ids = list(range(len(v)))
    ids[5] = ids[40] = ids[20]                                                      # repeated ids, one of an anchor
    return [(i, int(label), [int(x) for x in w]) for i, label, w in zip(ids, rng.integers(0, 3, len(v)) if kind != "copies" else (rng.random(len(v)) < 0.4).astype(int), v, strict=True)]


@pytest.mark.parametrize("kind", ["clusters", "ties", "copies", "large"])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, kind):
    for name, value in (("CANDIDATES", 16), ("ANCHORS", 6), ("GROUP_BLOCKS", 2)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(kind)
    df = spark.createDataFrame(rows, "id bigint, label bigint, vector array<bigint>").repartition(3)
    got = hard_negatives.hard_negatives(df, df.where("id % 10 = 0"), window=(60, 95))
    want = brute_negatives(rows, [r for r in rows if r[0] % 10 == 0], window=(60, 95))
    assert want and sorted(map(tuple, got.collect())) == want


def test_spanning_tree_is_least():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(25, 3))
    order, parent, edge, depth = hard_negatives.spanning_tree(a)
    assert sorted(order) == list(range(25)) and all(depth[k] == depth[parent[k]] + 1 for k in range(1, 25)) and list(depth) == sorted(depth)
    assert np.allclose(edge[1:], [np.linalg.norm(a[order[k]] - a[order[parent[k]]]) for k in range(1, 25)])
    root, total = list(range(25)), 0.0                                              # edges by length, joining what is apart
    for d, i, j in sorted((np.linalg.norm(a[i] - a[j]), i, j) for i in range(25) for j in range(i)):
        if root[i] != root[j]:
            total, old = total + d, root[i]
            root = [root[j] if r == old else r for r in root]
    assert np.isclose(edge.sum(), total)


def test_bounds_save_scores_where_anchors_are_alike():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(1, 32)) * 40 + rng.normal(size=(200, 32)) for _ in range(10)]).astype(np.int64)
    side = {"ids": np.arange(2000), "labels": np.repeat(np.arange(10), 200), "kind": "int64"}
    order, parent, edge, depth = hard_negatives.spanning_tree(x[:50].astype(float))
    q = {"ids": side["ids"][:50][order], "labels": np.zeros(50, np.int64), "rows": x[:50][order], "parent": parent, "edge": edge, "depth": depth,
         "scores": np.zeros((50, 1), np.int64) + 50_000}
    pack = lambda d: {k: v if isinstance(v, str) else v.tobytes() for k, v in d.items()}
    asked = hard_negatives.Asked({**pack(q), "kind": "int64"}, 5, (80, 100))
    assert asked.search(hard_negatives.Side(pack({**side, "rows": x}))) < 0.5 * 50 * 1800


def test_hard_negatives_of_odd_rows(spark, tmp_path):
    rows = [(0, 1, [1.0, 0.0]), (100, 1, [1.0, 0.5]), (7, 1, [0.9, 0.0]), (8, 2, [0.9, 0.1]), (None, 1, [1.0, 1.0]), (9, None, [1.0, 1.0]),
            (10, 1, None), (11, 2, [None, 1.0]), (12, 2, [float("inf"), 1.0]), (200, 1, []), (300, 5, [1.0, 1.0]), (8, 2, [0.9, 0.1])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").withColumn("id", F.lit("x")).withColumn("vector", F.lit(1))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = hard_negatives.op11_hard_negatives(spark, str(tmp_path)).collect()
    moved = [(i, (k + 1) % 10 if i % 7 == 0 else k, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, k, v in rows
             if None not in (i, k, v) and all(x is not None and np.isfinite(x) for x in v)]
    assert sorted(map(tuple, got)) == brute_negatives(moved, [r for r in moved if r[0] % 100 == 0])


# --------------------------------------------------------------------- mixing

def by_sql(rows, schema_sql):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents ({schema_sql})")
    con.executemany("INSERT INTO documents VALUES (" + ", ".join("?" * len(rows[0])) + ")", rows)
    return sorted(con.execute(mixing.ORACLE_SQL).fetchall(), key=repr)


def documents():
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        source = ["hot", "hot", "b", None, "é", "Z", "", "tiny"][int(rng.integers(0, 7))] if k else "tiny"
        rows.append((k if k % 50 else None, " ".join(["w"] * int(rng.integers(0, 40))) if k % 23 else None, source))
    return [*rows, (1, rows[1][1], rows[1][2]), (2, "x " * 30_000, "hot"), (3, " \t\n\x0b\x0c\r", "blank")]


@pytest.mark.parametrize("bits", [4, 12])
def test_mixing_equals_sql_and_comes_near(spark, monkeypatch, tmp_path, bits):
    monkeypatch.setattr(mixing, "LEVEL_BITS", bits)
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("size", F.lit("x")).withColumn("of", F.lit(1))
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op12_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == by_sql(rows, "doc_id BIGINT, text VARCHAR, source VARCHAR")
    assert sorted(map(tuple, mixing.op12_mixing(spark, str(tmp_path)).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    assert np.isclose(sum({r["source"]: r["target"] for r in got}.values()), sum(r["size"] for r in got))
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        assert own[0]["target"] <= 3 * own[0]["source_size"] and all(0 <= r["taken"] <= 3 * r["size"] for r in own)
        largest = max(collections.Counter((r["doc_id"], r["size"]) for r in own).items(), key=lambda x: x[0][1] * x[1])
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest[0][1] * largest[1] / 2 + 1


def test_mixing_of_no_words_and_one_source(spark):
    schema = "id bigint, source string, text string"
    got = mixing.mix(spark.createDataFrame([(1, "a", None), (2, None, " ")], schema)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in got] == [(0, 0.0, 0)] * 2
    one = mixing.mix(spark.createDataFrame([(1, "a", "x y"), (2, "a", "z")], schema)).collect()
    assert {(r["target"], r["times"]) for r in one} == {(3.0, 1)}


def test_mixing_without_python(spark):
    from tests.llm.test_operators import SF as small
    plan = mixing.op12_mixing(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------------------- variants

def brute_variants(n, ratio=5):
    near = {w: set() for w in n}
    holes = collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[i, w[:i], w[i + 1:]].add(w)
            if (x := w[:i] + w[i + 1:]) in n:
                near[w].add(x)
                near[x].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b is not None and n[b] >= ratio * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


@pytest.mark.parametrize(("letters", "symbols"), [("ab", 1 << 17), ("ab", 300), ("aéÿ", 60), ("abcdefgh", 500)])
def test_variants_equal_brute_force(spark, letters, symbols):
    rng = np.random.default_rng(4)
    words = {"".join(rng.choice(list(letters), int(rng.integers(6, 10)))) for _ in range(400)}
    words |= {w[:k] + w[k + 1:] for w in list(words)[:60] for k in range(len(w)) if len(w) > 6}
    words |= {"a" * k for k in range(6, 40)} | {"a" * 3000, "a" * 2999 + "b"}
    n = {w: int(5 ** rng.integers(1, 7)) + int(rng.integers(0, 2)) for w in sorted(words)}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    got = sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in variants.variants(df, shard_symbols=symbols).collect())
    assert got == brute_variants(n)


def test_vocabulary_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(variants, "PIECE_CHARS", 50)
    monkeypatch.setattr(variants, "HELD_WORDS", 7)
    rows = [(k, t) for k, t in enumerate([None, "", "Straße ÀÉÿ Ünïcodes ×÷×÷×÷ don't", "wordword " * 40, "a" * 500, "WordWord-wordWORD Übung_ÜBUNG"])]
    rows += [(3, "wordword " * 40), (None, "wordword abcdefg"), *((100 + k, "planted Planted PLANTED misspelt") for k in range(300))]
    count = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            k = h % len(run)
            count[run[:k] + run[k + 1:] if h % 199 == 0 else run] += 1
    docs = spark.createDataFrame([(None if i is None else str(i), t) for i, t in rows], "id string, text string").repartition(4)
    got = {r["word"]: r["n"] for r in variants.vocabulary(docs, every=199, count=2).collect()}
    assert got == {w: n for w, n in count.items() if len(w) >= 6 and n >= 2}


def test_one_error_within_an_index():
    words = sorted({b"abcdef", b"abcdeg", b"abcde", b"abcdeff", b"abcxef", b"xbcdef", b"abcdefgh"})
    index = variants.Index(words)
    q, c = variants.one_error(index, [b"abcdef"], np.array([3]), np.array([True]))
    assert sorted(words[k] for k in c) == [b"abcde", b"abcdeff", b"abcdeg", b"abcxef"] and set(q) == {0}
