"""Hard-negative mining by bounds along spanning trees of anchors (operator 11).

Anchors lie in blocks; each block is a least spanning tree by Euclidean distance.  Against a block of candidates the
root is scored exactly.  A child's score differs from its parent's by no more than the edge times the candidate's norm,
so the parent's score (or bounds, where it was not scored) bounds the child's.  Only candidates whose bounds overlap a
window of scores still open to the child are scored; their exact scores bound the next level.  A window closes from
below as its best candidates become known.

The same search gives the positives (one window without ends, candidates of the anchor's label) and the negatives (a
window for each positive, candidates of other labels).  Blocks of candidates are spread over groups and every block of
anchors visits each group: the stated anchors against all rows, block by block, with no list of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, scratch, shuffle_width, table

CANDIDATES, ANCHORS, GROUP_BLOCKS = 2048, 512, 16                                   # rows of a block either way, blocks of a group
DENSE = 1 / 8                                                                       # a level is scored as one product from this share on
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


# ---------------------------------------------------------------------- trees

def spanning_tree(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge, depth) of a least spanning tree over rows, root first and by depth; parents as places in the order."""
    m = len(a)
    far = lambda k: ((a - a[k]) ** 2).sum(1)
    root = int(np.argmin(((a - a.mean(0)) ** 2).sum(1)))
    near, parent, depth = far(root), np.full(m, root), np.zeros(m, np.int64)
    edge, free = np.zeros(m), np.ones(m, bool)
    free[root] = False
    for _ in range(m - 1):
        k = int(np.argmin(np.where(free, near, np.inf)))
        free[k], edge[k], depth[k] = False, math.sqrt(near[k]), depth[parent[k]] + 1
        d = far(k)
        closer = free & (d < near)
        near[closer], parent[closer] = d[closer], k
    order = np.argsort(depth, kind="stable")
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    return order, place[parent[order]], edge[order], depth[order]


# --------------------------------------------------------------------- blocks

SIDE = "ids binary, labels binary, rows binary, kind string, low bigint, high bigint"
PLAN = "parent binary, edge binary, depth binary, scores binary"


def blocks(rows: DataFrame, size: int, asked: bool = False) -> DataFrame:
    """(id, label, vector) in rows of up to ``size`` vectors of few labels; ``asked``: with tree and (scores) windows.

    Ranges over (label, id) split a frequent label like any other.  A block ends where the label changes, unless it
    is small.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list = []

        def row():
            wide = max(len(r[2]) for r in kept)
            m = np.zeros((len(kept), wide), np.int64)
            for k, r in enumerate(kept):
                m[k, :len(r[2])] = r[2]
            ids, labels = np.array([r[0] for r in kept], np.int64), np.array([r[1] for r in kept], np.int64)
            out = {}
            if asked:
                order, parent, edge, depth = spanning_tree(m.astype(np.float64))
                m, ids, labels = m[order], ids[order], labels[order]
                scores = np.full((len(kept), max(1, max(len(r[3]) for r in kept))), LEAST, np.int64)
                for k, at in enumerate(order.tolist()):
                    scores[k, :len(kept[at][3])] = kept[at][3]
                out = {"parent": parent, "edge": edge, "depth": depth, "scores": scores}
            kind = next(t for t in ("int16", "int32", "int64") if abs(m).max(initial=0) <= np.iinfo(t).max)
            sides = {"ids": ids, "labels": labels, "rows": m.astype(kind)}
            return pa.RecordBatch.from_pydict(
                {**{k: pa.array([v.tobytes()], pa.binary()) for k, v in sides.items()}, "kind": [kind],
                 "low": pa.array([int(labels.min())], pa.int64()), "high": pa.array([int(labels.max())], pa.int64()),
                 **{k: pa.array([v.tobytes()], pa.binary()) for k, v in out.items()}})

        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if kept and (len(kept) == size or len(kept) >= size // 16 and kept[-1][1] != r[1]):
                    yield row()
                    kept = []
                kept.append(r)
        if kept:
            yield row()

    n = rows.count()
    parts = max(1, min(shuffle_width(rows.sparkSession), n // size), math.ceil(n / (size * GROUP_BLOCKS)))
    dealt = rows.repartitionByRange(parts, "label", "id").coalesce(parts).sortWithinPartitions("label", "id")
    return dealt.mapInArrow(run, SIDE + (", " + PLAN) * asked)


class Side:
    def __init__(self, r: dict):
        self.ids, self.labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
        self.x = np.frombuffer(r["rows"], r["kind"]).reshape(len(self.ids), -1).astype(np.float64)
        self.norm = np.sqrt((self.x ** 2).sum(1))


class Asked(Side):
    """A block of anchors, its tree, its windows (low, high) and the best of each window so far."""

    def __init__(self, r: dict, k: int, window: tuple[int, int] | None):
        super().__init__(r)
        m = len(self.ids)
        self.parent, self.edge = np.frombuffer(r["parent"], np.int64), np.frombuffer(r["edge"], np.float64)
        depth = np.frombuffer(r["depth"], np.int64)
        self.levels = [(int(i), int(j)) for i, j in zip(*(np.searchsorted(depth, range(depth[-1] + 1), s) for s in ("left", "right")), strict=True)]
        self.same = window is None
        if window is None:
            self.low, self.high = np.full((m, 1), LEAST), np.full((m, 1), MOST)
        else:
            s = np.frombuffer(r["scores"], np.int64).reshape(m, -1)
            some = s >= 0                                                           # below zero a window is empty
            s = np.where(some, s, 0)
            self.low, self.high = np.where(some, -(-window[0] * s // 100), 1), np.where(some, window[1] * s // 100, 0)
        wide = self.low.shape[1]
        self.best, self.who = np.full((m, wide, k), LEAST), np.zeros((m, wide, k), np.int64)
        self.found = np.zeros((m, wide, k), bool)

    def search(self, c: Side) -> int:
        """Offers every candidate of a block to the windows; returns how many were scored."""
        m, n, dims = len(self.ids), len(c.ids), min(self.x.shape[1], c.x.shape[1])
        a, x = self.x[:, :dims], c.x[:, :dims]
        exact = float(self.norm.max(initial=0)) * float(c.norm.max(initial=0)) < 2.0 ** 53
        if not exact:
            a, x = a.astype(np.int64), x.astype(np.int64)
        slack = 1e-12 * self.norm.max(initial=0) * c.norm
        able = ((self.labels[:, None] == c.labels[None, :]) == self.same) & (self.ids[:, None] != c.ids[None, :])
        floor = np.maximum(self.low, np.where(self.found[:, :, -1], self.best[:, :, -1], LEAST))
        least, most = floor.astype(np.float64), self.high.astype(np.float64)
        lo, hi, score = np.empty((m, n)), np.empty((m, n)), np.zeros((m, n), np.int64)
        scored = np.zeros((m, n), bool)
        for i, j in self.levels:
            if i == 0:
                open_ = np.ones((j, n), bool)
            else:
                up = self.parent[i:j]
                reach = self.edge[i:j, None] * (1 + 1e-9) * c.norm[None, :] + slack[None, :]
                lo[i:j], hi[i:j] = lo[up] - reach, hi[up] + reach
                open_ = np.zeros((j - i, n), bool)
                for w in range(least.shape[1]):
                    open_ |= (hi[i:j] >= least[i:j, w, None]) & (lo[i:j] <= most[i:j, w, None])
                open_ &= able[i:j]
            if open_.mean() >= DENSE:
                at = np.flatnonzero(open_.any(0))
                s = (a[i:j] @ x[at].T).astype(np.int64)
                score[i:j, at], lo[i:j, at], hi[i:j, at] = s, s, s
            else:
                p, q = np.nonzero(open_)
                s = np.einsum("ij,ij->i", a[i + p], x[q]).astype(np.int64)
                score[i + p, q], lo[i + p, q], hi[i + p, q] = s, s, s
            scored[i:j] = open_
        scored &= able
        for w in range(self.low.shape[1]):
            self._offer(w, scored & (score >= floor[:, w, None]) & (score <= self.high[:, w, None]), score, c.ids)
        return int(scored.sum())

    def _offer(self, w: int, fits: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.best.shape[2]
        rows = np.flatnonzero(fits.any(1))
        if not len(rows):
            return
        fits, score = fits[rows], score[rows]
        if fits.shape[1] > k:
            v = np.where(fits, score, LEAST)
            fits &= v >= np.partition(v, v.shape[1] - k, axis=1)[:, v.shape[1] - k, None]
        p, q = np.nonzero(fits)
        of, slot = np.nonzero(self.found[rows, w])
        row = np.concatenate([p, of])
        value = np.concatenate([score[p, q], self.best[rows[of], w, slot]])
        who = np.concatenate([ids[q], self.who[rows[of], w, slot]])
        order = np.lexsort((who, -value, row))
        row, value, who = row[order], value[order], who[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < k
        at = (rows[row[top]], w, place[top])
        self.best[at], self.who[at], self.found[at] = value[top], who[top], True

    def winners(self) -> pa.RecordBatch:
        i, w, s = np.nonzero(self.found)
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (self.ids[i], w.astype(np.int64), self.who[i, w, s], self.best[i, w, s])],
                                          ["anchor_id", "window", "vec_id", "score"])


def best_in_windows(candidates: DataFrame, anchors: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
    """Blocks against blocks: (anchor_id, window, rank, vec_id, score), the ``k`` best of each window, ties to the smaller id."""
    spark = candidates.sparkSession
    n = candidates.count()
    groups = max(min(shuffle_width(spark), n), math.ceil(n / GROUP_BLOCKS), 1)
    side = ["ids", "labels", "rows", "kind"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, asked = None, None
        for b in batches:
            for at in range(b.num_rows):
                q, c = (b.column(s)[at] for s in ("q", "c"))
                key = q["ids"].as_buffer().to_pybytes(), q["labels"].as_buffer().to_pybytes()
                if name != key:
                    if asked is not None:
                        yield asked.winners()
                    name, asked = key, Asked(q.as_py(), k, window)
                asked.search(Side(c.as_py()))
        if asked is not None:
            yield asked.winners()

    c = candidates.select(F.pmod(F.xxhash64("ids"), F.lit(groups)).alias("group"), F.col("low").alias("c_low"), F.col("high").alias("c_high"),
                          F.struct(*side).alias("c")).repartition(groups, "group")
    q = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), F.col("low").alias("q_low"),
                       F.col("high").alias("q_high"), F.struct(*side, "parent", "edge", "depth", "scores").alias("q")).repartition(groups, "group")
    one = (F.col("q_low") == F.col("q_high")) & (F.col("c_low") == F.col("c_high")) & (F.col("q_low") == F.col("c_low"))
    meet = (F.col("q_low") <= F.col("c_high")) & (F.col("c_low") <= F.col("q_high")) if window is None else ~one
    pairs = q.hint("merge").join(c, "group").where(meet).select("q", "c")           # merged: a block of anchors meets its group's blocks in a row
    found = pairs.mapInArrow(search, "anchor_id bigint, window bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("anchor_id", "window", "rank", "vec_id", "score")


def usable(rows: DataFrame) -> DataFrame:
    """(id, label, vector): whole components floor(256 x); rows with a null or non-finite part are gone, repeated ids stay."""
    x = F.col("vector").cast("array<double>")
    fine = F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(fine).select("id", F.col("label").cast("long").alias("label"), F.transform(x, lambda v: F.floor(v * 256).cast("long")).alias("vector"))


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100)) -> DataFrame:
    """(id, label, vector) candidates and anchors of whole numbers to (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products (a shorter vector counts as filled with zeros).  For an anchor's best ``positives`` rows
    of its label: its best ``negatives`` rows of other labels with scores from ``window[0]`` to ``window[1]`` percent
    of the positive's.  Ties go to the smaller id.  A row with an anchor's own id is no candidate of it; of anchors that
    repeat an id the least (label, vector) counts, as candidates all of them do.  Negative positive scores leave an
    empty window.  Scores must fit 56 bits.  Empty tables give no rows.
    """
    candidates = scratch(blocks(rows, CANDIDATES), "candidates")
    own = scratch(anchors.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.label", "r.vector"), "anchors")
    none = F.array().cast("array<bigint>").alias("scores")
    asked = scratch(blocks(own.select("id", "label", "vector", none), ANCHORS, asked=True), "asked")
    near = scratch(best_in_windows(candidates, asked, positives, None), "positives")
    scores = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s"))
    open_ = own.join(scores, own["id"] == scores["anchor_id"]).select("id", "label", "vector", F.col("s.score").alias("scores"))
    far = best_in_windows(candidates, scratch(blocks(open_, ANCHORS, asked=True), "asked"), negatives, window)
    told = near.select("anchor_id", (F.col("rank") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.withColumnRenamed("score", "negative_score").join(told, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every row whose vec_id is divisible by 100: 5 for each of its 5 best rows of its label.

    Rows with a null id, label or vector and vectors with a null, NaN or infinite component take no part.  Repeated
    ids, ties, empty tables and vectors of different lengths as in ``hard_negatives``; nothing here holds texts.
    """
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(columns(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"), id="vec_id", label="label", vector="embedding")
                  .withColumn("label", moved))
    rows = scratch(rows, "vectors")
    return hard_negatives(rows, rows.where(F.col("id") % 100 == 0))


ORACLE_SQL = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
a AS (SELECT vec_id, label, x FROM v WHERE vec_id % 100 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, x) = 1),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
             CASE WHEN len(c.x) = 0 THEN 0 ELSE CAST(list_dot_product(a.x, c.x) AS BIGINT) END AS score
      FROM a JOIN v c ON a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
      FROM s WHERE same QUALIFY place <= 5),
n AS (SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
