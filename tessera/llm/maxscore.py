"""Exact top-k inner-product search with MaxScore (operator 9).

Vectors are whole numbers; a dimension is a term whose postings are the vectors with a positive and with a negative
value there.  Per shard and query, terms are ordered by their greatest possible gain.  Once a threshold is known, terms
whose gains together stay far below it are non-essential.  Essential postings are traversed; the vectors whose partial
score and the gains that are left reach the threshold are probed in the other terms, best first, for as long as they
do.  A shard whose gains together stay below a query's threshold is not looked at for it.

Blocks of queries meet one shard after another and keep their winners, so a threshold goes from shard to shard; the
winners of the groups of shards are merged.  Vectors are dense: a term's two postings hold nearly every vector of a
shard, so they are kept as one column of values, and the essential columns of a block are traversed in one product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, table

SHARD_ROWS, QUERY_ROWS, PROBE = 4096, 512, 4
FAR = 32                                                                            # non-essential gains stay below this part of a threshold
HELD_BYTES = 128 << 20                                                              # queries that a task holds, at 8 bytes a value
MANY = 64                                                                           # more pairs than one in so many are not probed one by one
GROUP_SHARDS, AT_ONCE = 16, 1 << 18                                                 # shards of a group, pairs that are probed together
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _norm(x: np.ndarray) -> float:
    """The greatest length of a row."""
    return math.sqrt((x.astype(np.float64) ** 2).sum(1).max(initial=0))


class Shard:
    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.x = ids, values
        self.top, self.low = (f(0, initial=0).astype(np.int64) for f in (values.max, values.min))
        self.norm = _norm(values)
        self.by_id = np.argsort(ids, kind="stable")
        self.sorted_ids = ids[self.by_id]
        self._columns: dict = {}

    def columns(self, kind) -> np.ndarray:
        """A row for each term: its value in every vector."""
        if kind not in self._columns:
            self._columns[kind] = np.ascontiguousarray(self.x.T, kind)
        return self._columns[kind]

    def best(self, q: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` best by score, then smaller id, without ``own``."""
        asked = Asked(np.array([own]), q[None], k)
        asked.search(self)
        n = int(asked.count[0])
        return asked.who[0, :n], asked.score[0, :n]


class Asked:
    """A block of queries and the ``k`` best of each so far, by score, then smaller id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, values, k
        self.norm = _norm(values)
        self.count = np.zeros(len(ids), np.int64)
        self.score, self.who = np.full((len(ids), k), LEAST), np.full((len(ids), k), MOST)

    def search(self, shard: Shard, every: bool = False) -> None:
        """Offers the vectors of a shard; ``every`` term is essential where too many vectors would be probed."""
        dims = min(self.q.shape[1], shard.x.shape[1])
        q = self.q[:, :dims].astype(np.int64)
        full, least = self.count == self.k, self.score[:, -1]                       # k of them are as good: no worse can win
        span = self.norm * shard.norm * (1 + 1e-9)                                  # no sum of products is greater
        kind = np.float32 if span < 2 ** 24 else np.float64 if span < 2 ** 53 else np.int64
        gain = np.zeros_like(q) if kind is np.int64 else q * np.where(q > 0, shard.top[:dims], shard.low[:dims])
        order = np.argsort(-gain, axis=1)
        left = np.zeros((len(q), dims + 1), np.int64)                               # gains from each place of the order on
        left[:, :-1] = np.cumsum(np.take_along_axis(gain, order, 1)[:, ::-1], axis=1)[:, ::-1]
        pruned = full & (least > 0) & (kind is not np.int64 and not every)          # gains beyond 64 bits are not used
        live = np.flatnonzero(~pruned | (left[:, 0] >= least))
        if not len(live) or not len(shard.ids):
            return
        if len(live) < len(q):
            q, full, least, pruned, order, left = (a[live] for a in (q, full, least, pruned, order, left))
        far = np.where(pruned, -(-least // FAR), 0)
        essential = np.where(pruned, (left[:, :-1] >= far[:, None]).sum(1), dims)
        rest = np.take_along_axis(left, essential[:, None], 1)[:, 0]
        if (essential < dims).any():
            chosen = np.zeros(q.shape, bool)
            np.put_along_axis(chosen, order, np.arange(dims) < essential[:, None], 1)
            terms = np.flatnonzero(chosen.any(0))
            partial = np.where(chosen, q, 0)[:, terms].astype(kind) @ shard.columns(kind)[terms if len(terms) < dims else slice(dims)]
        else:
            partial = q.astype(kind) @ shard.columns(kind)[:dims]
        self._offer(shard, live, q, full, least, order, left, essential, partial, np.where(full, least - np.where(full, rest, 0), LEAST))

    def _offer(self, shard: Shard, live, q, full, least, order, left, essential, partial, cut) -> None:
        """Finds what reaches ``cut`` by its partial score; of queries with fewer than ``k`` so far, the shard's ``k`` best."""
        ids = self.ids[live]
        none = LEAST if partial.dtype == np.int64 else -np.inf
        first, last = (np.searchsorted(shard.sorted_ids, ids, s) for s in ("left", "right"))
        for r in np.flatnonzero(first < last).tolist():
            partial[r, shard.by_id[first[r]:last[r]]] = none
        reach = cut.astype(partial.dtype)
        some = np.flatnonzero(~full)
        reach[some] = none
        if len(some) and partial.shape[1] > self.k:
            reach[some] = np.partition(partial[some], partial.shape[1] - self.k, axis=1)[:, -self.k]
        hit = np.flatnonzero(partial.max(1) >= reach)                               # with a high threshold most queries find nothing in a shard
        if 2 * len(hit) < len(partial):
            flat = np.flatnonzero((partial[hit] >= reach[hit, None]).ravel())
        else:
            hit, flat = np.arange(len(partial)), np.flatnonzero((partial >= reach[:, None]).ravel())
        if len(flat) * MANY > partial.size and (essential < q.shape[1]).any():
            return self.search(shard, every=True)
        for j in range(0, len(flat), AT_ONCE):                                      # with many ties nearly all reach the threshold
            row, at = np.divmod(flat[j:j + AT_ONCE], partial.shape[1])
            row = hit[row]
            fine = shard.ids[at] != ids[row]
            row, at = row[fine], at[fine]
            self._probe(shard, live, q, full, least, order, left, essential, row, at, partial[row, at].astype(np.int64))

    def _probe(self, shard: Shard, live, q, full, least, order, left, essential, row, at, score) -> None:
        """Adds the non-essential terms to partial scores, as long as they may win."""
        dims = q.shape[1]
        for j in range(0, dims - int(essential.min()), PROBE):
            place = np.minimum(essential[row] + j, dims)
            still = ~full[row] | (score + left[row, place] >= least[row])
            row, at, score, place = row[still], at[still], score[still], place[still]
            if not len(row):
                return
            places = place[:, None] + np.arange(PROBE)
            terms = order[row[:, None], np.minimum(places, dims - 1)]
            score = score + (np.where(places < dims, q[row[:, None], terms], 0) * shard.x[at[:, None], terms]).sum(1)
        who, worst = shard.ids[at], self.who[live, -1][row]
        wins = ~full[row] | (score > least[row]) | ((score == least[row]) & (who < worst))
        self._keep(live[row[wins]], score[wins], who[wins])

    def _keep(self, row: np.ndarray, score: np.ndarray, who: np.ndarray) -> None:
        if not len(row):
            return
        touched = np.unique(row)
        of, slot = np.nonzero(np.arange(self.k) < self.count[touched][:, None])
        row, score, who = (np.concatenate(p) for p in ((row, touched[of]), (score, self.score[touched[of], slot]), (who, self.who[touched[of], slot])))
        order = np.lexsort((who, -score, row))
        row, score, who = row[order], score[order], who[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < self.k
        self.score[row[top], place[top]], self.who[row[top], place[top]] = score[top], who[top]
        self.count[touched] = np.minimum(self.k, np.bincount(row)[touched])

    def winners(self) -> pa.RecordBatch:
        row, slot = np.nonzero(np.arange(self.k) < self.count[:, None])
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (self.ids[row], self.who[row, slot], self.score[row, slot])],
                                          ["query_id", "vec_id", "score"])


def usable(vectors: DataFrame) -> DataFrame:
    """(id, vector) with whole-number components floor(256 x); rows that take no part are gone, repeated ids stay."""
    x = F.col("vector").cast("array<double>")
    fine = F.col("id").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * 256).cast("long"))
    return vectors.where(fine).select("id", whole.alias("vector"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows of the narrowest integers that hold them (shorter lists filled with zeros)."""
    sizes, values = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
    m = np.zeros((len(sizes), sizes.max(initial=0)), next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= values.min(initial=0)
                                                          and values.max(initial=0) <= np.iinfo(t).max))
    m[np.arange(m.shape[1]) < sizes[:, None]] = values
    return m


def _packed(rows: DataFrame, size: int, piles: int) -> DataFrame:
    """Rows of ``size`` vectors each: ids, a matrix and its kind of integers; ``pile`` deals them evenly.

    The pile goes by partition and number, so that a task that is run again makes the same rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        pile = int(TaskContext.get().partitionId() * 0.6180339887498949 * piles)    # the golden ratio spreads the partitions' first piles
        pieces: list[pa.RecordBatch] = []
        held = 0

        def row():
            t = pa.Table.from_batches(pieces).combine_chunks()
            m = _matrix(t.column(1).chunk(0))
            return pa.RecordBatch.from_arrays([pa.array([pile % piles], pa.int32()), pa.array([t.column(0).to_numpy().astype(np.int64).tobytes()], pa.binary()),
                                               pa.array([m.tobytes()], pa.binary()), pa.array([m.dtype.name])], ["pile", "ids", "rows", "kind"])

        for b in batches:
            at = 0
            while at < b.num_rows:
                pieces.append(b.slice(at, size - held))
                at, held = at + pieces[-1].num_rows, held + pieces[-1].num_rows
                if held == size:
                    yield row()
                    pieces, held, pile = [], 0, pile + 1
        if held:
            yield row()

    return rows.mapInArrow(run, "pile int, ids binary, rows binary, kind string")


def _blocks(held: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[Asked]:
    """Packed queries in blocks of QUERY_ROWS."""
    if not held:
        return []
    ids, wide = np.concatenate([i for i, _ in held]), max(x.shape[1] for _, x in held)
    q = np.zeros((len(ids), wide), np.result_type(*[x.dtype for _, x in held]))
    at = 0
    for i, x in held:
        q[at:at + len(i), :x.shape[1]] = x
        at += len(i)
    return [Asked(ids[j:j + QUERY_ROWS], q[j:j + QUERY_ROWS], k) for j in range(0, len(ids), QUERY_ROWS)]


def dealing(vectors: int, queries: int, wide: int, cores: int) -> tuple[int, int]:
    """(groups of shards, parts of the queries): each part meets each group in a task.

    A part's queries fit a task.  Every part takes a copy of the vectors and every group one of the queries; but for
    giving the cores work, the queries' copies are no more than the vectors.
    """
    parts = max(1, math.ceil(queries * wide * 8 / HELD_BYTES))
    shards = max(1, math.ceil(vectors / SHARD_ROWS))
    return min(shards, max(math.ceil(4 * cores / parts), min(vectors // max(1, queries), shards // GROUP_SHARDS))), parts


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(id, vector) rows against (id, vector) queries: (query_id, rank, vec_id, score), ``k`` best of each query.

    The score is the whole-number inner product (a shorter vector counts as filled with zeros; scores must fit 64
    bits).  Ties go to the smaller id.  Rows with a query's own id are no candidates of it; other ids may repeat, each
    row is a candidate.  Of queries that repeat an id the least vector counts.
    A task holds a part of the queries, and a group of shards passes it by, one at a time; it gives each query's winners
    of the group.  No list of pairs is made.
    """
    spark = vectors.sparkSession
    asked, wide = queries.agg(F.count("*"), F.max(F.size("vector"))).first()
    groups, parts = dealing(vectors.count(), asked, wide or 1, spark.sparkContext.defaultParallelism)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    packed = ["ids", "rows", "kind"]
    shards = _packed(vectors, SHARD_ROWS, groups).select("*", each(parts).alias("part")).select(
        (F.col("pile") * parts + F.col("part")).alias("unit"), F.lit(1).alias("side"), *packed)
    own = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = _packed(own, QUERY_ROWS, parts).select("*", each(groups).alias("group")).select(
        (F.col("group") * parts + F.col("pile")).alias("unit"), F.lit(0).alias("side"), *packed)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, blocks = None, [], None
        for b in batches:
            for r in range(b.num_rows):
                name, side, ids, rows, kind = (b.column(c)[r] for c in ("unit", "side", *packed))
                if unit != name.as_py():
                    yield from (x.winners() for x in blocks or [])
                    unit, held, blocks = name.as_py(), [], None
                ids = np.frombuffer(ids.as_buffer(), np.int64)
                rows = np.frombuffer(rows.as_buffer(), kind.as_py()).reshape(len(ids), -1)
                if side.as_py() == 0:
                    held.append((ids.copy(), rows.copy()))                          # the batch is not kept
                    continue
                if blocks is None:
                    blocks, held = _blocks(held, k), []
                shard = Shard(ids, rows)
                for x in blocks:
                    x.search(shard)
        yield from (x.winners() for x in blocks or [])

    met = blocks.unionByName(shards).repartitionById(groups * parts, F.col("unit")).sortWithinPartitions("unit", "side")
    best = met.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors for every vector whose id is divisible by 50.

    Null vectors, vectors with null, NaN or infinite components and rows without an id take no part.  Rows that repeat
    an id are candidates each; of queries that repeat one the least vector counts.  Fewer than 5 other vectors: all.
    """
    rows = columns(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), id="vec_id", vector="embedding")
    return top_k(usable(rows), usable(rows.where(F.col("id") % 50 == 0)), 5)


ORACLE_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT vec_id, min(x) AS x FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
      FROM q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
