"""Benchmark decontamination with an FM-index per training shard (operator 8).

Every item gives its windows of ``size`` words as test phrases (a shorter item is one phrase).  A shard is a few
megabytes of whole documents.  Its index covers the runs of words that occur in test phrases, as long as the shortest
phrase at least: any other word ends every match, so nothing else can hold one.  Phrases are searched backwards through
ranks in a wavelet matrix over the Burrows-Wheeler transform, all phrases at once; occurrences are located by walking
back to sampled suffix positions; their spans are merged per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import PUNCT, Words, columns, distinct, scratch, table, utf8

SHARD_BYTES = 4 << 20
PHRASE_BYTES = 8 << 20                                                              # of item text searched in one pass
SAMPLE = 8


@dataclass
class Phrases:
    """Distinct test phrases over a vocabulary of their words; number 0 stands for any other word."""
    hashes: np.ndarray                                                              # ascending hashes of the vocabulary
    spelt: list[bytes]                                                              # the vocabulary in that order
    by_length: list[tuple[np.ndarray, np.ndarray]]                                  # (phrases x length) word numbers, phrase ids
    items: list[list[str]]                                                          # of each phrase id
    shortest: int


def phrases(items: list[tuple[str, bytes]], size: int) -> Phrases | None:
    w = Words([t for _, t in items], PUNCT, lower=True)
    if not len(w.starts):
        return None
    hashes, _ = distinct(w.hash)
    number = np.searchsorted(hashes, w.hash) + 1
    spelt: list[bytes] = [b""] * len(hashes)
    for k, a, b in zip(number, w.starts, w.ends, strict=True):
        spelt[k - 1] = w.buf[a:b].tobytes().lower()
    found: dict[tuple, list[str]] = {}
    for k, (item, _) in enumerate(items):
        a, b = int(w.first[k]), int(w.first[k + 1])
        n = min(size, b - a)
        for i in range(a, b - n + 1) if n else ():
            owners = found.setdefault(tuple(number[i:i + n].tolist()), [])
            if item not in owners:
                owners.append(item)
    by_length: dict[int, list] = {}
    for k, p in enumerate(found):
        by_length.setdefault(len(p), []).append((p, k))
    return Phrases(hashes, spelt, [(np.array([p for p, _ in v]), np.array([k for _, k in v])) for v in by_length.values()],
                   list(found.values()), min(by_length))


class WaveletMatrix:
    """Ranks of symbols in a sequence, level by level from the highest bit."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for k in range(bits - 1, -1, -1):
            one = (seq >> k) & 1
            ranks = np.concatenate([[0], np.cumsum(one)])                           # ones before each place
            zeros = len(seq) - int(ranks[-1])
            self.levels.append((k, ranks, zeros))
            seq = np.concatenate([seq[one == 0], seq[one == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low = np.zeros_like(at)
        for k, ranks, zeros in self.levels:
            one = ((symbol >> k) & 1).astype(bool)
            a, b = ranks[low], ranks[at]
            low = np.where(one, zeros + a, low - a)
            at = np.where(one, zeros + b, at - b)
        return at - low


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; zeros are separators, each of its own and before all symbols."""
    n = len(seq)
    zero = seq == 0
    rank = seq.astype(np.int64) + n
    rank[zero] = np.arange(int(zero.sum()))
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        if step < n:
            ahead[:n - step] = rank[step:] + 1
        ahead[rank < int(zero.sum())] = 0                                           # a separator decides by itself
        order = np.lexsort((ahead, rank))
        r, a = rank[order], ahead[order]
        new = np.concatenate([[0], np.cumsum((r[1:] != r[:-1]) | (a[1:] != a[:-1]))])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class FmIndex:
    """Index of a sequence of symbols 1.. in runs that are each ended by a 0."""

    def __init__(self, seq: np.ndarray, symbols: int, sample: int = SAMPLE):
        self.n = len(seq)
        sa = suffix_array(seq)
        self.bwt = seq[sa - 1]                                                      # the last symbol, a 0, is before the first
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=symbols + 1))])
        self.tree = WaveletMatrix(self.bwt, max(1, int(symbols).bit_length()))
        self.sampled = (self.bwt == 0) | (sa % sample == 0)                         # run starts, so no walk leaves its run
        self.at = np.where(self.sampled, sa, -1)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern (rows of symbols), searched from their last symbols."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, k]
            low[live] = self.before[c] + self.tree.rank(c, low[live])
            high[live] = self.before[c] + self.tree.rank(c, high[live])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of suffixes, by steps back to a sampled one."""
        out, row, steps = np.zeros(len(rows), np.int64), rows.copy(), 0
        todo = np.arange(len(rows))
        while len(todo):
            done = self.sampled[row]
            out[todo[done]] = self.at[row[done]] + steps
            todo, row = todo[~done], row[~done]
            c = self.bwt[row]
            row = self.before[c] + self.tree.rank(c, row)
            steps += 1
        return out


def occurrences(w: Words, p: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard: word number at which each occurrence starts, its length, and its phrase id."""
    empty = np.zeros(0, np.int64)
    at = np.searchsorted(p.hashes, w.hash)
    at[at == len(p.hashes)] = 0
    number = np.where(p.hashes[at] == w.hash, at + 1, 0)
    known = np.concatenate([[False], number > 0, [False]])
    cut = np.concatenate([[True], w.doc[1:] != w.doc[:-1], [True]]) if len(w.doc) else np.ones(1, bool)
    begins = np.flatnonzero(known[1:-1] & (cut[:-1] | ~known[:-2]))
    ends = np.flatnonzero(known[1:-1] & (cut[1:] | ~known[2:])) + 1
    long = ends - begins >= p.shortest
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return empty, empty, empty
    n = ends - begins + 1                                                           # with the separator
    stops = np.cumsum(n)
    word = np.repeat(begins - (stops - n), n) + np.arange(stops[-1])
    seq = number[np.minimum(word, len(number) - 1)]
    seq[stops - 1] = 0
    index = FmIndex(seq, len(p.hashes))
    starts, lengths, which = [], [], []
    for patterns, ids in p.by_length:
        low, high = index.search(patterns)
        count = high - low
        hit = np.flatnonzero(count)
        total = np.cumsum(count[hit])
        if not len(hit):
            continue
        rows = np.repeat(low[hit] - (total - count[hit]), count[hit]) + np.arange(total[-1])
        starts.append(word[index.locate(rows)])
        lengths.append(np.full(total[-1], patterns.shape[1]))
        which.append(np.repeat(ids[hit], count[hit]))
    if not starts:
        return empty, empty, empty
    s, n, k = np.concatenate(starts), np.concatenate(lengths), np.concatenate(which)
    spelt = {}                                                                      # hashes found the words; their bytes decide
    for i in np.unique(np.concatenate([s + j for j in range(int(n.max()))])):
        if i < len(number) and number[i]:
            spelt[int(i)] = w.buf[w.starts[i]:w.ends[i]].tobytes().lower() == p.spelt[number[i] - 1]
    if not all(spelt.values()):
        good = np.array([all(spelt[i] for i in range(a, a + b)) for a, b in zip(s.tolist(), n.tolist(), strict=True)], bool)
        s, n, k = s[good], n[good], k[good]
    return s, n, k


HITS = "row string, id bigint, n_words bigint, spans array<struct<start:int,stop:int>>, items array<string>"


def _search(docs: DataFrame, p: Phrases | None, shard_bytes: int) -> DataFrame:
    """A row per document: merged spans of words inside occurrences, and the items met."""
    schema = pa.schema([("row", pa.string()), ("id", pa.int64()), ("n_words", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
                        ("items", pa.list_(pa.string()))])

    def shard(name: str, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        w = Words(texts, PUNCT, lower=True)
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        if p is not None:
            starts, lengths, which = occurrences(w, p)
            if len(starts):
                depth = np.zeros(len(w.starts) + 1, np.int64)
                np.add.at(depth, starts, 1)
                np.subtract.at(depth, starts + lengths, 1)
                hit = np.cumsum(depth)[:-1] > 0
                edge = np.concatenate([[True], w.doc[1:] != w.doc[:-1], [True]])
                before, after = np.concatenate([[False], hit[:-1]]), np.concatenate([hit[1:], [False]])
                for a, b in zip(np.flatnonzero(hit & (edge[:-1] | ~before)), np.flatnonzero(hit & (edge[1:] | ~after)) + 1, strict=True):
                    d = int(w.doc[a])
                    spans[d].append({"start": int(a - w.first[d]), "stop": int(b - w.first[d])})
                for d, k in set(zip(w.doc[starts].tolist(), which.tolist(), strict=True)):
                    items[d].update(p.items[k])
        return pa.RecordBatch.from_pydict(
            {"row": [f"{name}-{k}" for k in range(len(ids))], "id": ids, "n_words": np.diff(w.first).astype(np.int64),
             "spans": spans, "items": [sorted(x) for x in items]}, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, n = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size >= shard_bytes:
                    yield shard(f"{part}-{n}", ids, texts)
                    ids, texts, size, n = [], [], 0, n + 1
        if ids:
            yield shard(f"{part}-{n}", ids, texts)

    return docs.select("id", "text").mapInArrow(run, HITS)


def _passes(items: DataFrame, phrase_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of at most ``phrase_bytes`` of text (or one item), one block on the driver at a time."""
    block, size = [], 0
    for r in items.where(F.col("text").isNotNull()).orderBy("item", "text").toLocalIterator():
        text = r["text"].encode()
        if block and size + len(text) > phrase_bytes:
            yield block
            block, size = [], 0
        block.append(("" if r["item"] is None else r["item"], text))
        size += len(text)
    yield block


def find_benchmark(docs: DataFrame, items: DataFrame, size: int = 13, shard_bytes: int = SHARD_BYTES,
                   phrase_bytes: int = PHRASE_BYTES) -> DataFrame:
    """(id, text) and (item string, text) to (id, n_words, spans, items): merged spans of hit words, sorted items met.

    Words are runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.  Null and word-less documents have no spans;
    null and word-less items give no phrase; a null item name counts as "".  Repeated rows are each searched.
    """
    found = [_search(docs, phrases(block, size), shard_bytes) for block in _passes(items, phrase_bytes)]
    if len(found) == 1:
        return found[0].drop("row")
    # Spans of several passes over the same shards: the union of each document's.
    every = scratch(found[0], "hits")
    for f in found[1:]:
        every = every.unionByName(scratch(f, "hits"))
    merged = every.groupBy("row").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = F.aggregate(
        "spans", F.array().cast("array<struct<start:int,stop:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= x["start"]),
                              F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                                       F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                                        F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop")))))
        .otherwise(F.concat(acc, F.array(x))))
    return merged.select("id", "n_words", joined.alias("spans"), "items")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text")
    items = columns(table(spark, sf_dir, "benchmark", "item_id", "text"), item="item_id", text="text")
    return digest(find_benchmark(docs, items.withColumn("item", F.col("item").cast("string"))))


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]).cast("long"))
    return found.withColumn("n_hit", n_hit).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM b WHERE len(w) > 0),
phrase AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k FROM bs),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k FROM ds),
occ AS (SELECT dw.doc_id, dw.p, dw.n, phrase.item FROM dw JOIN phrase USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM occ) GROUP BY doc_id),
met AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN met USING (doc_id)
"""
