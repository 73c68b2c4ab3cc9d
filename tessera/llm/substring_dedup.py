"""Removal of repeated word passages by level-wise doubling (operator 7).

A window is ``size`` words of one document; every word inside a window that also starts earlier (smaller id, or the
same document and an earlier start) goes.  Levels of size / 4, size / 2 and size words are run one after the other:

* Level 1: each window is stood for by its least window of size / 4 words (by hash; equal windows agree on it).
* Level 2: where that one occurs twice or more, the twice as long window around it, inside the same whole window.
* Level 3: where that one occurs twice or more, the whole window, with its first occurrence.

What does not recur at one level never reaches the next.  Levels 1 and 2 only sieve; level 3 decides by 64-bit hashes
of the words.  Texts are dealt once, in blocks; at every level a block sends each distinct window once to the bucket of
its hash, and gets back those that recur, so that a passage in any number of documents is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (
    SPACE, Words, block_texts, bucket_bits, by_bucket, columns, distinct, expand, expand_sorted, finger, is_member,
    shuffle_width, squeeze, squeeze_sorted, table, text_blocks,
)

BLOCK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).min


def least_in_window(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the (leftmost) least of the ``width`` values from each position on."""
    best, span = np.arange(len(h)), 1

    def merge(by: int) -> np.ndarray:
        right = np.append(best[by:], best[-1:].repeat(min(by, len(best))))[:len(best)]
        return np.where(h[best] <= h[right], best, right)

    while span * 2 <= width:
        best, span = merge(span), span * 2
    return merge(width - span) if span < width else best


class Passages:
    """The whole windows of a block and the shorter windows that stand for them."""

    def __init__(self, row: dict, size: int):
        self.texts = block_texts(row["sizes"], row["body"])
        self.ids = [NO_ID if i is None else i for i in row["ids"]]
        self.words = w = Words(self.texts, SPACE)
        self.size, base = size, size // 4
        self.at = np.flatnonzero(w.fits(size))                                      # where whole windows start
        if not len(self.at):
            self.anchor = self.longer = self.at
            return
        self.h1, self.h2 = w.windows(base), w.windows(2 * base)
        self.anchor = least_in_window(self.h1, size - base + 1)[self.at]
        offset = self.anchor - self.at
        self.longer = np.where(offset <= size - 2 * base, self.anchor, self.anchor - base)

    def level(self, k: int) -> np.ndarray:
        """Hash, for every whole window, of what stands for it at level 1 or 2, or of itself."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        return self.h1[self.anchor] if k == 1 else self.h2[self.longer] if k == 2 else self.words.windows(self.size)[self.at]

    def places(self, k: int) -> np.ndarray:
        return self.anchor if k == 1 else self.longer


def _key(h: np.ndarray, bits: int) -> np.ndarray:
    """What levels 1 and 2 know of a hash: its bucket and the 32 bits behind."""
    return h >> np.uint64(32 - bits)


def _received(right: pa.Table, dtype, bits: int | None) -> dict[str, np.ndarray]:
    """Ascending hashes (or keys) that came back, by block."""
    out: dict[str, list] = {}
    for r in sorted(right.to_pylist(), key=lambda r: r["bucket"]):
        h = expand_sorted(r["again"], dtype)
        if bits is not None:
            h = (np.uint64(r["bucket"]) << np.uint64(32)) | h.astype(np.uint64)
        out.setdefault(r["block"], []).append(h)
    return {k: np.concatenate(v) for k, v in out.items()}


SIEVE_OUT, SIEVE_IN = "block string, bucket int, hashes binary, counts binary", "block string, bucket int, again binary"


def _sieve_rows(block: str, p: Passages, k: int, alive: np.ndarray, bits: int) -> pa.RecordBatch:
    """Distinct windows of level ``k`` that stand for living whole windows, with their numbers of places."""
    places = distinct(p.places(k)[alive])[0]
    h, n = distinct((p.h1 if k == 1 else p.h2)[places]) if len(places) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    cut = by_bucket(h, bits)
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(cut), pa.string()), pa.array([c for c, _, _ in cut], pa.int32()),
         pa.array([squeeze_sorted(finger(h[i:j], bits)) for _, i, j in cut], pa.binary()),
         pa.array([squeeze(np.minimum(n[i:j], 2).astype(np.uint8)) for _, i, j in cut], pa.binary())],
        ["block", "bucket", "hashes", "counts"])


def _recurring(packs: pa.Table) -> pa.Table:
    """Of a bucket: which of each block's windows occur twice or more over all blocks."""
    sent = [expand_sorted(x, np.uint32) for x in packs.column("hashes").to_pylist()]
    counts = np.concatenate([expand(x, np.uint8) for x in packs.column("counts").to_pylist()]).astype(np.int64)
    every = np.concatenate(sent)
    order = np.argsort(every)
    every = every[order]
    at = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    again = every[at][np.add.reduceat(counts[order], at) > 1]
    back = [x[is_member(x, again)] for x in sent]
    keep = [k for k, x in enumerate(back) if len(x)]
    return pa.table({"block": packs.column("block").take(pa.array(keep, pa.int64())),
                     "bucket": packs.column("bucket").take(pa.array(keep, pa.int64())),
                     "again": pa.array([squeeze_sorted(back[k]) for k in keep], pa.binary())})


WHOLE_OUT = "block string, bucket int, hashes binary, ids binary, starts binary"


def _whole_rows(block: str, p: Passages, alive: np.ndarray, bits: int) -> pa.Table:
    """Distinct living whole windows with their first place (id, start in words) in the block."""
    at = p.at[alive]
    h = p.level(3)[alive]
    doc = p.words.doc[at]
    ids, start = np.array(p.ids, np.int64)[doc], (at - p.words.first[doc]).astype(np.uint32)
    order = np.lexsort((start, ids, h))
    h, ids, start = h[order], ids[order], start[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    h, ids, start = h[first], ids[first], start[first]
    cut = by_bucket(h, bits)
    return pa.table({"block": pa.array([block] * len(cut), pa.string()), "bucket": pa.array([c for c, _, _ in cut], pa.int32()),
                     "hashes": pa.array([squeeze_sorted(h[i:j]) for _, i, j in cut], pa.binary()),
                     "ids": pa.array([squeeze(ids[i:j]) for _, i, j in cut], pa.binary()),
                     "starts": pa.array([squeeze(start[i:j]) for _, i, j in cut], pa.binary())})


def _later(packs: pa.Table) -> pa.Table:
    """Of a bucket: which of each block's whole windows start earlier in another block."""
    sent = [expand_sorted(x, np.uint64) for x in packs.column("hashes").to_pylist()]
    ids = np.concatenate([expand(x, np.int64) for x in packs.column("ids").to_pylist()])
    start = np.concatenate([expand(x, np.uint32) for x in packs.column("starts").to_pylist()])
    every = np.concatenate(sent)
    order = np.lexsort((start, ids, every))
    e = every[order]
    at = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
    lead = np.repeat(order[at], np.diff(np.append(at, len(e))))                     # the first place of each entry's window
    later = np.zeros(len(every), bool)
    later[order] = (ids[order] != ids[lead]) | (start[order] != start[lead])
    stops = np.cumsum([len(x) for x in sent])
    back = [x[later[b - len(x):b]] for x, b in zip(sent, stops, strict=True)]
    keep = [k for k, x in enumerate(back) if len(x)]
    return pa.table({"block": packs.column("block").take(pa.array(keep, pa.int64())),
                     "bucket": packs.column("bucket").take(pa.array(keep, pa.int64())),
                     "again": pa.array([squeeze_sorted(back[k]) for k in keep], pa.binary())})


def covered(p: Passages, later: np.ndarray) -> np.ndarray:
    """The block's words inside windows that start earlier elsewhere (``later``: ascending hashes) or in the block."""
    out = np.zeros(len(p.words.starts) + 1, np.int64)
    if not len(p.at):
        return out[:-1] > 0
    h = p.level(3)
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    gone = is_member(h, later)
    here = np.flatnonzero(is_member(h, twice))
    if len(here):
        doc = p.words.doc[p.at[here]]
        ids, start = np.array(p.ids, np.int64)[doc], p.at[here] - p.words.first[doc]
        order = np.lexsort((start, ids, h[here]))
        x = h[here][order]
        at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        lead = np.repeat(order[at], np.diff(np.append(at, len(x))))
        gone[here[order]] |= (ids[order] != ids[lead]) | (start[order] != start[lead])
    np.add.at(out, p.at[gone], 1)
    np.subtract.at(out, p.at[gone] + p.size, 1)
    return np.cumsum(out)[:-1] > 0


def remove_repeats(docs: DataFrame, size: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, text) to (id, n_words, n_removed, kept): the words not covered, joined by single blanks.

    ``size`` is a multiple of four.  Words are runs other than ASCII white space, compared unchanged.  Null and empty
    texts have no words.  A null id comes before all others.  Rows that repeat an id at the same starts are not
    earlier than one another; rows that repeat a text under other ids lose it but for the least.
    """
    if size < 4 or size % 4:
        raise ValueError("size is a multiple of four")
    spark = docs.sparkSession
    bits, width = bucket_bits(spark), shuffle_width(spark)
    blocks = text_blocks(docs, block_bytes)

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                p = Passages(r, size)
                yield _sieve_rows(r["block"], p, 1, np.ones(len(p.at), bool), bits)

    def second_level(left: pa.Table, right: pa.Table) -> pa.Table:
        back = _received(right, np.uint32, bits)
        rows = []
        for r in left.to_pylist():
            p = Passages(r, size)
            alive = is_member(_key(p.level(1), bits), back.get(r["block"], np.zeros(0, np.uint64)))
            rows.append(_sieve_rows(r["block"], p, 2, alive, bits))
        return pa.Table.from_batches(rows)

    def third_level(left: pa.Table, right: pa.Table) -> pa.Table:
        back = _received(right, np.uint32, bits)
        rows = []
        for r in left.to_pylist():
            p = Passages(r, size)
            alive = is_member(_key(p.level(2), bits), back.get(r["block"], np.zeros(0, np.uint64)))
            rows.append(_whole_rows(r["block"], p, alive, bits))
        return pa.concat_tables(rows)

    def cut_out(left: pa.Table, right: pa.Table) -> pa.Table:
        back = _received(right, np.uint64, None)
        ids, n_words, n_removed, kept = [], [], [], []
        for r in left.to_pylist():
            p = Passages(r, size)
            gone = covered(p, back.get(r["block"], np.zeros(0, np.uint64)))
            first = p.words.first
            for k, (doc, text) in enumerate(zip(r["ids"], p.texts, strict=True)):
                words, out = text.split(), gone[first[k]:first[k + 1]]
                removed = int(out.sum())
                ids.append(doc)
                n_words.append(len(words))
                n_removed.append(removed)
                kept.append(b" ".join([w for w, x in zip(words, out.tolist(), strict=True) if not x] if removed else words))
        return pa.table({"id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    def recur(packs: DataFrame) -> DataFrame:
        return packs.repartition(width, "bucket").groupBy("bucket").applyInArrow(_recurring, SIEVE_IN)

    def with_blocks(back: DataFrame):
        return blocks.groupBy("block").cogroup(back.groupBy("block"))

    quarter = recur(blocks.mapInArrow(first_level, SIEVE_OUT))
    half = recur(with_blocks(quarter).applyInArrow(second_level, SIEVE_OUT))
    whole = with_blocks(half).applyInArrow(third_level, WHOLE_OUT)
    later = whole.repartition(width, "bucket").groupBy("bucket").applyInArrow(_later, SIEVE_IN)
    return with_blocks(later).applyInArrow(cut_out, "id bigint, n_words bigint, n_removed bigint, kept string")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words outside repeated 20-word windows: doc_id, n_words, n_removed, kept_sha256."""
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text")
    return remove_repeats(docs).select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS p FROM words WHERE len(w) >= 20),
windows AS (SELECT s.doc_id, s.p, array_to_string(list_slice(w.w, s.p, s.p + 19), ' ') AS k FROM starts s JOIN words w USING (doc_id)),
firsts AS (SELECT k, min(doc_id) AS d, arg_min(p, (doc_id, p)) AS p FROM windows GROUP BY k),
gone AS (SELECT DISTINCT x.doc_id, unnest(range(x.p, x.p + 20)) AS i FROM windows x JOIN firsts f USING (k)
         WHERE x.doc_id <> f.d OR x.p <> f.p),
lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
kept AS (SELECT w.doc_id, w.w, coalesce(l.gone, []) AS gone FROM words w LEFT JOIN lists l USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM kept
"""
