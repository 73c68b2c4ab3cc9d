"""N-gram Jaccard join by blocked sparse products (operator 4).

A document is a row of a sparse matrix with a column for every n-gram; two documents link when the overlap of their
rows is large enough for their sizes.  The steps, each of them exact:

1. Columns are counted over all documents.  A column of one document adds to no overlap, so a document can link only
   if the threshold's share of its n-grams stands in two documents or more; the others stay alone.
2. Equal rows become one class.  Of each class the rarest columns are its prefix: linked rows share a prefix column.
3. Classes are put into blocks of similar rows and sizes, none larger than BLOCK_COLUMNS entries but for a single
   row.  Two blocks meet if they share a prefix column and their sizes allow a link, or a block meets itself.
4. The product of two blocks accumulates overlaps over slices of columns and stops when no pair can reach its bound.
   It gives a spanning forest of its links and each row's number of links, never a list of all pairs.
5. Components come from the forests by alternating large and small stars.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import (
    SPACE, Words, block_texts, bucket_bits, by_bucket, columns, distinct, expand, expand_sorted, finger, scratch,
    shuffle_width, squeeze, squeeze_sorted, table, text_blocks, window_hash,
)

BLOCK_BYTES = 4 << 20
BLOCK_COLUMNS = 1 << 16                                                             # entries of the rows of a block
SLICE_CELLS = 1 << 22                                                               # cells of a dense slice


def ngram_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Ascending distinct hashes of the ``size``-word n-grams of each text; a shorter text is one n-gram as a whole."""
    w = Words(texts, SPACE, lower=True)
    h = w.windows(size)
    short = {k: window_hash(w.hash, k) for k in range(1, size)}
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        n = int(b - a)
        if n >= size:
            s = np.sort(h[a:b - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            out.append(short[n][a:a + 1] if n else h[:0])
    return out


def df_class(count: np.ndarray) -> np.ndarray:
    """0 for a column of one document, else a coarse logarithm: only the order by rarity depends on it."""
    return np.where(count < 2, 0, np.minimum(255, 1 + np.floor(4 * np.log2(np.maximum(count, 1))))).astype(np.uint8)


def column_counts(blocks: DataFrame, size: int, bits: int) -> DataFrame:
    """(block, bucket, classes): the document counts, as classes, of each block's distinct columns by bucket.

    Columns travel as 32 bits behind their bucket's; two that fall together only count as more frequent.
    """
    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                h, n = distinct(np.concatenate([*ngram_sets(block_texts(r["sizes"], r["body"]), size), np.zeros(0, np.uint64)]))
                cut = by_bucket(h, bits)
                if cut:
                    yield pa.RecordBatch.from_pydict({
                        "block": [r["block"]] * len(cut), "bucket": pa.array([k for k, _, _ in cut], pa.int32()),
                        "cols": [squeeze_sorted(finger(h[i:j], bits)) for _, i, j in cut],
                        "counts": [squeeze(n[i:j].astype(np.uint32)) for _, i, j in cut]})

    def count(packs: pa.Table) -> pa.Table:
        cols = [expand_sorted(x, np.uint32) for x in packs.column("cols").to_pylist()]
        counts = np.concatenate([expand(x, np.uint32) for x in packs.column("counts").to_pylist()]).astype(np.int64)
        every = np.concatenate(cols)
        order = np.argsort(every)
        every = every[order]
        at = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        kind = df_class(np.add.reduceat(counts[order], at))
        used = every[at]
        return pa.table({"block": packs.column("block"), "bucket": packs.column("bucket"),
                         "classes": pa.array([squeeze(kind[np.searchsorted(used, c)]) for c in cols], pa.binary())})

    return (blocks.mapInArrow(packs, "block string, bucket int, cols binary, counts binary")
            .repartition(shuffle_width(blocks.sparkSession), "bucket").groupBy("bucket")
            .applyInArrow(count, "block string, bucket int, classes binary"))


ROWS = ("id bigint, n bigint, key binary, home bigint, grade int, prefix array<bigint>, body binary")


def text_digest(text: bytes) -> bytes:
    """MD5 of a text in UTF-8, which SQL can take too; null counts as empty."""
    return hashlib.md5(text, usedforsecurity=False).digest()


def matrix_rows(docs: DataFrame, size: int, percent: int, block_bytes: int, digests: bool = False) -> DataFrame:
    """A row per document, with the text's digest if wanted; key, home, grade, prefix and body only where a link is possible (body once per block and set)."""
    bits = bucket_bits(docs.sparkSession)
    blocks = text_blocks(docs, block_bytes)
    grade_base = math.log(100 / (percent - 0.1))

    def rows(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = {r["bucket"]: r["classes"] for r in right.to_pylist()}
        out = {k: [] for k in ("id", "n", "key", "home", "grade", "prefix", "body", *["digest"] * digests)}
        for r in left.to_pylist():
            texts = block_texts(r["sizes"], r["body"])
            sets = ngram_sets(texts, size)
            if digests:
                out["digest"] += [text_digest(t) for t in texts]
            h, _ = distinct(np.concatenate([*sets, np.zeros(0, np.uint64)]))
            kind = np.zeros(len(h), np.uint8)
            for k, i, j in by_bucket(h, bits):
                kind[i:j] = expand(kinds[k], np.uint8)
            seen = set()
            for doc, s in zip(r["ids"], sets, strict=True):
                n = len(s)
                c = kind[np.searchsorted(h, s)]
                vals = [doc, n, None, None, None, None, None]
                if n and doc is not None and 100 * int((c > 0).sum()) >= percent * n:
                    key = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    usual = s[c >= int(np.median(c)) - 4]
                    order = np.lexsort((s, c))[:n - (-(-percent * n // 100)) + 1]
                    vals[2:] = [key, int(usual[0].astype(np.int64)), int(math.log(n) / grade_base),
                                s[order].astype(np.int64).tolist(), None if key in seen else s.tobytes()]
                    seen.add(key)
                for k, v in zip(out, vals, strict=not digests):
                    out[k].append(v)
        return pa.table({"id": pa.array(out["id"], pa.int64()), "n": pa.array(out["n"], pa.int64()),
                         "key": pa.array(out["key"], pa.binary()), "home": pa.array(out["home"], pa.int64()),
                         "grade": pa.array(out["grade"], pa.int32()), "prefix": pa.array(out["prefix"], pa.list_(pa.int64())),
                         "body": pa.array(out["body"], pa.binary()),
                         **({"digest": pa.array(out["digest"], pa.binary())} if digests else {})})

    return blocks.groupBy("block").cogroup(column_counts(blocks, size, bits).groupBy("block")).applyInArrow(
        rows, ROWS + ", digest binary" * digests)


# ------------------------------------------------------------------ products

def overlaps(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether row i of a and row j of b link: percent * union <= 100 * overlap."""
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    need = -(-percent * (na[:, None] + nb[None, :]) // (100 + percent))
    total = np.zeros(need.shape, np.int64)
    fa, fb = np.concatenate(a), np.concatenate(b)
    ia, ib = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
    shared = np.intersect1d(distinct(fa)[0], distinct(fb)[0], assume_unique=True)
    ca, cb = np.searchsorted(shared, fa), np.searchsorted(shared, fb)
    ka = (ca < len(shared)) & (shared[np.minimum(ca, len(shared) - 1)] == fa) if len(shared) else np.zeros(len(fa), bool)
    kb = (cb < len(shared)) & (shared[np.minimum(cb, len(shared) - 1)] == fb) if len(shared) else np.zeros(len(fb), bool)
    ca, ia, cb, ib = ca[ka], ia[ka], cb[kb], ib[kb]
    left_a, left_b = np.bincount(ia, minlength=len(a)), np.bincount(ib, minlength=len(b))
    width = max(64, SLICE_CELLS // (len(a) + len(b)))
    for start in range(0, len(shared), width):
        if not (total + np.minimum(left_a[:, None], left_b[None, :]) >= need).any():
            return np.zeros(need.shape, bool)
        cols = min(width, len(shared) - start)
        x, y = np.zeros((len(a), cols), np.float32), np.zeros((len(b), cols), np.float32)
        for m, c, i, left in ((x, ca, ia, left_a), (y, cb, ib, left_b)):
            at = (c >= start) & (c < start + cols)
            m[i[at], c[at] - start] = 1
            left -= np.bincount(i[at], minlength=len(left))
        total += (x @ y.T).astype(np.int64)
    return total >= need


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix."""
    free = np.ones(len(linked), bool)
    edges = []
    for root in range(len(linked)):
        if not free[root]:
            continue
        free[root] = False
        reached = [root]
        while reached:
            at = reached.pop()
            new = np.flatnonzero(linked[at] & free)
            free[new] = False
            edges += [(at, int(k)) for k in new]
            reached += new.tolist()
    return edges


def block_links(pairs: DataFrame, percent: int) -> DataFrame:
    """Of rows (a, b) of two blocks' documents (b null: a with itself): (a, b, links), links of one class where b is null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):                                         # one product at a time
                row = batch.slice(k, 1).to_pylist()[0]
                a = row["a"]
                own = row["b"] is None
                rows = a if own else a + row["b"]
                sets = [np.frombuffer(x["body"], np.uint64) for x in rows]
                weight = np.array([x["copies"] for x in rows], np.int64)
                linked = np.zeros((len(rows), len(rows)), bool)
                if own:
                    linked[:] = overlaps(sets, sets, percent)
                    np.fill_diagonal(linked, False)
                else:
                    m = overlaps(sets[:len(a)], sets[len(a):], percent)
                    linked[:len(a), len(a):] = m
                    linked[len(a):, :len(a)] = m.T
                links = linked @ weight
                edges = [(rows[i]["key"], rows[j]["key"], 0) for i, j in forest(linked)]
                edges += [(rows[i]["key"], None, int(links[i])) for i in np.flatnonzero(links)]
                if edges:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([e[0] for e in edges], pa.binary()), pa.array([e[1] for e in edges], pa.binary()),
                         pa.array([e[2] for e in edges], pa.int64())], ["a", "b", "links"])

    return pairs.mapInArrow(run, "a binary, b binary, links bigint")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (v, root): every vertex of an edge and its component's smallest vertex."""
    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if small:
            both = both.where("v <= u")
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
        moved = both.join(least, "u").where("v > u" if not small else "v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if small:
            moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
        return moved.where("u != v").distinct()

    now = scratch(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    mark = state(now)
    while mark[0]:
        now = scratch(star(star(now, small=False), small=True), "edges")
        mark, before = state(now), mark
        if mark == before:
            break
    return now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("v"), "root")


def ngram_join(docs: DataFrame, size: int = 4, percent: int = 85, block_bytes: int = BLOCK_BYTES, digests: bool = False) -> DataFrame:
    """(id, text) to (id, n, component, links): n-grams in the set, smallest id reachable by links, number of documents linked to.

    Words are runs other than ASCII white space, A-Z in small letters.  Null, empty and word-less texts have an empty
    set; they and rows with a null id link with nothing (component: the own id).  Repeated rows are documents of
    their own that link with each other.  An empty table gives no rows.

    With ``digests`` come digest (``text_digest`` of the row's text) and root (the component's own key, as different
    components can hold the same id; null for a row without a set that could link).
    """
    extra = ["digest", "root"] if digests else []
    rows = scratch(matrix_rows(docs, size, percent, block_bytes, digests), "rows")
    able = rows.where(F.col("key").isNotNull())
    classes = scratch(able.groupBy("key").agg(
        F.min("id").alias("first"), F.count("*").alias("copies"), F.min("n").alias("n"), F.min("home").alias("home"),
        F.min("grade").alias("grade"), F.first("prefix", True).alias("prefix"), F.first("body", True).alias("body")), "classes")
    groups = (classes.groupBy("home", "grade").agg(F.sum("n").alias("total"))
              .select("home", "grade", F.ceil(F.col("total") / BLOCK_COLUMNS).cast("int").alias("parts")))
    placed = classes.join(groups, ["home", "grade"]).withColumn(
        "block", F.struct("home", "grade", F.pmod(F.xxhash64("key"), F.col("parts")).alias("part")))
    blocks = placed.groupBy("block").agg(F.collect_list(F.struct("key", "copies", "body")).alias("docs"))
    posts = placed.select("block", F.explode("prefix").alias("col")).distinct()
    meet = (posts.select("col", F.col("block").alias("x")).join(posts.select("col", F.col("block").alias("y")), "col")
            .where((F.col("x") < F.col("y")) & (F.abs(F.col("x.grade") - F.col("y.grade")) <= 1)).select("x", "y").distinct())
    across = (meet.join(blocks.select(F.col("block").alias("x"), F.col("docs").alias("a")), "x")
              .join(blocks.select(F.col("block").alias("y"), F.col("docs").alias("b")), "y").select("a", "b"))
    within = blocks.where(F.size("docs") > 1).select(F.col("docs").alias("a"), F.lit(None).cast(across.schema["b"].dataType).alias("b"))
    found = scratch(block_links(across, percent).unionByName(block_links(within, percent)), "links")
    roots = components(found.where(F.col("b").isNotNull()))
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("far"))
    member = (classes.select("key", "first", "copies").join(roots.withColumnRenamed("v", "key"), "key", "left")
              .join(links, "key", "left").withColumn("root", F.coalesce("root", "key")))
    least = member.groupBy("root").agg(F.min("first").alias("component"))
    known = member.join(least, "root").select("key", "root", "component", (F.coalesce("far", F.lit(0)) + F.col("copies") - 1).alias("links"))
    linked = able.select("id", "n", "key", *extra[:1]).join(known, "key").select("id", "n", "component", "links", *extra)
    alone = rows.where(F.col("key").isNull()).select("id", "n", F.col("id").alias("component"), F.lit(0).cast("long").alias("links"),
                                                       *([F.col("digest"), F.lit(None).cast("binary").alias("root")] if digests else []))
    return linked.unionByName(alone)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their 4-word shingles: doc_id, n_shingles, component_id, n_links."""
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text")
    return ngram_join(docs).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                   F.col("component").alias("component_id"), F.col("links").alias("n_links"))
