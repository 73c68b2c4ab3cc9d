"""Spelling variant grouping by FM-index search schemes (operator 13).

Words that are one edit apart agree in the first or in the second half of either.  So a word is looked up twice: its
first half must match exactly and the second may hold one error, and the other way round.  Two FM-indexes serve the two
directions: one reads the delimited vocabulary from left to right, one from right to left, so either half starts at a
delimiter and is matched by narrowing an interval of suffix ranks; from its end the search goes on across the other
half and branches once into a replaced, an added or a missing symbol, until the closing delimiter names the word.

The vocabulary is dealt out by the three symbols at which a search starts (both halves have three at least), so a search
visits one shard.  Keys with more than a shard's symbols are cut into a grid of parts of the index and parts of the
searches.  Counting and search stay in Spark's tasks; no task holds more than a block of texts or a shard.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import columns, scratch, table

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
KEY, SHARD_SYMBOLS = 3, 1 << 17
PIECE_CHARS, HELD_WORDS = 1 << 20, 1 << 18                                          # characters looked at, words counted at a time
RUN, BETWEEN = re.compile("[A-Za-zÀ-ÿ]+"), re.compile("[^A-Za-zÀ-ÿ]")


# ------------------------------------------------------------------ vocabulary

def runs(text: str) -> Counter:
    """Counts of a text's letter runs, A-Z in small letters; long texts in pieces that end between runs."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        cut = BETWEEN.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
        stop = cut.start() if cut else len(text)
        found.update(RUN.findall(text[at:stop].encode("utf-8", "replace").lower().decode("utf-8")))
        at = stop
    return found


def misspelt(name: str, run: str, every: int) -> str:
    """The run, or where ``every`` divides the CRC-32 of name:run, the run without one of its symbols."""
    h = zlib.crc32(f"{name}:{run}".encode())
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, every: int | None = None, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(id, text) to (word, n): words of at least ``length`` symbols that occur ``count`` times or more in all texts."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for i in range(b.num_rows):
                name, text = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                for run, n in runs(text or "").items():
                    if len(run) >= length:
                        word = misspelt("" if name is None else name, run, every) if every else run
                        if len(word) >= length:
                            held[word] = held.get(word, 0) + n
                    if len(held) >= HELD_WORDS:
                        yield rows()
                        held = {}
        if held:
            yield rows()

    return docs.select("id", "text").mapInArrow(counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# -------------------------------------------------------------------- FM-index

SENTINEL, DELIMITER, LETTER = 0, 1, 2                                               # symbols; a letter's own number is its byte + LETTER


def suffix_ranks(t: np.ndarray) -> np.ndarray:
    """The suffix array of a text whose last symbol stands nowhere else, by doubling."""
    n, k = len(t), 1
    rank = t.astype(np.int64)
    while True:
        key = rank * (max(n, 300) + 1)
        key[:n - k] += rank[k:] + 1
        order = np.argsort(key, kind="stable")
        s = key[order]
        step = np.concatenate([[0], np.cumsum(s[1:] != s[:-1])])
        rank[order] = step
        if step[-1] == n - 1:
            return order
        k *= 2


class Index:
    """FM-index over delimited words; matching goes from a word's first symbol to its last (the text holds them backwards)."""

    def __init__(self, words: list[bytes]):
        joined = b"\n".join([b"", *[w[::-1] for w in words], b""])                  # a line end is no letter
        raw = np.frombuffer(joined, np.uint8)
        t = np.where(raw == 10, DELIMITER, raw.astype(np.int64) + LETTER)
        t = np.append(t, SENTINEL)
        order = suffix_ranks(t)
        self.n = len(t)
        last = t[order - 1]                                                         # the Burrows-Wheeler transform
        self.last = last
        self.places = np.sort(last * (self.n + 1) + np.arange(self.n))              # ranks of each symbol, symbol by symbol
        self.letters = np.unique(t[t >= LETTER])
        starts = np.flatnonzero(t == DELIMITER)[:-1]                                # the delimiter before each word
        which = np.full(self.n, -1)
        which[starts] = np.arange(len(words))
        self.word = which[order]                                                    # suffix positions, kept at delimiters only

    def narrow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A bound of the interval of suffixes that have the symbol before those of the given interval."""
        return np.searchsorted(self.places, symbol * (self.n + 1) + at)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(interval number, letter, lo, hi) of every letter that extends each interval."""
        size = hi - lo
        narrow, wide = np.flatnonzero(size <= len(self.letters)), np.flatnonzero(size > len(self.letters))
        n = size[narrow]
        row = np.repeat(lo[narrow] - (np.cumsum(n) - n), n) + np.arange(n.sum())    # the intervals' own symbols
        pair = np.unique(np.repeat(narrow, n) * 512 + self.last[row])
        which = np.concatenate([pair // 512, np.repeat(wide, len(self.letters))])
        letter = np.concatenate([pair % 512, np.tile(self.letters, len(wide))])
        keep = letter >= LETTER
        which, letter = which[keep], letter[keep]
        a, b = self.narrow(letter, lo[which]), self.narrow(letter, hi[which])
        some = b > a
        return which[some], letter[some], a[some], b[some]


def one_error(index: Index, asked: list[bytes], exact: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the asked word, number of the indexed word) for all that are one edit apart behind the first ``exact`` symbols.

    Of the places where a symbol can be added to or taken from a row of equal symbols the last counts, so that no pair
    comes twice.  ``inside``: the asked word stands in the index itself.
    """
    length = np.array([len(w) for w in asked], np.int64)
    first = np.cumsum(length + 1) - length - 1
    flat = np.frombuffer(b"\n".join([*asked, b""]), np.uint8).astype(np.int64)
    flat = np.where(flat == 10, DELIMITER, flat + LETTER)                            # the closing delimiter follows each word
    q = np.arange(len(asked))
    lo = index.narrow(np.full(len(q), DELIMITER), np.zeros(len(q), np.int64))
    hi = index.narrow(np.full(len(q), DELIMITER), np.full(len(q), index.n))
    states: list[tuple] = []
    j = 0
    while len(q):
        able = np.flatnonzero((exact[q] <= j) & ((hi - lo > 1) | ~inside[q]))
        if len(able):
            bq, blo, bhi = q[able], lo[able], hi[able]
            which, letter, a, b = index.branches(blo, bhi)
            of = bq[which]
            other = letter != flat[first[of] + j]
            which, of, a, b = which[other], of[other], a[other], b[other]
            states.append((of, np.full(len(of), j), a, b))                          # a symbol more
            more = j < length[of]
            states.append((of[more], np.full(int(more.sum()), j + 1), a[more], b[more]))                     # another symbol
            gone = j < length[bq]
            gone[gone] = flat[first[bq[gone]] + j + 1] != flat[first[bq[gone]] + j]
            states.append((bq[gone], np.full(int(gone.sum()), j + 1), blo[gone], bhi[gone]))                 # a symbol less
        on = j < length[q]
        q, lo, hi = q[on], lo[on], hi[on]
        symbol = flat[first[q] + j]
        lo, hi = index.narrow(symbol, lo), index.narrow(symbol, hi)
        on = hi > lo
        q, lo, hi = q[on], lo[on], hi[on]
        j += 1
    q, at, lo, hi = (np.concatenate([s[k] for s in states]) if states else np.zeros(0, np.int64) for k in range(4))
    found: list[tuple] = []
    while len(q):                                                                   # the rest of the word exactly
        symbol = flat[first[q] + at]
        lo, hi = index.narrow(symbol, lo), index.narrow(symbol, hi)
        some = hi > lo
        q, at, lo, hi, symbol = q[some], at[some] + 1, lo[some], hi[some], symbol[some]
        done = symbol == DELIMITER
        found.append((q[done], index.word[lo[done]]))
        q, at, lo, hi = q[~done], at[~done], lo[~done], hi[~done]
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(2))


ASKED_AT_ONCE = 8192


def search_shard(shard: pa.Table) -> pa.Table:
    """Of rows (side, word, n, indexed, asked): (word, n_near, best_n, best) of the asked words that have near words."""
    out: list[list] = [[], [], [], []]
    for side in (0, 1):
        part = shard.filter(pc.equal(shard.column("side"), side))
        turn = -1 if side else 1
        rows = zip(*[part.column(c).to_pylist() for c in ("word", "n", "indexed", "asked")], strict=True)
        every = {(w.encode("latin-1"), n, i, a) for w, n, i, a in rows}
        held = sorted((w, n) for w, n, i, _ in every if i)
        asked = sorted(w for w, _, _, a in every if a)
        if not held or not asked:
            continue
        names, counts = [w for w, _ in held], [n for _, n in held]
        index = Index([w[::turn] for w in names])
        own = set(names)
        for k in range(0, len(asked), ASKED_AT_ONCE):
            words = asked[k:k + ASKED_AT_ONCE]
            half = [len(w) // 2 for w in words]
            exact = np.array([len(w) - h if side else h for w, h in zip(words, half, strict=True)])
            q, c = one_error(index, [w[::turn] for w in words], exact, np.array([w in own for w in words]))
            best: dict[int, list] = {}
            for i, m in zip(q.tolist(), c.tolist(), strict=True):
                if side and names[m].startswith(words[i][:half[i]]):                # found from the left already
                    continue
                now = best.setdefault(i, [0, 0, b""])
                now[0] += 1
                if (-counts[m], names[m]) < (-now[1], now[2]):
                    now[1:] = [counts[m], names[m]]
            for i, (near, n, name) in best.items():
                for column, v in zip(out, (words[i].decode("latin-1"), near, n, name.decode("latin-1")), strict=True):
                    column.append(v)
    return pa.table({"word": pa.array(out[0], pa.string()), "n_near": pa.array(out[1], pa.int64()),
                     "best_n": pa.array(out[2], pa.int64()), "best": pa.array(out[3], pa.string())})


def near_words(words: DataFrame, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """(word, n) to (word, n_near, best_n, best): words one inserted, deleted or replaced symbol apart, and the most frequent of them.

    Words are distinct, of letters up to U+00FF and of 2 * KEY symbols at least.
    """
    sided = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")).withColumn(
        "key", F.substring(F.when(F.col("side") == 1, F.reverse("word")).otherwise(F.col("word")), 1, KEY))
    weight = F.sum(F.length("word") + 1)
    keys = scratch(sided.groupBy("side", "key").agg(weight.alias("symbols")), "keys")
    total = keys.agg(F.sum("symbols")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_symbols))
    parts = keys.select("side", "key", F.ceil(F.col("symbols") / shard_symbols).cast("int").alias("parts"))
    dealt = sided.join(parts, ["side", "key"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    common = F.concat_ws("-", F.lit("shard"), F.pmod(F.xxhash64("side", "key"), F.lit(shards)).cast("string"))
    plain = dealt.where("parts = 1").select(common.alias("shard"), "side", "word", "n", F.lit(True).alias("indexed"), F.lit(True).alias("asked"))
    cells = dealt.where("parts > 1").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = lambda p, a: F.concat_ws("-", "side", "key", F.col(p).cast("string"), F.col(a).cast("string")).alias("shard")
    grid = (cells.select(cell("part", "i"), "side", "word", "n", F.lit(True).alias("indexed"), (F.col("part") == F.col("i")).alias("asked"))
            .unionByName(cells.where("part != i").select(cell("i", "part"), "side", "word", "n", F.lit(False).alias("indexed"), F.lit(True).alias("asked"))))
    found = plain.unionByName(grid).groupBy("shard").applyInArrow(search_shard, "word string, n_near bigint, best_n bigint, best string")
    least = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("b")).select(
        "word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): forms followed to the last, twice as far each round."""
    now = scratch(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = scratch(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """(word, n) to (word, form, root, n, n_near, form_n): every word with the near word it is a variant of.

    The form is the most frequent near word (ties: first by code point) if it is ``ratio`` times as frequent; its
    count grows from form to form, so the way to the root ends.  An empty vocabulary gives no rows.
    """
    known = scratch(words.join(near_words(words, shard_symbols), "word", "left").withColumn(
        "takes", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.expr("IF(takes, best, null)").alias("form"),
        F.expr("IF(takes, best_n, null)").alias("form_n")), "near")
    last = roots(known.where(F.col("form").isNotNull()).select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents: word, form, root, n, n_near, form_n.

    Null texts have no words; a null id counts as an empty one in the rule that drops a symbol.  Rows that repeat an
    id or a text count each for themselves.  Texts are read whole, a long one in pieces that end between words; a word
    of a million letters is a word.  An empty table gives no rows.
    """
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text").withColumn("id", F.col("id").cast("string"))
    return variants(scratch(vocabulary(docs, every=199), "vocabulary"))


#: The CRC-32 is folded over bytes with its table of 256 entries, built by its polynomial; near words meet at their holes.
ORACLE_SQL = r"""
WITH RECURSIVE k AS (SELECT list(c ORDER BY b) AS tab FROM (
        SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
        FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
r AS (SELECT id, run, count(*) AS m FROM d WHERE length(run) >= 6 GROUP BY id, run),
h AS (SELECT run, m, xor(4294967295, list_reduce(
          list_prepend(4294967295, list_transform(range(1, octet_length(encode(id || ':' || run)) + 1),
                       lambda i: CAST(('0x' || substr(hex(encode(id || ':' || run)), 2 * i - 1, 2)) AS BIGINT))),
          lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1]))) AS h FROM r, k),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, m FROM h),
v AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
      UNION SELECT x.word, v.word, v.n FROM x JOIN v ON x.less = v.word
      UNION SELECT v.word, x.word, x.n FROM x JOIN v ON x.less = v.word),
b AS (SELECT word, count(*) AS n_near, min({'m': -near_n, 'w': near}) AS best FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.best.m >= 5 * v.n THEN b.best.w END AS form,
             CASE WHEN -b.best.m >= 5 * v.n THEN -b.best.m END AS form_n FROM v LEFT JOIN b ON v.word = b.word),
g AS (SELECT word, form AS root, 1 AS far FROM f WHERE form IS NOT NULL
      UNION ALL SELECT g.word, f.form, g.far + 1 FROM g JOIN f ON g.root = f.word WHERE f.form IS NOT NULL),
t AS (SELECT word, arg_max(root, far) AS root FROM g GROUP BY word)
SELECT f.word, form, coalesce(t.root, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN t ON f.word = t.word
"""
