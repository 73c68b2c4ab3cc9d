"""Language identification by a bidirectional gated recurrent network over bytes (operator 2).

Texts are cut into segments of SEGMENT bytes.  One gated recurrent cell reads a segment forwards, another backwards;
at every byte position both states together give a distribution over the learned languages.  A document's distribution
is the mean over all its positions.  Training is backpropagation through time over whole segments in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.common import columns, excerpt, fold, scratch, table, utf8

#: The fit's bound: so many documents of each language (lowest hash of the id first), of each an excerpt of FIT_CHARS.
FIT_ROWS, FIT_CHARS = 400, 20_000
SEGMENT, HIDDEN, STEPS, BATCH = 64, 8, 260, 256
#: Every language is learned.  Beyond so many, excerpts get shorter, and states and steps grow with the languages.
USUAL_LANGS = 64
GROUP = 4096                                                                        # segments run together with the usual languages
CELLS = 1 << 23                                                                     # distributions' cells of a training batch's part
NONE = "und"


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the cell's activation; its slope is (1 - |value|) squared.  Gates are (1 + it) / 2."""
    return x / (1 + np.abs(x))


class BiGru:
    """Both directions side by side: gates ``[z | r]`` and candidate of 2 * HIDDEN units, block-diagonal recurrences."""

    def __init__(self, langs: list[str], seed: int = 7, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.langs, self.h = langs, hidden
        h, k = hidden, len(langs)
        init = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        self.w = {"e": init(2, 256, 3 * h, by=0.3),                                 # a byte's share in z, r, candidate
                  "u": init(2, h, 2 * h, by=0.5 / np.sqrt(h)), "c": init(2, h, h, by=0.5 / np.sqrt(h)),
                  "o": init(2 * h, k, by=0.5 / np.sqrt(h)), "b": np.zeros(k, np.float32)}

    # ---- training

    def _forward(self, x: np.ndarray):
        """x: (T, N) bytes; keeps what the way back needs.  Direction 1 reads x in reverse."""
        t, n = x.shape
        h = self.h
        both = np.stack([x, x[::-1]])                                               # (2, T, N)
        pre = np.stack([self.w["e"][d][both[d]] for d in (0, 1)])                   # (2, T, N, 3h)
        s = np.zeros((2, n, h), np.float32)
        keep = []
        states = np.empty((2, t, n, h), np.float32)
        for i in range(t):
            g = (1 + _squash(pre[:, i, :, :2 * h] + s @ self.w["u"])) / 2
            z, r = g[..., :h], g[..., h:]
            c = _squash(pre[:, i, :, 2 * h:] + (r * s) @ self.w["c"])
            keep.append((s, z, r, c))
            s = s + z * (c - s)
            states[:, i] = s
        return both, keep, states

    def _joined(self, states: np.ndarray) -> np.ndarray:
        return np.concatenate([states[0], states[1][::-1]], -1)                     # (T, N, 2h) by position

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, dict]:
        t, n = x.shape
        h = self.h
        both, keep, states = self._forward(x)
        top = self._joined(states)
        logits = top @ self.w["o"] + self.w["b"]
        logits -= logits.max(-1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(-1, keepdims=True)
        weight = mask / max(mask.sum(), 1)
        loss = -float((np.log(p[:, np.arange(n), y] + 1e-9) * weight).sum())
        d = p
        d[:, np.arange(n), y] -= 1
        d *= weight[..., None]
        g = {"o": np.einsum("tnh,tnk->hk", top, d, optimize=True), "b": d.sum((0, 1))}
        dtop = d @ self.w["o"].T
        ds_all = np.stack([dtop[..., :h], dtop[::-1, :, h:]])                       # (2, T, N, h) in reading order
        g["u"], g["c"] = np.zeros_like(self.w["u"]), np.zeros_like(self.w["c"])
        dpre = np.empty((2, t, n, 3 * h), np.float32)
        carry = np.zeros((2, n, h), np.float32)
        for i in range(t - 1, -1, -1):
            s, z, r, c = keep[i]
            ds = ds_all[:, i] + carry
            dc = ds * z * (1 - np.abs(c)) ** 2
            dz = ds * (c - s) * (1 - np.abs(2 * z - 1)) ** 2 / 2
            drs = dc @ self.w["c"].transpose(0, 2, 1)
            dr = drs * s * (1 - np.abs(2 * r - 1)) ** 2 / 2
            dg = np.concatenate([dz, dr], -1)
            g["c"] += (r * s).transpose(0, 2, 1) @ dc
            g["u"] += s.transpose(0, 2, 1) @ dg
            carry = ds * (1 - z) + drs * r + dg @ self.w["u"].transpose(0, 2, 1)
            dpre[:, i, :, :2 * h], dpre[:, i, :, 2 * h:] = dg, dc
        g["e"] = np.zeros_like(self.w["e"])
        for k in (0, 1):
            order = np.argsort(both[k].ravel(), kind="stable")
            used, at = np.unique(both[k].ravel()[order], return_index=True)
            g["e"][k][used] = np.add.reduceat(dpre[k].reshape(-1, 3 * h)[order], at, axis=0)
        return loss, g

    def train(self, segments: np.ndarray, lengths: np.ndarray, labels: np.ndarray, steps: int = STEPS,
              batch: int = BATCH, rate: float = 0.02, seed: int = 11) -> None:
        """Adam over batches with the languages drawn evenly."""
        rng = np.random.default_rng(seed)
        by_label = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        by_label = [x for x in by_label if len(x)]
        part = max(1, CELLS // (segments.shape[1] * len(self.langs)))               # the segments whose gradients are taken at once
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            at = np.concatenate([rng.choice(x, batch // len(by_label) + 1) for x in by_label])
            mask = (np.arange(segments.shape[1])[:, None] < lengths[at][None, :]).astype(np.float32)
            g = None
            for a in range(0, len(at), part):
                some, m1 = at[a:a + part], mask[:, a:a + part]
                _, g1 = self.gradients(segments[some].T, labels[some], m1)
                share = np.float32(m1.sum() / mask.sum())
                g = {k: v * share for k, v in g1.items()} if g is None else {k: v + g1[k] * share for k, v in g.items()}
            lr = rate * min(1.0, 2 * (1 - (step - 1) / steps))
            for k in self.w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.999 * v2[k] + 0.001 * g[k] ** 2
                self.w[k] -= (lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)

    # ---- inference

    def _by_gate(self) -> list[tuple[list[np.ndarray], list[np.ndarray]]]:
        """Of z, r and candidate: byte table and recurrence of either direction."""
        h, w = self.h, self.w
        out = []
        for k in range(3):
            at = slice(k * h, k * h + h)
            out.append(([np.ascontiguousarray(w["e"][d][:, at]) for d in (0, 1)],
                        [np.ascontiguousarray(w["c"][d] if k == 2 else w["u"][d][:, at]) for d in (0, 1)]))
        return out

    def positions(self, x: np.ndarray) -> np.ndarray:
        """(T, N) bytes to (T, N, languages): the distribution at every position."""
        t, n = x.shape
        h = self.h
        tables = self._by_gate()
        x = x.astype(np.int64)
        states = np.empty((2, t, n, h), np.float32)
        s = np.zeros((2, n, h), np.float32)
        gates = np.empty((3, 2, n, h), np.float32)
        add = np.empty((2, n, h), np.float32)
        tmp = np.empty((2, 2, n, h), np.float32)
        z, r, c = gates

        def squash(a: np.ndarray, room: np.ndarray) -> None:
            np.abs(a, out=room)
            np.add(room, 1, out=room)
            np.divide(a, room, out=a)

        def load(k: int, i: int, state: np.ndarray) -> None:
            e, u = tables[k]
            for d in (0, 1):
                np.take(e[d], x[i if d == 0 else t - 1 - i], axis=0, out=gates[k, d], mode="clip")
                np.matmul(state[d], u[d], out=add[d])
            np.add(gates[k], add, out=gates[k])

        for i in range(t):
            load(0, i, s)
            load(1, i, s)
            squash(gates[:2], tmp)
            np.add(gates[:2], 1, out=gates[:2])
            np.multiply(gates[:2], 0.5, out=gates[:2])
            np.multiply(r, s, out=r)
            load(2, i, r)
            squash(c, tmp[0])
            np.subtract(c, s, out=c)
            np.multiply(c, z, out=c)
            np.add(s, c, out=s)
            states[0, i], states[1, t - 1 - i] = s[0], s[1]
        logits = states[0].reshape(t * n, h) @ self.w["o"][:h]
        logits += states[1].reshape(t * n, h) @ self.w["o"][h:]
        logits += self.w["b"]
        np.exp(np.clip(logits, -30, 30, out=logits), out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits.reshape(t, n, -1)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """(documents, languages): the mean distribution over every byte position of every text; zeros for empty ones."""
        out = np.zeros((len(texts), len(self.langs)))
        segments, lengths, owner = cut(texts)
        group = max(1, GROUP * USUAL_LANGS // max(USUAL_LANGS, len(self.langs)))
        for a in range(0, len(segments), group):
            part, n = segments[a:a + group], lengths[a:a + group]
            p = self.positions(np.ascontiguousarray(part.T))
            p *= (np.arange(part.shape[1])[:, None] < n[None, :])[..., None]
            np.add.at(out, owner[a:a + group], p.sum(0))
        return out / np.maximum(out.sum(1, keepdims=True), 1e-9)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments (padded with zero bytes), their lengths and the number of the text each comes from."""
    counts = np.array([-(-len(t) // SEGMENT) for t in texts], np.int64)
    total = int(counts.sum())
    flat = np.zeros(total * SEGMENT, np.uint8)
    lengths = np.full(total, SEGMENT, np.int64)
    at = 0
    for t, k in zip(texts, counts, strict=True):
        flat[at * SEGMENT:at * SEGMENT + len(t)] = np.frombuffer(t, np.uint8)
        at += int(k)
        if k:
            lengths[at - 1] = len(t) - (int(k) - 1) * SEGMENT
    return flat.reshape(total, SEGMENT), lengths, np.repeat(np.arange(len(texts)), counts)


def fit(rows: list[tuple[bytes, str]]) -> BiGru | None:
    """Train from (text, language) rows; None when there are none."""
    langs = sorted({k for t, k in rows if t})
    if not langs:
        return None
    more = -(-len(langs) // USUAL_LANGS)
    model = BiGru(langs, hidden=max(HIDDEN, -(-len(langs) * HIDDEN // USUAL_LANGS)))
    if len(langs) > 1:
        segments, lengths, owner = cut([t for t, _ in rows])
        number = {k: i for i, k in enumerate(langs)}
        model.train(segments, lengths, np.array([number[k] for _, k in rows])[owner], steps=STEPS * more)
    return model


def training_rows(docs: DataFrame, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> list[tuple[bytes, str]]:
    """A bounded sample of (text, language): excerpts of ``fit_rows`` documents of every language, fold 1 held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & (fold(F.col("id")) != 1)
                        & (F.length("text") > 0)).withColumn("o", F.xxhash64("id"))
    by = Window.partitionBy("lang")
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("id").alias("ids"))
    low = (usable.join(F.broadcast(sizes), "lang")                                  # some 4 * fit_rows ids a language go to its rank
           .where(F.col("o") / 2.0 ** 64 + 0.5 <= 4 * fit_rows / F.col("ids")).select("lang", "o", "id").distinct())
    least = scratch(low.select("lang", "id", F.row_number().over(by.orderBy("o", "id")).alias("n"))
                    .where(F.col("n") <= fit_rows).select("lang", "id"), "langid")
    chars = max(SEGMENT, fit_chars * USUAL_LANGS // max(USUAL_LANGS, least.select("lang").distinct().count()))
    got = (usable.join(F.broadcast(least), ["lang", "id"]).select("lang", "o", "id", excerpt("text", chars).alias("text"))
           .withColumn("n", F.row_number().over(by.orderBy("o", "id", "text"))).where(F.col("n") <= fit_rows))
    return [(r["text"].encode(), r["lang"]) for r in sorted(got.select("lang", "n", "text").collect())]


def predict(docs: DataFrame, model: BiGru | None) -> DataFrame:
    """Adds lang_pred and score to rows with ``text``, which other columns pass unchanged.

    A text that is null or has no letter gives ``und`` with score 0.  Columns of these two names are replaced.
    """
    rows = docs.drop("lang_pred", "score")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = names.index("text")
            texts = [t if ok else b"" for t, ok in zip(utf8(b.column(at)), b.column(len(names)).to_pylist(), strict=True)]
            if model is None:
                best, top = [NONE] * len(texts), np.zeros(len(texts))
            else:
                p = model.pooled(texts)
                top = p.max(1) if len(texts) else np.zeros(0)
                best = [model.langs[k] if t else NONE for k, t in zip(p.argmax(1), texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(best, pa.string()), pa.array(top, pa.float64())],
                                             [*names, "lang_pred", "score"])

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.select("*", has_letter.alias("_has_letter")).mapInArrow(run, schema)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter get ``und`` and score 0, as does every text when no language is learned.
    Repeated rows are predicted each; a null id stays null and is not held out.  An empty table gives no rows.
    """
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), id="doc_id", text="text", lang="lang")
    found = predict(docs.select("id", "text"), fit(training_rows(docs)))
    return found.select(F.col("id").alias("doc_id"), F.coalesce(fold(F.col("id")) == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", F.least(F.col("score"), F.lit(1.0)).alias("score"))
