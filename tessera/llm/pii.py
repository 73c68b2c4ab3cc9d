"""Personal data by weak supervision (operator 6).

Base patterns give the certain spans.  Wider patterns propose further candidates of the same kinds; labelers of three
sorts (pattern, gazetteer, context) vote on every span for, against or not at all.  The votes of all documents are
counted by pattern of votes, a table bounded by the number of patterns.  Expectation-maximisation on it estimates how
reliable each labeler is and how likely each pattern marks personal data; a logistic classifier trained on these
probabilities decides on the candidates.  Base spans stay whatever it says.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import columns, scratch, table

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9                                                                        # a candidate's least probability

# Base patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Wider patterns.
_WIDE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}"
                        r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]{2,63}){1,4}", re.I),
    "ip": re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{4}[ ./-]?){3}[0-9]{4}(?![0-9])|(?<![0-9])3[47][0-9]{13}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+(])(?:\+|00)?(?:[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
                        r"|(?<![0-9+])(?:\+|00)[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,4}(?![0-9])"
                        r"|(?<![0-9.+(-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
}
# Gazetteers and cue words.
TOP_DOMAINS = frozenset("com org net edu gov int mil io de fr es uk us it nl eu ch at ca au jp info biz dev example test".split())
DIAL_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 61 81 82 86 90 91".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "2221", "2720")
CUES = {
    "email": frozenset("email e-mail mail contact write correo courriel from to cc reply".split()),
    "ip": frozenset("ip address host server from client addr ipv4 ipv6 adresse".split()),
    "card": frozenset("card visa mastercard amex credit debit carte karte tarjeta pan".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell telefon telefono handy whatsapp".split()),
}
AGAINST = frozenset("version v ver release isbn issn section chapter id no nr number order invoice total price fig table".split())
LABELERS = ("shape", "gazetteer", "cue", "against", "edges", "digits")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base spans, by start and then kind as listed."""
    out = []
    stop = 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            a = at
            while a > stop and text[a - 1] in _LOCAL:
                a -= 1
            if a < at:
                out.append((a, 0, m.end()))
                stop = m.end()
        at = text.find("@", max(at + 1, stop))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = [int(c) for c in m.group() if c not in " -"]
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def luhn(digits: list[int]) -> bool:
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0


def wide_spans(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Candidates of the wider patterns that touch no base span and not each other (earlier start, then kind, first)."""
    found = sorted((m.start(), k, m.end()) for k, kind in enumerate(KINDS) for m in _WIDE[kind].finditer(text))
    out, stop, taken = [], 0, [(a, b) for a, _, b in base]
    for a, k, b in found:
        if a >= stop and not any(x < b and a < y for x, y in taken):
            out.append((a, KINDS[k], b))
            stop = b
    return out


def votes(text: str, start: int, kind: str, end: int) -> str:
    """One of + - 0 for each labeler."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    left = re.findall(r"[^\W_]+(?:-[^\W_]+)?", text[max(0, start - 40):start].lower())[-2:]
    before, after = text[start - 1:start], text[end:end + 1]
    if kind == "email":
        tail = re.split(r"[.)\]} ]", span.lower())[-1]
        shape = "+" if re.fullmatch(r"[a-z]{2,}", tail) else "-"
        gazetteer = "+" if tail in TOP_DOMAINS else "0"
    elif kind == "ip":
        parts = span.split(".")
        shape = "+" if ":" in span or all(p == str(int(p or 0)) for p in parts if len(p) < 9) and len(parts) == 4 else "-"
        gazetteer = "-" if parts[0] in ("0", "1", "2") and len(digits) <= 5 else "+" if ":" in span or len(digits) >= 8 else "0"
    elif kind == "card":
        shape = "+" if 12 <= len(digits) <= 19 and luhn([int(c) for c in digits]) else "-"
        gazetteer = "+" if digits.startswith(ISSUERS) else "-"
    else:
        shape = "+" if 9 <= len(digits) <= 15 and ("(" in span or span[0] in "+0") else "0"
        lead = re.match(r"(?:\+|00)([0-9]{1,3})", span)
        gazetteer = "0" if not lead else "+" if any(lead.group(1)[:k] in DIAL_CODES for k in (1, 2)) else "-"
    cue = "+" if any(w in CUES[kind] for w in left) else "0"
    against = "-" if left and left[-1] in AGAINST or after in ("%", "€", "$") and after else "0"
    edges = "-" if (before.isalnum() or after.isalnum()) else "+"
    variety = "0" if kind == "email" else "-" if len(set(digits)) <= 2 else "+"
    return shape + gazetteer + cue + against + edges + variety


SPANS = "id bigint, base array<struct<start:int,kind:string,end:int,votes:string>>, wide array<struct<start:int,kind:string,end:int,votes:string>>"


def propose(docs: DataFrame) -> DataFrame:
    """(id, text) to (id, base, wide): base spans and further candidates with their votes."""
    entry = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("votes", pa.string())]))
    schema = pa.schema([("id", pa.int64()), ("base", entry), ("wide", entry)])
    any_of = re.compile(r"[0-9@]|[(\[{]at[)\]}]", re.I)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, wide = [], []
            for text in b.column(1).to_pylist():
                x = base_spans(text) if text and any_of.search(text) else []
                y = wide_spans(text, x) if text and any_of.search(text) else []
                for spans, out in ((x, base), (y, wide)):
                    out.append([{"start": s, "kind": k, "end": e, "votes": votes(text, s, k, e)} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, entry), pa.array(wide, entry)], schema=schema)

    return docs.select("id", "text").mapInArrow(run, SPANS)


Pattern = tuple[str, str, int, int]                                                 # kind, votes, base spans, candidates


def reliabilities(patterns: list[Pattern], rounds: int = 60) -> tuple[dict, dict]:
    """EM over vote patterns, base spans being known to be personal data.

    Gives labeler -> P(vote | personal), P(vote | not), and (kind, votes) -> probability for a candidate.
    """
    values = "+0-"
    kinds = sorted({p[0] for p in patterns})
    sure, open_ = (np.array([p[k] for p in patterns], float) for k in (2, 3))
    code = np.array([[values.index(v) for v in p[1]] for p in patterns])
    kind = np.array([kinds.index(p[0]) for p in patterns])
    net = np.array([p[1].count("+") - 2 * p[1].count("-") for p in patterns])
    post = np.clip(0.5 + net / 8, 0.05, 0.95)                                       # start from the majority
    theta = np.zeros((2, len(LABELERS), 3))
    for _ in range(rounds):
        prior = np.array([(post[kind == k] @ open_[kind == k] + 1) / (open_[kind == k].sum() + 2) for k in range(len(kinds))])
        for y, w in ((0, (1 - post) * open_), (1, post * open_ + sure)):
            for j in range(len(LABELERS)):
                counts = np.array([w[code[:, j] == v].sum() for v in range(3)]) + (np.array([2, 2, 1]) if y else np.array([1, 2, 2]))
                theta[y, j] = counts / counts.sum()
        odds = (np.log(prior) - np.log(1 - prior))[kind]
        for j in range(len(LABELERS)):
            odds = odds + np.log(theta[1, j, code[:, j]]) - np.log(theta[0, j, code[:, j]])
        post = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    names = {label: {"for": dict(zip(values, theta[1, j].tolist(), strict=True)), "against": dict(zip(values, theta[0, j].tolist(), strict=True))}
             for j, label in enumerate(LABELERS)}
    return names, {p[:2]: float(x) for p, x in zip(patterns, post, strict=True)}


def classifier(patterns: list[Pattern], target: dict) -> dict:
    """Logistic regression of EM's probabilities on kind and single votes: (kind, votes) -> probability."""
    kinds = sorted({p[0] for p in patterns})
    x = np.array([[1.0] + [float(p[0] == z) for z in kinds] + [float(v == s) for v in p[1] for s in "+-"] for p in patterns])
    y = np.array([(p[2] + target[p[:2]] * p[3]) / (p[2] + p[3]) for p in patterns])
    n = np.array([math.log1p(p[2] + p[3]) for p in patterns])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (q - y)) + 0.05 * w
        h = (x * (n * q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {p[:2]: float(z) for p, z in zip(patterns, q, strict=True)}


def find_pii(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(id, text) to (id, base, spans): base spans, and all spans with the candidates taken in, by start and kind.

    Null texts count as empty and have no spans; repeated rows and null ids are treated like all others.
    """
    found = scratch(propose(docs), "pii")
    every = found.select(F.explode("base").alias("s"), F.lit(1).alias("sure")).unionByName(
        found.select(F.explode("wide").alias("s"), F.lit(0).alias("sure")))
    counted = every.groupBy("s.kind", "s.votes").agg(F.sum("sure").alias("base"), F.count("*").alias("n")).collect()
    patterns = sorted((r["kind"], r["votes"], r["base"], r["n"] - r["base"]) for r in counted)    # at most 4 * 3 ** 6
    taken: list[str] = []
    if patterns:
        _, target = reliabilities(patterns)
        taken = [f"{k}{v}" for (k, v), x in classifier(patterns, target).items() if min(x, target[k, v]) >= accept]
    order = F.array(*[F.lit(k) for k in KINDS])

    def placed(c):
        return F.array_sort(F.transform(c, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"),
                                                              s["end"].alias("end"), s["kind"].alias("kind"))))

    more = F.filter("wide", lambda s: F.concat(s["kind"], s["votes"]).isin(taken)) if taken else F.slice("wide", 1, 0)
    return found.select("id", placed(F.col("base")).alias("base"), placed(F.concat("base", more)).alias("spans"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The numbers count base spans; ``spans`` holds base spans and those the method adds (``n_added``).
    """
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text")
    text_of = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_pii(docs).select(F.col("id").alias("doc_id"), *[number(k) for k in KINDS],
                                 F.sha2(text_of("base").cast("binary"), 256).alias("base_sha256"), text_of("spans").alias("spans"),
                                 (F.size("spans") - F.size("base")).cast("long").alias("n_added"))
