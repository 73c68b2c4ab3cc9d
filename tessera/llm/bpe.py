"""BPE encoding and decoding through a table of distinct words (operator 3).

Texts are split at ASCII white space, which the tokenizer's own rules always separate at and drop, so that a text's
ids are its words' ids in a row.  Blocks of texts keep the word number at every position; a block's distinct words go
to buckets by hash, where each distinct word is encoded once; the ids come back to the blocks and are put at the
words' positions.  Decoding joins ids with the id-to-piece table (as long as the vocabulary, which bounds it).
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bucket_bits, columns, expand, give_back, shuffle_width, squeeze, table, utf8

BLOCK_BYTES = 8 << 20
ENCODE_AT_ONCE = 20_000
_NL = b"\n"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=2)
def load(tokenizer_json: str):
    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_str(tokenizer_json)
    t.no_padding()
    t.no_truncation()
    return t


def _lowered(text: bytes) -> bytes:
    """ASCII capitals in small letters where the tokenizer's later lower-casing makes that the same: not beside
    combining marks (lead bytes CC, CD), which compose with some small letters only, nor near special tokens."""
    return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()


def _bucket(words: list[bytes], bits: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) >> (32 - bits)


def _join_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(_NL.join(words))


def _split_words(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(_NL)


def word_blocks(docs: DataFrame, block_bytes: int, lower: bool = True) -> DataFrame:
    """Blocks of documents: ids, how many words each has, the word numbers in a row, and the distinct words, the most
    frequent first.  Numbers depend on the block's texts alone, so a task that is run again makes the same."""
    schema = pa.schema([("block", pa.string()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                        ("codes", pa.binary()), ("words", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        give_back()

        def row(n, ids, sizes, codes, seen):
            words = sorted(seen)
            codes = np.concatenate([*codes, np.zeros(0, np.uint32)])
            at = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
            order = np.argsort(-np.bincount(codes, minlength=len(words))[at], kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[at[order]] = np.arange(len(words), dtype=np.uint32)
            return pa.RecordBatch.from_pydict(
                {"block": [f"{part}-{n}"], "ids": [ids], "sizes": [sizes], "codes": [squeeze(rank[codes] if len(codes) else codes)],
                 "words": [_join_words([words[k] for k in order.tolist()])]}, schema=schema)

        n, ids, sizes, codes, seen, size = 0, [], [], [], {}, 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ws = (_lowered(t) if lower else t).split()
                new = seen.setdefault
                codes.append(np.fromiter((new(w, len(seen)) for w in ws), np.uint32, len(ws)))
                ids.append(i)
                sizes.append(len(ws))
                size += len(t) + 1
                if size >= block_bytes:
                    yield row(n, ids, sizes, codes, seen)
                    n, ids, sizes, codes, seen, size = n + 1, [], [], [], {}, 0
        if ids:
            yield row(n, ids, sizes, codes, seen)

    spark = docs.sparkSession
    return (docs.select("id", "text").mapInArrow(make, "block string, ids array<bigint>, sizes array<int>, codes binary, words binary")
            .repartition(shuffle_width(spark), "block"))


def _encode_words(words: Iterable[bytes], tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in a row, and how many each word has; encodings live for some words at a time only."""
    flat, lens, rest = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], iter(words)
    while some := list(itertools.islice(rest, ENCODE_AT_ONCE)):
        got = [e.ids for e in tokenizer.encode_batch([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)]
        flat.append(np.fromiter(itertools.chain.from_iterable(got), np.uint32))
        lens.append(np.fromiter(map(len, got), np.uint32, len(got)))
    return np.concatenate(flat), np.concatenate(lens)


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The positions of the ranges in a row."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


def encoded_words(blocks: DataFrame, tokenizer_json: str, bits: int) -> DataFrame:
    """The blocks' distinct words by bucket, each distinct word of a bucket encoded once: (block, bucket, ids, lens)."""
    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, blob in zip(b.column("block").to_pylist(), b.column("words").to_pylist(), strict=True):
                words = [w for w in _split_words(blob) if w]
                if not words:
                    continue
                bucket = _bucket(words, bits)
                order = np.argsort(bucket, kind="stable")
                used, at = np.unique(bucket[order], return_index=True)
                parts = [[words[k] for k in p] for p in np.split(order, at[1:])]
                yield pa.RecordBatch.from_pydict({"block": [block] * len(used), "bucket": pa.array(used, pa.int32()),
                                                  "words": [_join_words(p) for p in parts]})

    def encode(packs: pa.Table) -> pa.Table:
        tokenizer = load(tokenizer_json)
        number: dict[bytes, int] = {}
        parts = []                                                                  # a block's words by their numbers: the words themselves once
        for x in packs.column("words"):
            words = _split_words(x.as_py())
            parts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words)))
        flat, lens = _encode_words(number, tokenizer)
        del number
        starts = np.cumsum(lens, dtype=np.int64) - lens
        out = pa.table({
            "block": packs.column("block"),
            "bucket": packs.column("bucket"),
            "ids": pa.array([squeeze(flat[_ranges(starts[p], lens[p].astype(np.int64))]) for p in parts], pa.binary()),
            "lens": pa.array([squeeze(lens[p]) for p in parts], pa.binary())})
        give_back()
        return out

    spark = blocks.sparkSession
    return (blocks.mapInArrow(packs, "block string, bucket int, words binary")
            .repartition(shuffle_width(spark), "bucket").groupBy("bucket")
            .applyInArrow(encode, "block string, bucket int, ids binary, lens binary"))


def pieces(tokenizer_json: str) -> list[str]:
    """The id-to-piece table by id."""
    vocab = load(tokenizer_json).get_vocab(with_added_tokens=True)
    out = [""] * (max(vocab.values(), default=-1) + 1)
    for piece, k in vocab.items():
        out[k] = piece
    return out


def encode_decode(docs: DataFrame, tokenizer_path: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, text) to (id, ids, decoded): ids as little-endian unsigned 32-bit integers, decoded from those ids.

    Null texts count as empty; empty texts have no ids and decode to an empty text.  Repeated rows come back each.
    """
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:        # read on the driver, sent with the tasks
        tokenizer_json = f.read()
    bits = bucket_bits(docs.sparkSession)
    table_of_pieces = [p.encode() for p in pieces(tokenizer_json)]
    blocks = word_blocks(docs, block_bytes)
    encoded = encoded_words(blocks, tokenizer_json, bits)

    def put_back(left: pa.Table, right: pa.Table) -> pa.Table:
        ids_out, bodies, texts = [], [], []
        got = {r["bucket"]: (r["ids"], r["lens"]) for r in right.to_pylist()}
        for r in left.to_pylist():
            words = _split_words(r["words"])
            words = words if words != [b""] else []
            lens = np.zeros(len(words), np.int64)
            bucket = _bucket(words, bits) if words else np.zeros(0, np.int64)
            flat, starts = [], np.zeros(len(words), np.int64)
            base = 0
            for k, at in zip(*_groups(bucket), strict=True):
                blob, n = got[int(k)]
                n = expand(n, np.uint32).astype(np.int64)
                if len(n) != len(at):
                    raise RuntimeError("the words of a block differ from those that were encoded")
                flat.append(expand(blob, np.uint32))
                lens[at] = n
                starts[at] = base + np.cumsum(n) - n
                base += len(flat[-1])
            flat = np.concatenate([*flat, np.zeros(0, np.uint32)])
            spelt = [b" ".join([table_of_pieces[x] for x in flat[a:a + n].tolist()]) for a, n in zip(starts, lens, strict=True)]
            codes = expand(r["codes"], np.uint32) if words else np.zeros(0, np.uint32)
            stop = 0
            for doc, size in zip(r["ids"], r["sizes"], strict=True):
                c = codes[stop:stop + size]
                stop += size
                n = lens[c]
                ids_out.append(doc)
                bodies.append(flat[_ranges(starts[c], n)].astype("<u4").tobytes())
                texts.append(b" ".join([spelt[k] for k in c[n > 0].tolist()]))
            del words, spelt, flat, codes
        give_back()
        return pa.table({"id": pa.array(ids_out, pa.int64()), "ids": pa.array(bodies, pa.binary()),
                         "decoded": pa.array(texts, pa.binary()).cast(pa.string())})

    return (blocks.groupBy("block").cogroup(encoded.groupBy("block"))
            .applyInArrow(put_back, "id bigint, ids binary, decoded string"))


def _groups(values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(values, kind="stable")
    used, at = np.unique(values[order], return_index=True)
    return used, (np.split(order, at[1:]) if len(used) else [])


def decode(ids: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(id, ids array<int>) to (id, decoded) by a join with the id-to-piece table; unknown ids are skipped.

    The table has as many rows as the vocabulary and is broadcast.  ``id`` names a row; a null array decodes to "".
    """
    spark = ids.sparkSession
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as f:
        known = pieces(f.read())
    lookup = spark.createDataFrame(list(enumerate(known)), "token int, piece string")
    spelt = (ids.select("id", F.posexplode("ids").alias("at", "token")).join(F.broadcast(lookup), "token")
             .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("p"))
             .select("id", F.array_join(F.col("p.piece"), " ").alias("decoded")))
    return ids.select("id").join(spelt, "id", "left").select("id", F.coalesce("decoded", F.lit("")).alias("decoded"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document: doc_id, n_tokens, ids_sha256, decoded_sha256 (null text: as empty; null id stays null)."""
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text")
    done = encode_decode(docs)
    return done.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
