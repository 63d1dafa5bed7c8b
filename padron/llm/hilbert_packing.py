"""Sequence packing along a space-filling curve.

Documents get a vector of hashed byte strings, projected to a few dimensions and placed on
a Hilbert curve. Sorting by ranges of the curve's key brings similar documents next to
each other, at any density of the curve; each range then cuts its stream of tokens into sequences.
"""

from __future__ import annotations

import functools
import base64
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.common import mix64, shuffle_partitions, small_batches

LENGTH, END = 2048, 1
DIMENSIONS, BITS = 4, 12
#: Bytes of text that a range of the curve holds on average; with more than LARGE in all, ranges grow with the root of the
#: input as their number does, so that 100 TB make 130,000 ranges.
PARTITION_BYTES, LARGE = 24_000_000, 100_000_000_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=1)
def _encoders(path: str):
    """The tokenizer of the file, and a faster encoder that gives the same ids where it applies.

    The fast one takes the same merges from the vocabulary's rank file beside it
    and a pattern without look-ahead, which splits alike unless white space
    repeats. Without that file there is only the tokenizer.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    try:
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(n) for a, n in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", ""), mergeable_ranks=ranks, special_tokens={})
    except (ImportError, FileNotFoundError):
        fast = None
    return slow, fast


_REPEATED_SPACE = re.compile(r"\s\s|<\|")


def token_ids(text: str | None, path: str) -> np.ndarray:
    """A document's ids, the end id last."""
    if not text:
        return np.array([END], np.uint32)
    slow, fast = _encoders(path)
    if fast is None or _REPEATED_SPACE.search(text):
        ids = slow.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    ids.append(END)
    return np.array(ids, np.uint32)


#: The hashed vector's size, and a fixed direction of signs for each of its entries.
BUCKETS = 1024
_SIGNS = np.where(mix64(np.arange(BUCKETS * DIMENSIONS, dtype=np.uint64) + np.uint64(41)) >> np.uint64(63), 1.0, -1.0).reshape(BUCKETS, DIMENSIONS)


def coordinates(text: bytes | None) -> np.ndarray:
    """The document's hashed vector, projected and scaled to 0 ... 2^BITS - 1 in each dimension.

    The vector counts the text's four-byte strings by hash. At length 1, a sum over
    random signs has a spread of 1, so the normal distribution's curve makes the
    cells evenly full.
    """
    if not text:
        return np.zeros(DIMENSIONS, np.int64)
    b = np.frombuffer(text.lower().ljust(4, b"\0"), np.uint8).astype(np.uint32)
    g = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    counts = np.bincount((g * np.uint32(0x9E3779B1)) >> np.uint32(22), minlength=BUCKETS).astype(float)
    total = counts @ _SIGNS / np.sqrt(counts @ counts)
    # a smooth map of the real line onto (0, 1), close to the normal distribution's
    share = 1 / (1 + np.exp(-1.702 * total))
    return np.minimum((share * 2**BITS).astype(np.int64), 2**BITS - 1)


def hilbert_key(points: np.ndarray) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, DIMENSIONS): the coordinates' bits are
    Gray-decoded from the highest down, undoing each level's rotation and reflection."""
    x = points.astype(np.int64).copy()
    n, d = x.shape
    q = 1 << (BITS - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[:, i] & q) != 0
            x[high, 0] ^= p
            low = ~high
            t = (x[low, 0] ^ x[low, i]) & p
            x[low, 0] ^= t
            x[low, i] ^= t
        q >>= 1
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(n, np.int64)
    q = 1 << (BITS - 1)
    while q > 1:
        t[(x[:, d - 1] & q) != 0] ^= q - 1
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(n, np.int64)
    for b in range(BITS - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def with_curve_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text, place, curve) of each row; place tells rows apart by where they were read."""

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            points = np.array([coordinates(t) for t in texts]).reshape(-1, DIMENSIONS)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert_key(points), pa.int64())], ["doc_id", "text", "place", "curve"])

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), F.monotonically_increasing_id().alias("place"))
    return body.mapInArrow(run, "doc_id long, text binary, place long, curve long")


def along_the_curve(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """with_curve_key() in ranges of the curve, sorted within them; PARTITION_BYTES or more a range on average.

    Ties of the curve go by id, text and place, so a dense cell, copies of one text and even equal rows are cut into
    several ranges like any others, and what is alike stays together.
    """
    total = documents.agg(F.sum(F.coalesce(F.octet_length(F.col("text").cast("binary")), F.lit(0)) + 64)).first()[0] or 0
    held = PARTITION_BYTES * max(1.0, (total / LARGE) ** 0.5)
    parts = max(shuffle_partitions(spark), math.ceil(total / held))
    keys = ["curve", "doc_id", "th", "place"]
    return with_curve_key(documents).withColumn("th", F.xxhash64("text")).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)


def last_lengths(n: int) -> list[int]:
    """A stream's last n < LENGTH tokens as sequences of powers of two, which need no padding."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def pack(spark: SparkSession, documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    Documents follow the curve; ties go by id, then text. A partition's tokens
    fill sequences of LENGTH one after the other; what is left at its end fills
    sequences whose lengths are powers of two. Null and empty texts are the end
    id alone. Repeated rows are packed each; null ids stay null. An empty table
    gives no pieces. Columns other than doc_id and text are not looked at.
    """
    path = tokenizer or default_tokenizer()
    small_batches(spark)
    ordered = along_the_curve(spark, documents)

    def run(batches):
        sequence, held, pending = TaskContext.get().partitionId() << 40, 0, []
        out: list[list] = [[] for _ in range(7)]

        def emit(d, start, ids, total, sequence, offset):
            for c, v in zip(out, (d, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")), total, sequence, offset)):
                c.append(v)

        def batch():
            done = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            for c in out:
                c.clear()
            return done

        def settle(lengths):
            """Cut the pending pieces into sequences of the given lengths."""
            nonlocal sequence, held, pending
            for n in lengths:
                offset = 0
                while offset < n:
                    d, start, ids, total = pending[0]
                    take = min(len(ids), n - offset)
                    emit(d, start, ids[:take], total, sequence, offset)
                    offset += take
                    if take == len(ids):
                        pending.pop(0)
                    else:
                        pending[0] = (d, start + take, ids[take:], total)
                sequence += 1
                held -= n

        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = token_ids(t.decode("utf-8", "replace") if t is not None else None, path)
                pending.append((d, 0, ids, len(ids)))
                held += len(ids)
                if held >= LENGTH:
                    settle([LENGTH] * (held // LENGTH))
                if len(out[0]) >= 20_000:
                    yield batch()
        settle(last_lengths(held))
        yield batch()

    return ordered.select("doc_id", "text").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
