"""Packing of whole documents by patterns of lengths.

The histogram of lengths is all that the plan needs: patterns of few lengths that add up to a
full sequence are enumerated, a non-negative least squares fit says how often each is used,
the numbers are rounded, and what is left over is placed by best fit, lengths falling, on
counts as well. The plan deals the k-th document of each length to a place in a sequence; the
documents are numbered by length where they lie, so neither texts nor tokens are shuffled.
"""

from __future__ import annotations

import bisect
import functools
import unicodedata
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from padron.llm.common import materialize, small_batches

LENGTH, END = 2048, 0
#: Steps of the least squares fit, and the least lengths that a pattern's longest part may have to exceed.
STEPS = 300
LEAST = (0, LENGTH // 2, LENGTH * 3 // 5)
#: Words whose ids a task remembers.
REMEMBERED = 1_000_000
#: Signs that are looked up apart from the word before them.
ENDINGS = frozenset(".,;:!?|")
#: The first letter beyond Latin ones.
LATIN = "\u0250"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---- tokens ----


@functools.lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=1)
def _word_encoder(path: str):
    """A faster encoder of one word in lower case, written with a blank for the mark that ends it.

    The vocabulary's numbers are the ranks of its merges, and the marked single bytes come
    first, so the blank joins its byte before anything else is merged.
    """
    import json

    import tiktoken

    # fixed values: the printable signs that stand for bytes in the vocabulary are those that print, then U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(path) as f:
        known = json.load(f)
    special = {t["content"] for t in known["added_tokens"]}
    ranks = {}
    for token, n in known["model"]["vocab"].items():
        if token not in special:
            ends = token.endswith("</w>") and len(token) > 4
            ranks[bytes(byte[c] for c in (token[:-4] if ends else token)) + b" " * ends] = n
    return tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})


class _Words(dict):
    """The ids of a run of symbols without white space, as little-endian bytes.

    The tokenizer parts texts at white space before anything else, so a text's ids are those
    of its runs in turn. A run of Latin letters is one word.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        try:
            self.encode = _word_encoder(path).encode_ordinary
        except (ImportError, KeyError, ValueError):  # no such library, or a vocabulary of another form
            self.encode = None

    def __missing__(self, word: str) -> bytes:
        if len(word) > 1 and word[-1] in ENDINGS and word[-2].isalpha():
            # the tokenizer parts a letter from a sign that follows it
            return self[word[:-1]] + self[word[-1]]
        lower = unicodedata.normalize("NFC", word).lower() if self.encode and word.isalpha() and max(word) < LATIN else ""
        ids = array("I", self.encode(lower + " ") if lower.isalpha() else self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(self) < REMEMBERED and len(word) < 100:
            self[word] = ids
        return ids


_words = functools.lru_cache(maxsize=1)(_Words)
#: Separators that str.split() takes for white space and the tokenizer does not.
_OTHER_SPACE = "\x1c\x1d\x1e\x1f"


def token_bytes(text: str | None, path: str) -> bytes:
    """A document's ids with the end id, four little-endian bytes each."""
    if not text:
        ids = b""
    elif "<|" in text or any(c in text for c in _OTHER_SPACE):
        # special tokens may hold white space on either side
        ids = np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    else:
        # ASCII letters become lower case in any case, in whatever order with the composition of accents
        ids = b"".join(map(_words(path).__getitem__, text.encode().lower().decode().split()))
    return ids + END.to_bytes(4, "little")


def pieces(documents: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, number): every document's pieces, numbered for each length in each
    scan task (part) from 0; with_ids adds the ids, four bytes each."""
    small_batches(documents.sparkSession)

    def run(batches):
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = token_bytes(text, path)
                for k in range(0, len(ids), 4 * LENGTH):
                    own = ids[k : k + 4 * LENGTH]
                    n = len(own) // 4
                    for c, v in zip(cols, (doc_id, k // (4 * LENGTH), k // 4, n, zlib.crc32(own), part, seen[n], own if with_ids else None)):
                        c.append(v)
                    seen[n] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number", "ids"])

    body = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return body.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long, ids binary")


# ---- the plan: runs (length, copies) of each kind of sequence, and how many of the kind ----


def patterns(counts: np.ndarray) -> np.ndarray:
    """All ways (a, b, c), a >= b >= c, in which two or three lengths that occur add up to LENGTH; c is 0 for two."""
    there = np.flatnonzero(counts[:LENGTH])
    held = counts[:LENGTH] > 0
    out = []
    for a in there[::-1].tolist():
        b = there[(there <= a) & (there < LENGTH - a + 1)]
        c = LENGTH - a - b
        b, c = b[(c <= b) & (c >= 0)], c[(c <= b) & (c >= 0)]
        fits = (c == 0) | held[c]
        out.append(np.stack([np.full(fits.sum(), a), b[fits], c[fits]], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def fit(counts: np.ndarray, ways: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """How often to use each pattern: non-negative least squares against the counts of lengths.

    Accelerated projected gradient steps, each length weighted by one over the number of patterns that hold it:
    long lengths, which fit into few patterns, are to be used up rather than short ones, which fill gaps.
    """
    if not len(ways):
        return np.zeros(0)
    size = len(counts)
    flat = ways.T.reshape(-1)
    per_length = np.bincount(flat, minlength=size).astype(float)
    scale = np.where(per_length > 0, 1 / np.maximum(per_length, 1), 0)
    scale[0] = 0
    b = counts.astype(float)

    def used(x):
        return np.bincount(flat, np.tile(x, 3), size)

    x = momentum = np.zeros(len(ways))
    t = 1.0
    for _ in range(steps):
        rest = (b - used(momentum)) * scale
        after = np.maximum(0, momentum + rest[ways].sum(1) / 3)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        momentum = after + (before - 1) / t * (after - x)
        x = after
    return x


def rounded(x: np.ndarray, ways: np.ndarray, counts: np.ndarray) -> tuple[list[tuple[list[tuple[int, int]], int]], np.ndarray]:
    """(kinds of sequences with their numbers, counts left over): x rounded so that sums over neighbouring patterns
    are kept, and cut down where a length would run out."""
    total = np.floor(np.cumsum(x) + 0.5)
    repeats = np.diff(total, prepend=0).astype(np.int64)
    left = counts.astype(np.int64).tolist()
    out = []
    for k in np.flatnonzero(repeats):
        a, b, c = ways[k].tolist()
        need = defaultdict(int)
        for n in (a, b, c):
            if n:
                need[n] += 1
        m = min(int(repeats[k]), *(left[n] // copies for n, copies in need.items()))
        if m > 0:
            for n, copies in need.items():
                left[n] -= m * copies
            out.append((sorted(need.items(), reverse=True), m))
    return out, np.array(left, np.int64)


def best_fit(counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit by falling length, on counts: each length goes where the least space is left that it fits in."""
    spaces: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    order: list[int] = []  # spaces that some sequence has left

    def put(runs, space, n):
        if n:
            if not spaces.get(space):
                spaces[space] = []
                bisect.insort(order, space)
            spaces[space].append((runs, n))

    for length in range(len(counts) - 1, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                runs, n, space = [], -(-left * length // (LENGTH - LENGTH % length)), LENGTH
            else:
                space = order[at]
                runs, n = spaces[space].pop()
                if not spaces[space]:
                    order.pop(at)
            copies = space // length
            full = min(n, left // copies)
            put([*runs, (length, copies)], space - copies * length, full)
            left -= full * copies
            rest = n - full
            if rest and left:
                put([*runs, (length, left)] if left < copies else [*runs, (length, copies)], space - min(left, copies) * length, 1)
                left -= min(left, copies)
                rest -= 1
            if runs:
                put(runs, space, rest)
    return [kind for kinds in spaces.values() for kind in kinds]


def plan(counts: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Kinds of sequences, each a list of (length, copies), with their numbers; every document of counts has a place.

    Where long documents are many, patterns of short ones alone use up what would fill the long ones' gaps. So of the
    fitted patterns those are taken whose longest part exceeds one of LEAST, whichever leaves the fewest sequences
    once the residual is placed.
    """
    kinds = [([(LENGTH, 1)], int(counts[LENGTH]))] if counts[LENGTH] else []
    short = counts.copy()
    short[LENGTH] = 0
    ways = patterns(short)
    x = fit(short, ways)
    best = None
    for least in LEAST:
        exact, left = rounded(np.where(ways[:, 0] > least, x, 0), ways, short)
        made = exact + best_fit(left)
        n = sum(m for _, m in made)
        if best is None or n < best[0]:
            best = n, made
    return kinds + best[1]


def places(kinds: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """The plan as ranges: documents first ... first + n * copies - 1 of a length go to n sequences from
    sequence on, copies to each, at offset. Sorted by length and first."""
    rows, taken, sequence = [], defaultdict(int), 0
    for runs, n in kinds:
        offset = 0
        for length, copies in runs:
            rows.append((length, taken[length], copies, sequence, offset))
            taken[length] += n * copies
            offset += length * copies
        sequence += n
    cols = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "copies", "sequence", "offset"), cols))


# ---- packing ----


def packed(spark: SparkSession, documents: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """pack() with the pieces' ids (four bytes each) where they are asked for."""
    path = tokenizer or default_tokenizer()
    cut = materialize(pieces(documents, path, with_ids))
    by_part = materialize(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    # LENGTH rows at most
    counts = np.zeros(LENGTH + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    dealt = places(plan(counts))
    # three rows a pattern and those of the best fit: bounded by LENGTH alone
    sent = spark.sparkContext.broadcast(dealt)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = cut.join(before, ["length", "part"]).withColumn("number", F.col("number") + F.col("before"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches):
        p = sent.value
        shift = np.int64(1) << np.int64(48)
        keys = p["length"] * shift + p["first"]
        for b in batches:
            length, number = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "number"))
            at = np.searchsorted(keys, length * shift + number, "right") - 1
            k = number - p["first"][at]
            sequence = p["sequence"][at] + k // p["copies"][at]
            offset = p["offset"][at] + k % p["copies"][at] * length
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    shape = "doc_id long, piece int, start long, length long, ids_crc32 long, " + "ids binary, " * with_ids + "sequence_id long, offset long"
    return numbered.select(*names, "number").mapInArrow(run, shape)


def pack(spark: SparkSession, documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Documents of more than LENGTH ids, the end id included, are cut into pieces of LENGTH, the last one shorter;
    all others stay whole. Null and empty texts are the end id alone. Repeated rows are packed each;
    null ids stay null. An empty table gives no pieces. Columns other than doc_id and text are not looked at.
    """
    return packed(spark, documents, tokenizer)


def sequences(spark: SparkSession, documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets): the packed sequences themselves, at most LENGTH ids each."""
    rows = packed(spark, documents, tokenizer, with_ids=True)
    whole = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))

    def run(batches):
        for b in batches:
            parts = b.column(1).to_pylist()
            ids = [np.frombuffer(b"".join(x["ids"] for x in p), "<u4").astype(np.int32) for p in parts]
            kinds = pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())
            cols = ids, [[x["doc_id"] for x in p] for p in parts], [[x["offset"] for x in p] for p in parts]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["sequence_id", "ids", "doc_ids", "offsets"])

    return whole.mapInArrow(run, "sequence_id long, ids array<int>, doc_ids array<long>, offsets array<int>")
