"""Exact substring deduplication with sharded suffix arrays.

A byte goes if a SPAN-byte string that covers it also starts anywhere else. Only
strings around a repeated anchor can: every window of SPAN bytes holds its
smallest-hashed gram, chosen by content alone, so equal windows share it. Windows
with the same anchor are cut out as one piece of text; identical pieces enter once
with their number. Pieces are dealt to shards by anchor, each shard builds a suffix
array by Larsson-Sadakane refinement and common prefixes by Kasai's rule, and
anchors too large for one shard are split. Of a split anchor each shard gives its
different windows once, as digests; those that several shards hold go back to them,
and each shard finds them among its windows by binary search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.common import discard, keyed, materialize, mix64, own_id

SPAN, GRAM = 400, 32
#: Bytes of pieces in one suffix array; anchors with more pieces than SPLIT are dealt to several.
SHARD_BYTES, SPLIT = 3_000_000, 4000
#: Windows of one piece at most.
PIECE_WINDOWS = 4096
_R, _S = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: A digest of a window in a shard: two numbers of 64 bits, compared as bytes.
_DIGEST = np.dtype("V16")
_SYMBOLS = 7  # of 9 bits in the first sort key: a byte, or the end of a piece


def rolling(x: np.ndarray, sizes: tuple[int, ...], r: int = _R) -> dict[int, np.ndarray]:
    """Polynomial hashes of all substrings of power-of-two sizes, by doubling."""
    h, size, out = x.astype(np.uint64) + np.uint64(1), 1, {}
    while True:
        if size in sizes:
            out[size] = h
        if size >= max(sizes) or len(h) <= size:
            return out
        h = h[:-size] * np.uint64(r) + h[size:]
        r = r * r % (1 << 64)
        size *= 2


def anchors(text: bytes) -> list[tuple[int, int, int, int, int]]:
    """(anchor hash, piece digest, first, last, times): windows first..last share the anchor; the piece is
    text[first : last + SPAN]. Where an anchor repeats from window to window, as in periodic text, they are
    pieces of PIECE_WINDOWS windows at most, and times is 2."""
    n = len(text) - SPAN + 1
    if n <= 0:
        return []
    h = mix64(rolling(np.frombuffer(text, np.uint8), (GRAM,))[GRAM])
    # smallest hash in each window of grams; of equal ones the last. Low bits hold the place.
    w = SPAN - GRAM + 1
    place = np.arange(len(h), dtype=np.uint64)
    low = np.uint64(0xFFFFFF)
    key = (h & ~low) | (low - (place & low))
    blocks = -(-len(key) // w)
    padded = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(key)] = key
    grid = padded.reshape(blocks, w)
    head = np.minimum.accumulate(grid, 1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    best = np.minimum(tail[:n], head[w - 1 : w - 1 + n])
    first = np.concatenate([[0], np.flatnonzero(best[1:] != best[:-1]) + 1])
    # the anchor's place, from its low bits and the window's start
    off = (low - (best[first] & low)).astype(np.int64) - (first & 0xFFFFFF)
    at = first + np.where(off < 0, off + (1 << 24), off)
    own = h[at].view(np.int64)
    times = np.ones(len(own), np.int64)
    same = np.append(False, own[1:] == own[:-1])
    if same.any():
        # neighbours with one anchor hash become one stretch, which is then cut anew
        lead = np.flatnonzero(~same)
        times = 1 + (np.diff(np.append(lead, len(own))) > 1)
        own, first = own[lead], first[lead]
        stop = np.append(first[1:], n)
        pieces = -(-(stop - first) // PIECE_WINDOWS)
        step = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        own, times, first = np.repeat(own, pieces), np.repeat(times, pieces), np.repeat(first, pieces) + step * PIECE_WINDOWS
    last = np.append(first[1:], n) - 1
    return [(int(a), xxhash.xxh3_64_intdigest(text[i : j + SPAN]) - (1 << 63), int(i), int(j), int(n)) for a, i, j, n in zip(own, first, last, times)]


def suffix_array(t: np.ndarray, depth: int, key: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of t (symbols 0 to 511) sorted by their first `depth` symbols or more.

    Larsson-Sadakane: groups of equal prefixes are refined by the rank of the
    suffix one prefix length on, which doubles each round; only groups of more
    than one member are sorted again.
    """
    n = len(t)
    key = packed(t) if key is None else key
    sa = np.argsort(key, kind="stable")
    k = key[sa]
    fresh = np.concatenate([[True], k[1:] != k[:-1]])
    start = np.flatnonzero(fresh)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = np.repeat(start, np.diff(np.append(start, n)))
    size = np.diff(np.append(start, n))
    active = np.flatnonzero(np.repeat(size > 1, size))
    length = _SYMBOLS
    while length < depth and len(active):
        p = sa[active]
        both = (rank[p] << 32) | (rank[np.minimum(p + length, n)] + 1)
        order = np.argsort(both, kind="stable")
        p, both = p[order], both[order]
        sa[active] = p
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        start = np.flatnonzero(fresh)
        size = np.diff(np.append(start, len(active)))
        rank[p] = np.repeat(active[start], size)
        active = active[np.repeat(size > 1, size)]
        length *= 2
    return sa


def packed(t: np.ndarray) -> np.ndarray:
    """_SYMBOLS symbols from each place on as one number; ends read as 0."""
    wide = np.concatenate([t.astype(np.uint64), np.zeros(_SYMBOLS, np.uint64)])
    key = wide[: len(t)].copy()
    for i in range(1, _SYMBOLS):
        key <<= np.uint64(9)
        key |= wide[i : i + len(t)]
    return key


def common_prefixes(t: np.ndarray, sa: np.ndarray, starts: np.ndarray, windows: np.ndarray, cap: int, key: np.ndarray | None = None) -> np.ndarray:
    """For each place in sa, the common prefix with its predecessor, up to cap; only of suffixes at
    the window starts starts[k] + 0 ... windows[k] - 1 of each piece.

    Kasai's rule, for all pieces side by side: one step to the right, a common
    prefix shrinks by one at most, so each step only extends what is left. Beyond
    the cap the order of sa is open; there the rule holds only if the predecessor
    moved along, else the comparison starts anew.
    """
    n = len(t)
    rank = np.empty(n, np.int64)
    rank[sa] = np.arange(n)
    key = np.concatenate([packed(t) if key is None else key, np.zeros(cap + _SYMBOLS + 1, np.uint64)])
    wide = np.concatenate([t, np.zeros(cap + _SYMBOLS + 1, t.dtype)])
    lcp = np.zeros(n + 1, np.int64)
    h = np.zeros(len(starts), np.int64)
    before = np.full(len(starts), -2)
    order = np.argsort(-windows, kind="stable")
    for o in range(int(windows.max(initial=0))):
        live = order[: np.searchsorted(-windows[order], -o)]
        i = starts[live] + o
        r = rank[i]
        j = np.where(r > 0, sa[np.maximum(r - 1, 0)], -1)
        now = np.maximum(h[live] - 1, 0)
        now[(h[live] >= cap) & (j != before[live] + 1)] = 0
        before[live] = j
        for step, source in ((_SYMBOLS, key), (1, wide)):
            go = np.flatnonzero((j >= 0) & (now < cap))
            while len(go):
                go = go[source[i[go] + now[go]] == source[j[go] + now[go]]]
                now[go] += step
                go = go[now[go] < cap]
        now[j < 0] = 0
        h[live] = now
        lcp[r] = np.minimum(now, cap)
    return lcp


def shard(pieces: list[bytes], counts: list[int], digests: bool):
    """Which windows of each piece repeat: a list of boolean arrays; and the digests of all windows, 128 bits each."""
    lengths = np.array([len(p) for p in pieces])
    t = np.zeros(int(lengths.sum()) + len(pieces), np.uint16)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    inside = np.ones(len(t), bool)
    inside[starts + lengths] = False
    t[inside] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    windows = lengths - SPAN + 1
    key = packed(t)
    sa = suffix_array(t, SPAN, key)
    lcp = common_prefixes(t, sa, starts, windows, SPAN, key)
    twice = np.zeros(len(t), bool)
    same = lcp[1:-1] >= SPAN
    twice[sa[1:][same]] = True
    twice[sa[:-1][same]] = True
    out = [np.ones(w, bool) if c > 1 else twice[s : s + w] for s, w, c in zip(starts, windows, counts)]
    if not digests:
        return out, None
    h = rolling(t, (16, 128, 256))
    i = np.concatenate([np.arange(a, a + w) for a, w in zip(starts, windows)])
    parts = h[256][i], h[128][i + 256], h[16][i + 384]
    d = [mix64(mix64(mix64(parts[0]) + parts[1]) + parts[2])]
    # the second half of a digest hashes the bytes with another base
    other = rolling(t, (16, 128, 256), _S)
    parts = other[256][i], other[128][i + 256], other[16][i + 384]
    d.append(mix64(mix64(mix64(parts[0]) + parts[1]) + parts[2]))
    return out, np.stack(d, 1)


def runs_of(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()


def across_shards(split: DataFrame) -> DataFrame:
    """(anchor, piece, a, z): runs of windows of split anchors that another shard of the anchor holds as well.

    split: (anchor, part, piece, digests), parts of an anchor whole. A shard sends each
    different window once, so a window that all pieces share is one row a shard; shards are
    counted by partial aggregates. The shared digests stream back ahead of the shard's pieces.
    """

    def different(batches):
        seen, key = None, None

        def rows():
            d = np.unique(np.concatenate(seen))
            halves = d.view(np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(d), key[0])), pa.array(np.full(len(d), key[1], np.int32)), pa.array(halves[:, 0]), pa.array(halves[:, 1])], ["anchor", "part", "d1", "d2"])

        for b in batches:
            for anchor, part, digests in zip(*[c.to_pylist() for c in b.columns]):
                if key != (anchor, part):
                    if seen:
                        yield rows()
                    seen, key = [], (anchor, part)
                seen.append(np.frombuffer(digests, _DIGEST))
        if seen:
            yield rows()

    once = materialize(split.select("anchor", "part", "digests").repartition("anchor", "part").sortWithinPartitions("anchor", "part").mapInArrow(different, "anchor long, part int, d1 long, d2 long"))
    shared = materialize(once.groupBy("anchor", "d1", "d2").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "d1", "d2"))
    back = once.join(shared, ["anchor", "d1", "d2"]).withColumn("chunk", F.pmod("d1", F.lit(64)))
    back = back.groupBy("anchor", "part", "chunk").agg(F.collect_list(F.struct("d1", "d2")).alias("known"))
    none = F.lit(None)
    rows = back.select("anchor", "part", F.lit(0).alias("side"), none.cast("long").alias("piece"), none.cast("binary").alias("digests"), F.col("known.d1").alias("d1"), F.col("known.d2").alias("d2"))
    rows = rows.union(split.select("anchor", "part", F.lit(1), "piece", "digests", none.cast("array<long>"), none.cast("array<long>")))

    def search(batches):
        known, key, ordered = [], None, None
        for b in batches:
            cols: list[list] = [[] for _ in range(4)]
            for anchor, part, side, piece, digests, d1, d2 in zip(*[c.to_pylist() for c in b.columns]):
                if key != (anchor, part):
                    known, key, ordered = [], (anchor, part), None
                if side == 0:
                    known.append(np.ascontiguousarray(np.stack([d1, d2], 1).astype(np.int64)).view(_DIGEST).ravel())
                    continue
                if ordered is None:
                    ordered = np.sort(np.concatenate(known)) if known else np.zeros(0, _DIGEST)
                if not len(ordered):
                    continue
                own = np.frombuffer(digests, _DIGEST)
                at = np.searchsorted(ordered, own)
                for a, z in zip(*runs_of(ordered[np.minimum(at, len(ordered) - 1)] == own)):
                    for c, v in zip(cols, (anchor, piece, a, z)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["anchor", "piece", "a", "z"])

    return rows.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "side").mapInArrow(search, "anchor long, piece long, a int, z int")


def remove_repeats(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row of documents(doc_id, text).

    Null texts count as empty; texts under SPAN bytes lose nothing. Repeated rows
    are each other's repeats and get a row each. Strings are judged on the input.
    Columns other than doc_id and text are not looked at.
    """
    docs = keyed(documents)

    def find(batches):
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                cols: list[list] = [[] for _ in range(7)]
                for d, th, t in zip(*[c.to_pylist() for c in part.columns]):
                    for row in anchors(t):
                        for c, v in zip(cols, (*row, d, th)):
                            c.append(v)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["anchor", "piece", "first", "last", "times", "id", "th"])

    # the texts are cut once; what is written are places
    places = materialize(docs.select("id", "th", "text").where(F.octet_length("text") >= SPAN).mapInArrow(find, "anchor long, piece long, first int, last int, times int, id long, th long"))
    # what meets a hot anchor or piece is written first: a join of two plain exchanges can split a hot key
    repeated = materialize(places.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor"))
    live = materialize(places.drop("times").join(repeated, "anchor"))
    discard(places, repeated)

    contents = live.groupBy("anchor", "piece").agg(F.count("*").alias("n"), F.min(F.struct("id", "th", "first", "last")).alias("owner"))
    size = materialize(contents.groupBy("anchor").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("parts")).where("parts > 1"))
    part = F.coalesce(F.pmod("piece", "parts"), F.lit(-1)).cast("int")
    contents = contents.join(size, "anchor", "left").select("owner.*", F.struct("anchor", "piece", F.least("n", F.lit(2)).cast("int").alias("n"), part.alias("part"), F.col("owner.first").alias("first"), F.col("owner.last").alias("last")).alias("c"))
    owned = contents.groupBy("id", "th").agg(F.collect_list("c").alias("pieces"))

    def cut(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for t, pieces in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for p in pieces:
                    for c, v in zip(cols, (p["anchor"], p["piece"], p["n"], p["part"], t[p["first"] : p["last"] + SPAN])):
                        c.append(v)
                if len(cols[0]) > 20_000:
                    yield made(cols)
                    cols = [[] for _ in range(5)]
            yield made(cols)

    def made(cols):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["anchor", "piece", "n", "part", "body"])

    pieces = docs.select("id", "th", "text").join(owned.hint("merge"), ["id", "th"]).select("text", "pieces").mapInArrow(cut, "anchor long, piece long, n int, part int, body binary")

    def decide(batches):
        held, size, key = [], 0, None

        def flush():
            flags, digests = shard([x[4] for x in held], [x[2] for x in held], any(x[3] >= 0 for x in held))
            cols: list[list] = [[] for _ in range(6)]
            at = 0
            for x, f in zip(held, flags):
                a, z = runs_of(f)
                own = None
                if digests is not None:
                    own = digests[at : at + len(f)].tobytes() if x[3] >= 0 else None
                    at += len(f)
                if a or own:
                    for c, v in zip(cols, (x[0], x[1], x[3], a, z, own)):
                        c.append(v)
            held.clear()
            ints = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), ints, ints, pa.binary()))], ["anchor", "piece", "part", "starts", "ends", "digests"])

        for b in batches:
            for x in zip(*[c.to_pylist() for c in b.columns]):
                if size >= SHARD_BYTES and (x[0], x[3]) != key:
                    yield flush()
                    size = 0
                if held and held[-1][:2] == x[:2]:
                    continue  # an owner row that is there twice
                held.append(x)
                size += len(x[4])
                key = (x[0], x[3])
        if held:
            yield flush()

    decided = materialize(pieces.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "piece").mapInArrow(decide, "anchor long, piece long, part int, starts array<int>, ends array<int>, digests binary"))
    spans = decided.select("anchor", "piece", F.explode(F.arrays_zip("starts", "ends")).alias("s")).select("anchor", "piece", F.col("s.starts").alias("a"), F.col("s.ends").alias("z"))
    split = decided.where("digests is not null").select("anchor", "part", "piece", "digests")
    if not split.isEmpty():
        spans = spans.union(across_shards(split))
    by_piece = materialize(spans.groupBy("anchor", "piece").agg(F.collect_list(F.struct("a", "z")).alias("spans")))
    by_doc = live.join(by_piece, ["anchor", "piece"]).groupBy("id", "th").agg(F.collect_set(F.struct("first", "spans")).alias("found"))
    joined = docs.join(by_doc.hint("merge"), ["id", "th"], "left").select(own_id().alias("doc_id"), "text", "found")

    def remove(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(4)]
            for t, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                mark = np.zeros(len(t) + 1, np.int64)
                for f in found or ():
                    for s in f["spans"]:
                        mark[f["first"] + s["a"]] += 1
                        mark[f["first"] + s["z"] + SPAN] -= 1
                gone = np.cumsum(mark)[:-1] > 0
                starts, ends = runs_of(gone)
                at, kept = 0, hashlib.sha256()
                for s, e in zip(starts, ends):
                    kept.update(t[at:s])
                    at = e + 1
                kept.update(t[at:])
                for c, v in zip(cols, (len(t), int(gone.sum()), len(starts), kept.hexdigest())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
