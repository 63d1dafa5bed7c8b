"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

A document's set of five-word shingles is hashed once; the hash range is cut into
bins and the smallest hash of each bin is its signature, empty bins borrowing from
a bin that a hash of the empty bin's number finds (optimal densification). Bands of
the signature are bucket keys. Within a bucket only the pairs with its hub are
candidates, so their number stays below the number of bucket entries. Every
candidate is confirmed on the full sets. Buckets in which members of different groups
are still untested after a few hubs are compared block by block, which emits the
confirmed links alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.common import connected_components, discard, materialize, mix64, small_batches

WORDS = 5
BINS, BANDS = 128, 32
#: Linked if 100 * intersection >= percent * union; the percent of op6.
PERCENT = 85
#: Members of a hub that one group compares at most; larger stars are split.
STAR = 2000
#: Rounds of stars; each takes new hubs among what the rounds before left apart. The rest goes to blocks.
ROUNDS = 3
#: Members and bytes of sets in a block; rows of one bucket that a task of a join holds.
BLOCK, BLOCK_BYTES, SPREAD = 256, 16_000_000, 500

_POSITION = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_PROBE = (mix64(np.arange(BINS * 256, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)) % np.uint64(BINS)).astype(np.int64).reshape(BINS, 256)
_EDGES = np.arange(BINS + 1, dtype=np.float64) * 2.0 ** (64 - int(np.log2(BINS)))
_EDGES = _EDGES[:-1].astype(np.uint64)
_BAND = mix64(np.arange(BANDS, dtype=np.uint64) + np.uint64(77))


class WordHashes(dict):
    """64-bit hash of each word seen by a worker; emptied when it holds LIMIT words."""

    LIMIT = 300_000

    def __missing__(self, w):
        if len(self) > self.LIMIT:
            self.clear()
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


_words = WordHashes()


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles: words are runs of other bytes than white space,
    A-Z lower-cased; fewer than five words are one shingle; no words give none."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.array([_words[x] for x in words], np.uint64)
    if len(w) < WORDS:
        return mix64((w * _POSITION[: len(w)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w)))
    n = len(w) - WORDS + 1
    h = w[:n] * _POSITION[0]
    for k in range(1, WORDS):
        h = h + w[k : k + n] * _POSITION[k]
    return np.unique(mix64(h))


def signature(s: np.ndarray) -> np.ndarray:
    """The smallest hash of each bin, densified. s: sorted, not empty."""
    at = np.searchsorted(s, _EDGES)
    low = s[np.minimum(at, len(s) - 1)]
    ends = np.append(at[1:], len(s))
    full = ends > at
    if not full.all():
        empty = np.flatnonzero(~full)
        probe = full[_PROBE[empty]]
        first = probe.argmax(1)
        source = _PROBE[empty, first]
        lost = ~probe.any(1)
        if lost.any():
            source[lost] = np.flatnonzero(full)[0]
        low[empty] = low[source]
    return low


def band_keys(s: np.ndarray) -> np.ndarray:
    rows = signature(s).reshape(BANDS, BINS // BANDS)
    h = _BAND.copy()
    for k in range(rows.shape[1]):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return h


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_shingles, fingerprint, bands) of each row of docs(doc_id, row, text); fingerprint is null without words."""

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 2000):
                part = b.slice(a, 2000)
                n, prints, bands = [], [], []
                for t in part.column(2).to_pylist():
                    s = shingles(t)
                    n.append(len(s))
                    prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    bands.append(band_keys(s).view(np.int64) if len(s) else np.zeros(0, np.int64))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), keys], ["doc_id", "row", "n_shingles", "fingerprint", "bands"])

    return docs.select("doc_id", "row", "text").mapInArrow(run, "doc_id long, row long, n_shingles long, fingerprint binary, bands array<long>")


def confirm(edges: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The edges (hub, node) whose full sets pass the threshold of percent. texts: (node, text).

    Each member's text goes to its hub's group once, and the hub's text once to
    every part of STAR members; the parts stream through in order, so a hub of any
    number of members takes bounded memory.
    """
    # written first: the join can then split a hub of many members
    stars = materialize(edges.groupBy("hub").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts")))
    # xxhash64 and hash (Murmur3) differ, so parts do not follow the exchange's own dealing
    members = edges.join(stars, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node", F.lit(1).alias("side"))
    hubs = stars.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("hub").alias("node"), F.lit(0).alias("side"))
    rows = members.unionByName(hubs).hint("merge").join(texts, "node").select("hub", "part", "side", "node", "text")

    def run(batches):
        key, s = None, None
        for b in batches:
            hubs, nodes = [], []
            for hub, part, side, node, text in zip(*[c.to_pylist() for c in b.columns]):
                own = shingles(text)
                if side == 0:
                    key, s = (hub, part), own
                    continue
                if key != (hub, part):
                    continue
                small, large = (own, s) if len(own) <= len(s) else (s, own)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                if 100 * both >= percent * (len(own) + len(s) - both):
                    hubs.append(hub)
                    nodes.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.binary()), pa.array(nodes, pa.binary())], ["a", "b"])

    return rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "side", "node").mapInArrow(run, "a binary, b binary")


class Held:
    """The sets of a block, as lists of the members that hold each shingle."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.member = np.repeat(np.arange(len(sets)), self.sizes)[order]
        flat = flat[order]
        first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        self.values, self.bounds = flat[first], np.append(first, len(flat))

    def shared(self, s: np.ndarray) -> np.ndarray:
        """How many shingles each member shares with s."""
        at = np.searchsorted(self.values, s)
        at = at[self.values[np.minimum(at, len(self.values) - 1)] == s]
        n = self.bounds[at + 1] - self.bounds[at]
        if not len(n):
            return np.zeros(len(self.sizes), np.int64)
        places = np.arange(int(n.sum())) + np.repeat(self.bounds[at] - (np.cumsum(n) - n), n)
        return np.bincount(self.member[places], minlength=len(self.sizes))


def compare_blocks(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) between members of different components of each bucket, exactly.

    members: (key, node, component, n). A bucket's members are dealt to blocks by
    hash; a group is a pair of blocks, of which one is held and the other streams by.
    Pairs stay inside the task; buckets of the same members are compared once.
    """
    same = members.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s1"), F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)")).alias("s2"), F.sum("n").alias("weight"))
    chosen = same.groupBy("size", "s1", "s2").agg(F.min("key").alias("key"), F.first("weight").alias("weight"))
    chosen = materialize(chosen.select("key", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("weight") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")))
    dealt = members.join(chosen, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).alias("late"), "node", "component")
    rows = rows.hint("merge").join(texts, "node").select("key", "x", "y", "late", "node", "component", "text")

    def run(batches):
        group, held, index = None, [], None
        out: tuple[list, list] = ([], [])

        def test(node, component, s, index, limit):
            both = index.shared(s)[:limit]
            sizes = index.sizes[:limit]
            for i in np.flatnonzero(100 * both >= percent * (sizes + len(s) - both)).tolist():
                if held[i][1] != component:
                    out[0].append(held[i][0])
                    out[1].append(node)

        def among():
            if len(held) > 1 and group[1] == group[2]:
                own = Held([h[2] for h in held])
                for k, (node, component, s) in enumerate(held):
                    test(node, component, s, own, k)

        for b in batches:
            for key, x, y, late, node, component, text in zip(*[c.to_pylist() for c in b.columns]):
                if group != (key, x, y):
                    among()
                    group, held, index = (key, x, y), [], None
                s = shingles(text)
                if not late:
                    held.append((node, component, s))
                elif held:
                    index = index or Held([h[2] for h in held])
                    test(node, component, s, index, len(held))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["a", "b"])
            out[0].clear()
            out[1].clear()
        among()
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], ["a", "b"])

    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "late", "node").mapInArrow(run, "a binary, b binary")


def link_classes(spark: SparkSession, classes: DataFrame, texts_of, percent: int) -> DataFrame | None:
    """(id, component) of the classes(node, n, bands) that links join; texts_of gives (node, text) of asked nodes."""
    entries = classes.select("node", "n", F.explode("bands").alias("key"))
    # what meets a hot bucket is written first: a join of two plain exchanges can split a hot key
    shared = materialize(entries.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    met = materialize(entries.join(shared, "key"))
    weight = met.groupBy("node").agg(F.sum(F.log("size")).alias("weight"))
    parts = F.ceil(F.col("size") / SPREAD).cast("int")
    # a bucket is dealt to parts, and its hub goes to each of them
    state = materialize(met.join(weight, "node").select("key", "node", "n", "weight", parts.alias("parts"), F.pmod(F.xxhash64("node", "key"), parts).cast("int").alias("part"), F.col("node").alias("component"), F.lit(False).alias("was_hub")))
    texts = materialize(texts_of(state.select("node").distinct()))
    discard(shared, met)

    def joined_by(found):
        nonlocal groups
        edges = found if groups is None else found.union(groups.select(F.col("id").alias("a"), F.col("component").alias("b")))
        after = connected_components(spark, edges)
        discard(groups)
        groups = after

    def regrouped():
        now = groups.select(F.col("id").alias("node"), F.col("component").alias("joined"))
        return state.join(now, "node", "left").withColumn("component", F.coalesce("joined", "component")).drop("joined")

    groups = tested = None
    for _ in range(ROUNDS):
        # hubs: of the members not yet taken, the one that shares most buckets stands in the middle of its group
        hub = state.where("not was_hub").groupBy("key").agg(F.max_by(F.struct(F.col("node").alias("hub"), F.col("component").alias("hub_component"), F.col("n").alias("hub_n"), "parts"), F.struct("weight", "node")).alias("h")).select("key", "h.*")
        hub = materialize(hub.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
        pairs = state.join(hub, ["key", "part"]).where("component <> hub_component and 100 * least(n, hub_n) >= %d * greatest(n, hub_n)" % percent).select("hub", "node").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["hub", "node"], "left_anti")
        pairs = materialize(pairs)
        some = not pairs.isEmpty()
        if some:
            found = materialize(confirm(pairs, texts, percent))
            joined_by(found)
            discard(found)
        tested = pairs if tested is None else tested.union(pairs)
        # a bucket is finished when all members that were not yet hubs stand together
        moved = regrouped() if groups is not None else state
        taken = hub.select("key", "part", F.col("hub").alias("node"), F.lit(True).alias("now"))
        moved = moved.join(taken, ["key", "part", "node"], "left").withColumn("was_hub", F.col("was_hub") | F.coalesce("now", F.lit(False))).drop("now")
        moved = materialize(moved)
        open_keys = materialize(moved.where("not was_hub").groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key"))
        before, state = state, materialize(moved.join(open_keys, "key", "left_semi"))
        discard(before, moved, open_keys, hub)
        if state.isEmpty():
            break
    else:
        found = materialize(compare_blocks(state.where("not was_hub").select("key", "node", "component", "n"), texts, percent))
        joined_by(found)
        discard(found)
    discard(state, texts)
    return groups


def near_duplicates(spark: SparkSession, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of documents(doc_id, text), linked from percent on.

    Documents with equal sets form a class first, without pairs; a class is known
    by the fingerprint of its set. Rows without words or with a null id link with
    nothing; a null id is kept with a null component. Repeated rows each get a row;
    rows that share an id but not a text are different documents, each with the
    component of its own text. Columns other than doc_id and text are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text"))
    small_batches(spark)
    sig = materialize(signatures(docs))
    usable = sig.where("fingerprint is not null and doc_id is not null")
    classes = materialize(usable.groupBy(F.col("fingerprint").alias("node")).agg(F.min(F.struct("doc_id", "row")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))

    def texts_of(nodes):
        # lists of ids grow with the corpus, so they meet the texts by sort-merge at every size
        wanted = classes.join(nodes, "node", "left_semi").select("node", "first.*")
        return docs.join(wanted.hint("merge"), ["doc_id", "row"]).select("node", "text").dropDuplicates(["node"])

    groups = link_classes(spark, classes.select("node", "n", "bands"), texts_of, percent)
    if groups is None:
        groups = spark.createDataFrame([], "id binary, component binary")
    of_class = classes.select("node", F.col("first.doc_id").alias("first")).join(groups, F.col("node") == F.col("id"), "left").select("node", "first", F.coalesce("component", "node").alias("root"))
    lowest = of_class.groupBy("root").agg(F.min("first").alias("found"))
    # written first: the join with the rows can then split a class that holds many of them
    of_class = materialize(of_class.join(lowest, "root").select(F.col("node").alias("fingerprint"), "found"))
    out = sig.select("doc_id", "n_shingles", "fingerprint").join(of_class, "fingerprint", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
