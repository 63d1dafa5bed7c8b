"""Embedding near-duplicates from a neighbour graph refined by NN-descent.

Equal vectors form a class first. Each class has a sketch, the signs of SKETCH random
projections; the graph is built on sketches, whose distance follows the angle. First
lists come from buckets of sketch bits; rounds of local joins then compare the
neighbours of each node with one another and keep the best, until few lists change.
Edges near enough are confirmed in double precision on the vectors. Lists that are
full of links are saturated: they are enlarged to their whole group, which is compared
block by block without emitting pairs. Recall is audited link by link against brute
force on a sample of queries, and further tables are added while it is too low.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from padron.llm.common import connected_components, discard, materialize

COSINE = 0.95
#: Bits of a sketch; bits in which neighbours differ at most, and those whose vectors are compared. At the threshold
#: two sketches differ in 26 bits on average with a spread of 4.8, so 5.4 spreads lie below NEAR.
SKETCH, WIDE, NEAR = 256, 80, 52
#: Neighbours kept for a node, reverse neighbours drawn, rows of a bucket, rounds at most, share of lists that may still change.
NEAREST, REVERSE, LEAF, ROUNDS, SETTLED = 8, 8, 48, 6, 0.01
#: Share of the pairs at the threshold that no table of the first set may bring together.
MISSED = 0.02
#: Rows compared at once in a bucket or block, and links wanted in an audit.
BLOCK, AUDITED = 128, 200
#: Queries of an audit (more are asked while links are few), recall wanted, recall below which the job fails, sets of tables tried.
QUERIES, RECALL, LEAST_RECALL, TRIES = (200, 800, 3200, 12_800), 0.97, 0.9, 6
#: Vectors that get a planted partner at the threshold; with few true links their share that is found is the recall.
PLANTED = 500

_EDGE = "u long, v long, far int"


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, unit): unit is the vector scaled to length 1, as float64 bytes; null where it links with nothing."""

    def run(batches):
        for b in batches:
            dims, units = [], []
            for x in b.column(1).to_pylist():
                v = None if x is None or any(e is None for e in x) else np.array(x, np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    if v is not None and len(v) and np.isfinite(v).all() and np.abs(v).max() > 0:
                        v = v / np.abs(v).max()
                        v = v / np.sqrt((v * v).sum())
                    else:
                        v = None
                dims.append(0 if v is None else len(v))
                units.append(None if v is None else v.tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], ["vec_id", "dim", "unit"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(run, "vec_id long, dim int, unit binary")


def with_sketch(classes: DataFrame) -> DataFrame:
    """classes(node, first, weight, dim, unit) with their sketches."""

    def run(batches):
        for b in batches:
            names = b.schema.names
            dims, units = b.column(names.index("dim")).to_numpy(), b.column(names.index("unit")).to_pylist()
            out: list = [None] * len(units)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(units[i] for i in at), np.float64).reshape(len(at), dim)
                signs = np.packbits(x @ np.random.default_rng((SKETCH, int(dim))).normal(size=(dim, SKETCH)) > 0, axis=1)
                for i, row in zip(at, signs):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*names, "sketch"])

    return classes.mapInArrow(run, "node long, first long, weight long, dim int, unit binary, sketch binary")


def _edges(u, v, far) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(far, pa.int32())], ["u", "v", "far"])


def _best(ids: np.ndarray, sketches: list[bytes], worst: np.ndarray | None = None, fresh: np.ndarray | None = None):
    """(u, v, far): of each row the NEAREST nearest others within WIDE; only those nearer than worst, and
    only pairs of which one side is fresh, where these are given."""
    x = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(ids), -1)
    far = np.bitwise_count(x[:, None, :] ^ x[None, :, :]).sum(2, dtype=np.int32)
    np.fill_diagonal(far, SKETCH + 1)
    if fresh is not None:
        far[~(fresh[:, None] | fresh[None, :])] = SKETCH + 1
    k = min(NEAREST, len(ids) - 1)
    if k < 1:
        return [], [], []
    at = np.argpartition(far, k - 1, 1)[:, :k]
    d = np.take_along_axis(far, at, 1)
    ok = d <= WIDE
    if worst is not None:
        ok &= d < worst[:, None]
    return np.repeat(ids, k)[ok.ravel()], ids[at][ok], d[ok]


def bucket_neighbours(nodes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(u, v, far): nearest rows within buckets of sketch bits, for so many tables.

    A bucket larger than BLOCK is passed through in order of further bits, in
    blocks that overlap by half, so no bucket is held whole.
    """

    def deal(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            signs = np.unpackbits(np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(b.num_rows, -1), axis=1).astype(np.int64)
            for t in range(tables):
                chosen = np.random.default_rng((seed, t)).permutation(SKETCH)
                key = dims.astype(np.int64)
                for k in chosen[:bits]:
                    key = key * 2 + signs[:, k]
                place = np.zeros(b.num_rows, np.int64)
                for k in chosen[bits : bits + 40]:
                    place = place * 2 + signs[:, k]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t, np.int32)), pa.array(key), pa.array(place), b.column(0), b.column(2)], ["t", "key", "place", "node", "sketch"])

    def near(batches):
        held, key = [], None
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])

            def flush():
                for c, x in zip(out, _best(np.array([h[0] for h in held]), [h[1] for h in held])):
                    c.append(np.asarray(x, np.int64))

            for t, k, _, node, sketch in zip(*[c.to_pylist() for c in b.columns]):
                if key != (t, k):
                    if held:
                        flush()
                    held, key = [], (t, k)
                held.append((node, sketch))
                if len(held) == BLOCK:
                    flush()
                    held = held[BLOCK // 2 :]
            if out[0]:
                yield _edges(*map(np.concatenate, out))
        if held:
            yield _edges(*_best(np.array([h[0] for h in held]), [h[1] for h in held]))

    dealt = nodes.select("node", "dim", "sketch").mapInArrow(deal, "t int, key long, place long, node long, sketch binary")
    # range partitions split a hot bucket by its order
    return dealt.repartitionByRange("t", "key", "place", "node").sortWithinPartitions("t", "key", "place", "node").mapInArrow(near, _EDGE)


def nearest(edges: DataFrame) -> DataFrame:
    """The NEAREST best (u, v, far) of each u, each once. Ranks are limited before the exchange, so a node that is
    in many lists sends a few rows from each task."""
    order = Window.partitionBy("u").orderBy("far", "v")
    return edges.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= NEAREST).select("u", "v", "far").distinct()


def local_join(graph: DataFrame, before: DataFrame | None, nodes: DataFrame) -> DataFrame:
    """(u, v, far) among the neighbours of each node, forward ones and a drawn few of the reverse ones, that
    are nearer than what the nodes have. Pairs of neighbours that both were in the list before are left out."""
    graph = graph.select("u", "v", "far")
    if before is None:
        graph = graph.withColumn("fresh", F.lit(True))
    else:
        graph = graph.join(before.select("u", "v", F.lit(False).alias("old")), ["u", "v"], "left").select("u", "v", "far", F.coalesce("old", F.lit(True)).alias("fresh"))
    drawn = Window.partitionBy("v").orderBy(F.xxhash64("u", "v"), "u")
    backward = graph.withColumn("rank", F.row_number().over(drawn)).where(F.col("rank") <= REVERSE).select(F.col("v").alias("u"), F.col("u").alias("v"), "fresh")
    own = graph.groupBy("u").agg(F.when(F.count("*") >= NEAREST, F.max("far")).otherwise(SKETCH).alias("worst"))
    near = graph.select("u", "v", "fresh").union(backward).union(own.select("u", F.col("u").alias("v"), F.lit(False))).groupBy("u", "v").agg(F.max("fresh").alias("fresh"))
    known = materialize(nodes.select("node", "sketch").join(own.withColumnRenamed("u", "node"), "node", "left").select(F.col("node").alias("v"), "sketch", F.coalesce("worst", F.lit(SKETCH)).alias("worst")))
    # forward and reverse lists are bounded, so is what meets at a node
    around = near.join(known, "v").groupBy("u").agg(F.collect_list(F.struct("v", "sketch", "worst", "fresh")).alias("near"))

    def compare(batches):
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for near in b.column(0).to_pylist():
                found = _best(np.array([r["v"] for r in near]), [r["sketch"] for r in near], np.array([r["worst"] for r in near]), np.array([r["fresh"] for r in near]))
                for c, x in zip(out, found):
                    c.append(np.asarray(x, np.int64))
            if out[0]:
                yield _edges(*map(np.concatenate, out))

    return around.select("near").mapInArrow(compare, _EDGE)


def confirmed(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (u, v), u < v, of near edges whose vectors have a cosine of COSINE at least, in double precision."""
    pairs = graph.where(F.col("far") <= NEAR).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    units = nodes.select(F.col("node").alias("v"), "dim", "unit")
    right = materialize(pairs.join(units, "v").groupBy("u").agg(F.collect_list(F.struct("v", "dim", "unit")).alias("near")))
    joined = right.join(nodes.select(F.col("node").alias("u"), "dim", "unit"), "u").select("u", "dim", "unit", "near")

    def compare(batches):
        for b in batches:
            us, vs = [], []
            for u, dim, unit, near in zip(*[c.to_pylist() for c in b.columns]):
                same = [r for r in near if r["dim"] == dim]
                if same:
                    x = np.frombuffer(b"".join(r["unit"] for r in same), np.float64).reshape(len(same), dim)
                    for i in np.flatnonzero(x @ np.frombuffer(unit, np.float64) >= COSINE).tolist():
                        us.append(u)
                        vs.append(same[i]["v"])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return joined.mapInArrow(compare, "u long, v long")


def enlarged(groups: DataFrame) -> DataFrame:
    """(node, links): exact number of vectors linked to each node within its group, its own class left out.

    groups: (group, node, weight, unit), vectors of one length in a group. Blocks of
    about BLOCK * 4 rows meet in pairs, dealt by pair, of which one block is held and
    the other streams by; only counts leave a pair.
    """
    parts = materialize(groups.groupBy("group").agg(F.ceil(F.count("*") / (BLOCK * 4)).cast("int").alias("parts")))
    dealt = groups.join(parts, "group").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = dealt.select("group", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") > F.col("other")).alias("late"), "node", "weight", "unit")

    def count(batches):
        key, held, later = None, [], []

        def units(rows):
            return np.frombuffer(b"".join(r[2] for r in rows), np.float64).reshape(len(rows), -1)

        def counts(rows, n):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(np.asarray(n).astype(np.int64))], ["node", "links"])

        def meet():
            hit = units(held) @ units(later).T >= COSINE
            yield counts(held, hit @ np.array([r[1] for r in later]))
            yield counts(later, np.array([r[1] for r in held]) @ hit)

        def close():
            if later:
                yield from meet()
            if held and key[1] == key[2]:
                hit = units(held) @ units(held).T >= COSINE
                np.fill_diagonal(hit, False)
                yield counts(held, hit @ np.array([r[1] for r in held]))

        for b in batches:
            for group, x, y, late, node, weight, unit in zip(*[c.to_pylist() for c in b.columns]):
                if key != (group, x, y):
                    yield from close()
                    key, held, later = (group, x, y), [], []
                (later if late else held).append((node, weight, unit))
                if len(later) == BLOCK and held:
                    yield from meet()
                    later = []
        yield from close()

    dealt = rows.repartition("group", "a", "b").sortWithinPartitions("group", "a", "b", "late", "node")
    return dealt.mapInArrow(count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def audit(nodes: DataFrame, both: DataFrame, groups: DataFrame) -> tuple[float, int]:
    """(recall, links seen): mean share of the true links of a query that were found, over the queries that have any.

    Queries are drawn by hash, more of them while fewer than AUDITED links are seen, and
    compared with all rows in blocks. both: found links (u, v); groups: (node, group, exact),
    groups that were compared whole count as found.
    """
    rows = materialize(nodes.select("node", "dim", "unit").join(groups, "node"))
    recall, seen = 1.0, 0
    for n in QUERIES:
        asked = rows.orderBy(F.xxhash64("node"), "node").limit(n).toArrow()
        if not asked.num_rows:
            break
        ids, dims, units, own_group, own_exact = (asked.column(c) for c in ("node", "dim", "unit", "group", "exact"))
        ids, dims, units, own_group, own_exact = ids.to_numpy(), dims.to_numpy(), units.to_pylist(), own_group.to_numpy(), own_exact.to_numpy()

        def search(batches):
            sure = np.zeros(len(ids), np.int64)
            for b in batches:
                own, d, u, g = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_pylist(), b.column(3).to_numpy()
                for dim in np.intersect1d(np.unique(d), dims):
                    i, j = np.flatnonzero(dims == dim), np.flatnonzero(d == dim)
                    q = np.frombuffer(b"".join(units[k] for k in i), np.float64).reshape(len(i), dim)
                    x = np.frombuffer(b"".join(u[k] for k in j), np.float64).reshape(len(j), dim)
                    hit = (q @ x.T >= COSINE) & (ids[i][:, None] != own[j][None, :])
                    whole = hit & own_exact[i][:, None] & (own_group[i][:, None] == g[j][None, :])
                    sure[i] += whole.sum(1)
                    a, c = np.nonzero(hit & ~whole)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i][a]), pa.array(own[j][c]), pa.array(np.zeros(len(a), np.int64))], ["u", "v", "sure"])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), -1)), pa.array(sure)], ["u", "v", "sure"])

        true = rows.mapInArrow(search, "u long, v long, sure long").join(both.withColumn("found", F.lit(1)), ["u", "v"], "left")
        each = true.groupBy("u").agg(F.sum(F.when(F.col("v") >= 0, 1).otherwise(F.col("sure"))).alias("links"), F.sum(F.when(F.col("v") >= 0, F.coalesce("found", F.lit(0))).otherwise(F.col("sure"))).alias("got"))
        got = each.where("links > 0").agg(F.avg(F.col("got") / F.col("links")), F.sum("links")).first()
        recall, seen = (1.0, 0) if got[0] is None else (float(got[0]), int(got[1]))
        if seen >= AUDITED or asked.num_rows < n:
            break
    discard(rows)
    return recall, seen


def planted(classes: DataFrame) -> DataFrame:
    """Rows like those of classes with negative nodes: -1 - k is a partner, at a cosine just above COSINE, of the k-th class drawn by hash.

    They go through the graph with all others and are taken out of what comes of it; the pairs (node, partner) say how
    many links at the threshold are found, however few there are in the data. Vectors of one component have no partner.
    """
    drawn = classes.where("dim > 1").orderBy(F.xxhash64("node"), "node").limit(PLANTED)

    def run(batches):
        for b in batches:
            ids, dims, units = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            out = []
            for node, unit in zip(ids, units):
                x = np.frombuffer(unit, np.float64)
                r = np.random.default_rng(node).normal(size=len(x))
                r -= (r @ x) * x
                c = COSINE + 1e-6
                v = c * x + math.sqrt(1 - c * c) * r / np.sqrt(r @ r)
                out.append((v / np.sqrt(v @ v)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([-1 - n for n in ids], pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], ["node", "dim", "unit"])

    made = drawn.select("node", "dim", "unit").mapInArrow(run, "node long, dim int, unit binary")
    return made.select("node", F.lit(None).cast("long").alias("first"), F.lit(0).cast("long").alias("weight"), "dim", "unit")


def found_of_planted(linked: DataFrame, planted_nodes: DataFrame) -> tuple[float, int]:
    """(share of the planted pairs that are linked, number of pairs)."""
    asked = planted_nodes.select(F.col("node").alias("p"), (-1 - F.col("node")).alias("x"))
    pairs = linked.select(F.least("u", "v").alias("p"), F.greatest("u", "v").alias("x")).where("p < 0").distinct()
    got = asked.join(pairs.withColumn("hit", F.lit(1)), ["p", "x"], "left").agg(F.avg(F.coalesce("hit", F.lit(0))), F.count("*")).first()
    return (float(got[0]), int(got[1])) if got[1] else (1.0, 0)


def neighbour_graph(nodes: DataFrame, graph: DataFrame | None, bits: int, tables: int, seed: int) -> DataFrame:
    """The lists (u, v, far) of all nodes: those of graph and of further tables, refined until few of them change."""
    fresh = nearest(bucket_neighbours(nodes, bits, tables, seed))
    graph, old = materialize(fresh if graph is None else nearest(graph.union(fresh))), graph
    discard(old)
    before = None
    for _ in range(ROUNDS):
        after = materialize(nearest(graph.union(local_join(graph, before, nodes))))
        changed = after.join(graph.select("u", "v"), ["u", "v"], "left_anti").count()
        discard(before)
        before, graph = graph, after
        if changed <= SETTLED * graph.count():
            break
    discard(before)
    return graph


def near_duplicates(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of vectors(vec_id, embedding).

    Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing, as do rows with a null id (component null, kept). Vectors
    of different lengths are not compared. Repeated rows each get a row and count
    as links of each other; rows that share an id but not a vector each have the
    links and the component of their own vector. Columns other than vec_id and
    embedding are not looked at. The recall is that of the audited links or, where the queries see fewer than AUDITED,
    of planted pairs at the threshold if that is lower; it is never taken for granted. Fails if it stays below LEAST_RECALL.
    """
    rows = materialize(unit_vectors(vectors))
    usable = rows.where("unit is not null and vec_id is not null")
    # numbered when written, so that a class keeps its number
    classes = materialize(usable.groupBy("unit").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"), F.first("dim").alias("dim")).select(F.monotonically_increasing_id().alias("node"), "first", "weight", "dim", "unit"))
    extra = materialize(planted(classes))
    nodes = materialize(with_sketch(classes.unionByName(extra)))
    real = nodes.where("node >= 0")
    n = nodes.count()
    bits = max(0, math.ceil(math.log2(max(1, n) / LEAF)))
    # a pair at the threshold shares a bit with 1 - acos(COSINE) / pi, and a table with that to the power of bits
    together = (1 - math.acos(COSINE) / math.pi) ** bits
    tables = 1 if together >= 1 else math.ceil(math.log(MISSED) / math.log(1 - together))
    graph = None
    for attempt in range(TRIES):
        graph = neighbour_graph(nodes, graph, bits, tables, attempt)
        every = materialize(confirmed(graph, nodes))
        # a list may be full of planted partners too, so it is judged with them
        crowded = every.union(every.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.count("*").alias("n"))
        full = materialize(crowded.where((F.col("n") >= NEAREST) & (F.col("u") >= 0)).select(F.col("u").alias("node")))
        linked = every.where("u >= 0 and v >= 0")
        both = materialize(linked.union(linked.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        joined = connected_components(spark, linked.select(F.col("u").alias("a"), F.col("v").alias("b")))
        group = materialize(real.join(joined, F.col("node") == F.col("id"), "left").select("node", "first", "weight", "unit", F.coalesce("component", "node").alias("group")))
        saturated = materialize(group.join(full, "node").select("group").distinct())
        exact = enlarged(group.join(saturated, "group", "left_semi").select("group", "node", "weight", "unit"))
        plain = both.join(real.select(F.col("node").alias("v"), "weight"), "v").groupBy(F.col("u").alias("node")).agg(F.sum("weight").alias("links"))
        links = materialize(plain.join(exact.withColumnRenamed("links", "exact"), "node", "full").select("node", F.coalesce("exact", "links").alias("links")))
        whole = group.select("node", "group").join(saturated.withColumn("exact", F.lit(True)), "group", "left").select("node", "group", F.coalesce("exact", F.lit(False)).alias("exact"))
        recall, seen = audit(real, both, whole)
        if seen < AUDITED:
            share, pairs = found_of_planted(every, extra)
            recall, seen = min(recall, share), seen + pairs
        if recall >= RECALL:
            break
    if recall < LEAST_RECALL:
        raise RuntimeError(f"recall {recall:.3f} of {seen} audited links after {TRIES} sets of tables")
    lowest = group.groupBy("group").agg(F.min("first").alias("lowest"))
    out = materialize(group.join(lowest, "group").join(links, "node", "left").select("unit", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "lowest"))
    discard(graph, every, full, both, joined, group, saturated, links, classes, extra, nodes)
    result = rows.select(F.col("vec_id"), F.when(F.col("vec_id").isNotNull(), F.col("unit")).alias("unit")).join(out, "unit", "left")
    own = F.coalesce("lowest", "vec_id")
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"))
