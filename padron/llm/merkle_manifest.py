"""Merkle manifest of a dataset, with incremental witnesses.

Rows are leaves of one tree a group; the groups' roots are leaves of the tree above them.
A tree is built in aligned blocks of 2^SHIFT nodes. Within a block nodes are appended one
after the other: a stack holds the open subtrees, every node below one keeps the part of its
witness that is known so far, and whenever a sibling is completed the witnesses on both sides
are extended by it. A block's root is then one more append to the level above, where the same
runs again, until every group has one node left. The levels are tables. A later append to the
manifest touches the last open block of each level alone, since a full block never changes.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from padron.llm.common import discard, materialize

#: A block holds 2^SHIFT nodes of a level.
SHIFT = 10
#: The part of a row's place (monotonically_increasing_id) that counts within its partition.
PLACE_BITS = 33


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def group_key(value: Column) -> Column:
    """A group's name that is never null; null comes first, others bytewise."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def append_all(digests: list[str], alone: bool, shift: int) -> tuple[list[list[str]], str]:
    """Append the nodes of a block in turn: every node's witness up to the block's root, and the root.

    A step of a witness is L or R and the digest of the sibling on that side, or N where a
    node rises without one. The last block of several is raised to the full height; the only
    block of its group (alone) ends where one node is left.
    """
    steps: list[list[str]] = [[] for _ in digests]
    tops: list[tuple[int, int, str]] = []  # the open subtrees: height, first node, root

    def join(end: int) -> None:
        height, middle, right = tops.pop()
        _, first, left = tops.pop()
        for i in range(first, middle):
            steps[i].append("R" + right)
        for i in range(middle, end):
            steps[i].append("L" + left)
        tops.append((height + 1, first, _hash(left + right)))

    for i, d in enumerate(digests):
        tops.append((0, i, d))
        while len(tops) > 1 and tops[-1][0] == tops[-2][0]:
            join(i + 1)
    n = len(digests)
    while len(tops) > 1 or (not alone and tops[-1][0] < shift):
        height, first, root = tops[-1]
        if len(tops) > 1 and tops[-2][0] == height:
            join(n)
            continue
        for i in range(first, n):
            steps[i].append("N")
        tops[-1] = (height + 1, first, _hash(root))
    return steps, tops[0][2]


def ranked(rows: DataFrame, order: list[str], before: DataFrame | None = None) -> DataFrame:
    """rows(grp, ...) with idx, the place within the group by order and then by the row, from 0, or from the
    group's n in before(grp, n) on.

    Rows are sorted by ranges, so a group of any size is split, copies of one row included. Only the numbers
    of rows of each group in each partition are summed up, as many a group as there are partitions.
    """
    own = materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
    keys = ["grp", *order, "_row"]
    placed = materialize(own.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", PLACE_BITS)
    counts = placed.groupBy("grp", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if before is not None:
        counts = counts.join(before.select("grp", F.col("n").alias("_old")), "grp", "left").withColumn("_before", F.col("_before") + F.coalesce("_old", F.lit(0))).drop("_old")
    out = placed.withColumn("_part", part).join(counts.drop("_n"), ["grp", "_part"]).withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first"))
    out = materialize(out.drop("_part", "_at", "_first", "_before"))
    discard(own, placed)
    return out


def _closed(nodes: DataFrame, several: DataFrame) -> DataFrame:
    """nodes(grp, idx, digest, ...) with steps, and block_root on the first row of each block.

    several: groups with more than one block, as (grp).
    """
    names = [c for c in nodes.columns if c != "grp"]
    flagged = nodes.join(several.select("grp", F.lit(True).alias("_several")), "grp", "left").withColumn("_block", F.shiftright("idx", SHIFT))
    shift = SHIFT
    dealt = flagged.repartition("grp", "_block").sortWithinPartitions("grp", "_block", "idx")

    def run(batches):
        held: list[pa.RecordBatch] = []
        key = None

        def done():
            rows = pa.Table.from_batches(held).combine_chunks()
            steps, root = append_all(rows.column("digest").to_pylist(), not rows.column("_several")[0].as_py(), shift)
            rows = rows.drop_columns(["_several", "_block"])
            rows = rows.append_column("steps", pa.array(steps, pa.list_(pa.string()))).append_column("block_root", pa.array([root] + [None] * (len(steps) - 1), pa.string()))
            return rows.to_batches()

        for b in batches:
            groups, blocks = b.column("grp").to_pylist(), b.column("_block").to_pylist()
            start = 0
            for i in range(b.num_rows):
                if (groups[i], blocks[i]) != key:
                    if i > start:
                        held.append(b.slice(start, i - start))
                    if held:
                        yield from done()
                    held, start, key = [], i, (groups[i], blocks[i])
            held.append(b.slice(start))
        if key is not None:
            yield from done()

    kinds = dict(nodes.dtypes)
    shape = ", ".join(f"`{c}` {kinds[c]}" for c in ["grp", *names]) + ", steps array<string>, block_root string"
    return materialize(dealt.select("grp", *names, "_several", "_block").mapInArrow(run, shape))


@dataclass
class Manifest:
    """levels[0] has the leaves (grp, idx, digest, payload), each next one the blocks' roots below it, all
    with their witnesses within the block (steps); the last level, never that of the leaves, has one node a group."""

    levels: list[DataFrame]

    def sizes(self) -> DataFrame:
        """(grp, n): leaves of each group."""
        return self.levels[0].groupBy("grp").agg((F.max("idx") + 1).alias("n"))

    def roots(self) -> DataFrame:
        """(grp, root) of each group."""
        return self.levels[-1].select("grp", F.col("digest").alias("root"))

    def witnesses(self, above: DataFrame | None = None) -> DataFrame:
        """The leaves with their whole witness: steps up to the group's root and, if given, those of above(grp, steps, ...),
        whose other columns come along.

        Witnesses are handed down level by level, from a block's root to its at most 2^SHIFT nodes, so no
        join key has more rows than that.
        """
        held = self.levels[-1].select("grp", "idx", F.col("digest").alias("subroot"))
        extra = []
        if above is None:
            held = held.withColumn("steps", F.array().cast("array<string>"))
        else:
            extra = [c for c in above.columns if c not in ("grp", "steps")]
            held = held.join(above, "grp")
        for level in self.levels[-2::-1]:
            upper = held.select("grp", F.col("idx").alias("_block"), F.col("steps").alias("_above"), "subroot", *extra)
            held = level.withColumn("_block", F.shiftright("idx", SHIFT)).join(upper, ["grp", "_block"]).withColumn("steps", F.concat("steps", "_above")).drop("_block", "_above", "block_root")
        return held


def append(manifest: Manifest | None, rows: DataFrame, order: list[str]) -> Manifest:
    """The manifest with rows(grp, digest, order and payload columns) appended, each group's by order.

    Of an earlier manifest, each level's full blocks stay as they are, witnesses included; its open block is
    closed anew with what was appended. The new tables stand in the shared folder; the earlier manifest stays valid.
    """
    old = manifest.levels if manifest else []
    changed = ranked(rows, order, manifest.sizes() if manifest else None)
    levels: list[DataFrame] = []
    while True:
        depth = len(levels)
        # a manifest of few levels has one node a group in all those that it lacks
        before = old[depth] if depth < len(old) else (old[-1] if old else None)
        if before is None:
            level = changed_level = _closed(changed, _several(changed))
        else:
            before = before.drop("block_root")
            touched = changed.select("grp", F.shiftright("idx", SHIFT).alias("_block")).distinct()
            marked = before.withColumn("_block", F.shiftright("idx", SHIFT))
            # what is replaced or stands in a block that is closed anew; the rest keeps its witnesses
            again = marked.join(touched, ["grp", "_block"], "left_semi").drop("_block", "steps").join(changed.select("grp", "idx"), ["grp", "idx"], "left_anti")
            kept = marked.join(touched, ["grp", "_block"], "left_anti").drop("_block")
            changed_level = _closed(again.select(*changed.columns).unionByName(changed), _several(before.select("grp", "idx").unionByName(changed.select("grp", "idx"))))
            level = materialize(kept.unionByName(changed_level.drop("block_root")))
        levels.append(level)
        if depth and depth + 1 >= len(old) and level.where("idx > 0").isEmpty():
            return Manifest(levels)
        changed = changed_level.where("block_root is not null").select("grp", F.shiftright("idx", SHIFT).alias("idx"), F.col("block_root").alias("digest"))


def _several(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("grp").agg(F.max("idx").alias("last")).where(F.shiftright("last", SHIFT) > 0)


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf's digest and its witness lead to."""

    def step(digest, s):
        side, other = F.left(s, F.lit(1)), F.substr(s, F.lit(2))
        joined = F.when(side == "L", F.concat(other, digest)).when(side == "R", F.concat(digest, other)).otherwise(digest)
        return F.sha2(joined.cast("binary"), 256)

    return F.aggregate(steps, start, step)


def proof(steps: Column) -> Column:
    """One digest over the siblings of a witness, level by level."""
    return F.sha2(F.concat_ws("", F.transform(steps, lambda s: F.substr(s, F.lit(2)))).cast("binary"), 256)


def manifest_of(documents: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang", key: str = "doc_id", **payload: Column) -> Manifest:
    """The manifest of a table: a leaf of each row's fields, trees by group, leaves by key (null first), then digest."""
    rows = documents.select(group_key(F.col(group)).alias("grp"), leaf(*map(F.col, fields)).alias("digest"), F.col(key).alias("key"), *[c.alias(n) for n, c in payload.items()])
    return append(None, rows, ["key", "digest"])


def with_root(manifest: Manifest) -> DataFrame:
    """The leaves with subroot, root and the whole witness (steps) up to the tree of all groups' roots."""
    top = append(None, manifest.roots().select(F.lit("").alias("grp"), F.col("root").alias("digest"), F.col("grp").alias("name")), ["name"])
    upper = top.witnesses().select(F.col("name").alias("grp"), "steps", F.col("subroot").alias("root"))
    return manifest.witnesses(upper)


def verify(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of documents.

    A row whose doc_id's checksum is divisible by seven is checked after its n_chars was raised by one; a null
    n_chars, and a row without an id, stay as they are and so are verified. Rows of one id and language stand
    in the order of their digests; equal rows are leaves each; null ids come first. Empty texts have zero
    bytes, null ones are told apart from them. An empty table gives no rows. Columns other than the five
    named in the leaf are not looked at.
    """
    raised = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    other = F.when(tampered & F.col("n_chars").isNotNull(), leaf(F.col("doc_id"), F.col("source"), F.col("lang"), raised, F.col("text")))
    leaves = with_root(manifest_of(documents, found=other))
    out = leaves.select(F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", proof(F.col("steps")).alias("proof_sha256"), folded(F.coalesce("found", "digest"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
