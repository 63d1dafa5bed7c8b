"""Ranked lexical search: Block-Max MaxScore over an inverted index in shards of documents.

A shard holds the documents of one scan task up to a number of tokens, so texts are never
shuffled and a common word's list is spread over all shards. A list is cut into blocks of
compressed postings; beside each block stand its best pairs of (occurrences, length), from
which the block's maximum follows for any corpus statistics, so the index stays valid when
the corpus grows. A query's lists are parted by global bounds: documents that occur in
non-essential lists alone cannot reach the heap, and of the others the block maxima of
non-essential lists reject most before those blocks are decompressed. Every shard returns a
heap for each item; the heaps are merged.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from padron.llm.common import WORD_TABLE, materialize, small_batches

TOP = 50
#: Postings of a block.
BLOCK = 128
#: A shard ends once it holds so many tokens or documents.
SHARD_TOKENS, SHARD_DOCS = 4_000_000, 65_000
#: Terms of the items that one pass over the index asks for, about.
ASKED = 200_000
#: Documents that a shard's first window looks at; each next window is twice as large.
FIRST_WINDOW = 512
#: Heaps of an item that are merged in a task first.
MERGED = 64

_INDEX = "shard long, term binary, df int, lasts binary, counts binary, best binary, blocks array<binary>, ids array<long>, lengths binary, n_docs long, n_tokens long"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_TABLE).split() if text else []


# ---- the index ----


def compressed(docs: np.ndarray, tf: np.ndarray, lengths: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of postings: (the bytes of each, its last document, its number of best pairs, all best pairs (n, 2)).

    docs ascend within a block; starts are the blocks' first postings. A block is its number of
    bytes a gap and a count, the first document, the gaps, the counts less one. A best pair is one that no other
    of the block beats in both occurrences and length.
    """
    n = len(docs)
    sizes = np.diff(np.append(starts, n))
    block = np.repeat(np.arange(len(starts)), sizes)
    gaps = np.diff(docs, prepend=0)
    firsts = docs[starts]
    gaps[starts] = 0
    wide = np.maximum.reduceat(gaps, starts) > 255
    high = np.maximum.reduceat(tf, starts) > 256
    forms = {False: gaps.astype(np.uint8).tobytes(), True: gaps.astype("<u2").tobytes()}, {False: (tf - 1).astype(np.uint8).tobytes(), True: (tf - 1).astype("<u4").tobytes()}
    heads = firsts.astype("<u4").tobytes()
    out = []
    for k, (a, z, w, h) in enumerate(zip(starts.tolist(), (starts + sizes).tolist(), wide.tolist(), high.tolist())):
        g, c = 1 + w, 1 + 3 * h
        out.append(bytes((g, c)) + heads[4 * k : 4 * k + 4] + forms[0][w][g * a : g * z] + forms[1][h][c * a : c * z])
    # falling occurrences, rising length: a pair stays if it is shorter than all before it in its block
    order = np.lexsort((lengths, -tf, block))
    apart = int(lengths.max()) + 1 if n else 1
    held = lengths[order] - block[order].astype(np.int64) * apart
    shortest = np.minimum.accumulate(held)
    stays = np.append(True, held[1:] < shortest[:-1]) if n else np.zeros(0, bool)
    best = order[stays]
    return out, docs[starts + sizes - 1], np.bincount(block[best], minlength=len(starts)), np.stack([tf[best], lengths[best]], 1)


def opened(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(documents, occurrences) of a block."""
    g, c = block[0], block[1]
    n = (len(block) - 6) // (g + c)
    gaps = np.frombuffer(block, np.uint8 if g == 1 else "<u2", n, 6).astype(np.int64)
    tf = np.frombuffer(block, np.uint8 if c == 1 else "<u4", n, 6 + g * n).astype(np.int64) + 1
    return int.from_bytes(block[2:6], "little") + np.cumsum(gaps), tf


class Shard:
    """The documents of a shard while it is filled."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.at, self.tf, self.doc = array("i"), array("i"), array("i")
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.tokens = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        words = words_of(text)
        counts = Counter(words)
        terms = self.terms
        self.at.extend([terms.setdefault(w, len(terms)) for w in counts])
        self.tf.extend(counts.values())
        self.doc.extend([len(self.ids)] * len(counts))
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.tokens += len(words)

    def rows(self, shard: int):
        """The shard's record batches: one row a term, and one with its documents."""
        lengths = np.array(self.lengths, np.int64)
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "ids": self.ids, "lengths": lengths.astype("<i8").tobytes(), "n_docs": int((lengths > 0).sum()), "n_tokens": int(lengths.sum())}],
            schema=_schema(),
        )
        if not self.terms:
            return
        at, tf, doc = (np.frombuffer(a, np.int32).astype(np.int64) for a in (self.at, self.tf, self.doc))
        order = np.lexsort((doc, at))
        at, tf, doc = at[order], tf[order], doc[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        df = np.diff(np.append(first, len(at)))
        place = np.arange(len(at)) - np.repeat(first, df)
        starts = np.flatnonzero(place % BLOCK == 0)
        blocks, lasts, counts, best = compressed(doc, tf, lengths[doc], starts)
        per_term = np.bincount(at[starts], minlength=len(df))
        ends = np.cumsum(per_term)
        pair_ends = np.cumsum(counts)
        last_bytes, count_bytes, best_bytes = lasts.astype("<u4").tobytes(), counts.astype("<u2").tobytes(), best.astype("<u4").tobytes()
        terms = list(self.terms)
        for a in range(0, len(terms), 20_000):
            cols: list[list] = [[] for _ in range(6)]
            for t in range(a, min(a + 20_000, len(terms))):
                z, y = int(ends[t]), int(ends[t] - per_term[t])
                p, q = int(pair_ends[y - 1]) if y else 0, int(pair_ends[z - 1])
                for c, v in zip(cols, (terms[t], int(df[t]), last_bytes[4 * y : 4 * z], count_bytes[2 * y : 2 * z], best_bytes[8 * p : 8 * q], blocks[y:z])):
                    c.append(v)
            n = len(cols[0])
            kinds = [f.type for f in _schema()]
            empty = [pa.nulls(n, k) for k in kinds[7:]]
            yield pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int64()), *[pa.array(c, k) for c, k in zip(cols, kinds[1:7])], *empty], schema=_schema())


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split(" ") for x in _INDEX.split(", "))])


def build_index(documents: DataFrame) -> DataFrame:
    """The index of all documents, stored in the shared folder; texts are read once, where they lie."""
    small_batches(documents.sparkSession)

    def run(batches):
        number, shard = TaskContext.get().partitionId() << 24, Shard()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard.add(doc_id, text)
                if shard.tokens >= SHARD_TOKENS or len(shard.ids) >= SHARD_DOCS:
                    yield from shard.rows(number)
                    number, shard = number + 1, Shard()
        if shard.ids:
            yield from shard.rows(number)

    body = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return materialize(body.mapInArrow(run, _INDEX))


# ---- queries ----


def impact(tf, length, n: int, total: int):
    """What an occurrence count in a document of a length adds, before the term's weight; numpy or plain integers."""
    m = 50 + (50 * length * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Lists:
    """A shard's lists of the asked terms, with their blocks' maxima under the corpus's statistics."""

    def __init__(self, n: int, total: int):
        self.n, self.total = n, total
        self.lists: dict[bytes, tuple[np.ndarray, np.ndarray, list[bytes]]] = {}
        self.ids: list = []
        self.impacts: dict[tuple[bytes, int], tuple[np.ndarray, np.ndarray]] = {}
        #: Blocks that were decompressed.
        self.opened = 0

    def add(self, row: dict) -> None:
        if row["term"] is None:
            self.ids, self.lengths = row["ids"], np.frombuffer(row["lengths"], "<i8")
            return
        pairs = np.frombuffer(row["best"], "<u4").reshape(-1, 2).astype(np.int64)
        counts = np.frombuffer(row["counts"], "<u2").astype(np.int64)
        most = np.maximum.reduceat(impact(pairs[:, 0], pairs[:, 1], self.n, self.total), np.cumsum(counts) - counts)
        self.lists[row["term"]] = np.frombuffer(row["lasts"], "<u4").astype(np.int64), most, row["blocks"]

    def block(self, term: bytes, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of a block, decompressed when first asked for."""
        if (term, k) not in self.impacts:
            if len(self.impacts) > 20_000:
                self.impacts.clear()
            docs, tf = opened(self.lists[term][2][k])
            self.impacts[term, k] = docs, impact(tf, self.lengths[docs], self.n, self.total)
            self.opened += 1
        return self.impacts[term, k]

    def top(self, query: list[tuple[bytes, int, int]], k: int = TOP) -> list[tuple[int, int | None]]:
        """The k best (score, doc_id) of query (term, weight, global bound), best first, ties by id, null first.

        A document's score counts only if it can be among the k best: bounds reject strictly lower ones,
        so ties are decided by id alone.
        """
        own = sorted(((bound, w, t) for t, w, bound in query if w > 0 and t in self.lists))
        if not own:
            return []
        below = np.cumsum([0] + [b for b, _, _ in own])  # below[i]: most that the first i lists add together
        heap: list[tuple[int, int, int | None]] = []
        least, start, width, n = 1, 0, FIRST_WINDOW, len(self.ids)
        while start < n:
            end = min(n, start + width)
            # the first lists together stay under what the heap asks for
            split = int(np.searchsorted(below[1:], least, "left"))
            if split == len(own):
                break
            score = np.zeros(end - start, np.int64)
            for bound, w, t in own[split:]:
                lasts = self.lists[t][0]
                for b in range(int(np.searchsorted(lasts, start)), min(len(lasts), int(np.searchsorted(lasts, end - 1)) + 1)):
                    docs, value = self.block(t, b)
                    a, z = np.searchsorted(docs, (start, end))
                    score[docs[a:z] - start] += w * value[a:z]
            left = np.flatnonzero(score)
            left = left[score[left] + below[split] >= least]
            for i in range(split - 1, -1, -1):
                if not len(left):
                    break
                _, w, t = own[i]
                lasts, most, _ = self.lists[t]
                at = np.searchsorted(lasts, left + start)
                inside = at < len(lasts)
                here = np.where(inside, w * most[np.minimum(at, len(most) - 1)], 0)
                stays = score[left] + below[i] + here >= least  # the block's maximum instead of the list's
                left, at, inside = left[stays], at[stays], inside[stays]
                for b in np.unique(at[inside]):
                    docs, value = self.block(t, int(b))
                    mine = left[inside & (at == b)]
                    p = np.minimum(np.searchsorted(docs, mine + start), len(docs) - 1)
                    score[mine] += np.where(docs[p] == mine + start, w * value[p], 0)
                left = left[score[left] + below[i] >= least]
            heap += [(-s, i is not None, i) for s, i in zip(score[left].tolist(), (self.ids[d + start] for d in left.tolist())) if s > 0]
            heap.sort(key=lambda x: (x[0], x[1], x[2] or 0))
            del heap[k:]
            if len(heap) == k:
                least = -heap[-1][0]
            start, width = end, 2 * width
        return [(-s, i) for s, _, i in heap]


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, term): the distinct terms of all texts of an id; null ids and texts are left out."""
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    asked = benchmark.where("item_id is not null and text is not null")
    return asked.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms).alias("term")).distinct().withColumn("term", F.col("term").cast("binary"))


def bounds(index: DataFrame, asked: DataFrame, n: int, total: int) -> DataFrame:
    """(term, df, most): documents and the highest impact of each asked term, over all shards."""

    def run(batches):
        for b in batches:
            best = []
            for pairs in b.column(2).to_pylist():
                p = np.frombuffer(pairs, "<u4").reshape(-1, 2).astype(np.int64)
                best.append(int(impact(p[:, 0], p[:, 1], n, total).max()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(best, pa.int64())], ["term", "df", "most"])

    lists = index.where("term is not null").select("term", F.col("df").cast("long").alias("df"), "best").join(asked.select("term").distinct(), "term", "left_semi")
    return lists.mapInArrow(run, "term binary, df long, most long").groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))


def _evaluated(index: DataFrame, block: DataFrame, n: int, total: int, k: int) -> DataFrame:
    """(item_id, score, doc_id): every shard's heap for every item of block(item_id, term), about ASKED rows."""
    known = {bytes(r["term"]): (r["df"], r["most"]) for r in bounds(index, block, n, total).collect()}
    queries: dict[int, list] = defaultdict(list)
    for item, term in block.collect():
        if bytes(term) in known:
            df, most = known[bytes(term)]
            queries[item].append((bytes(term), w := weight(n, df), w * most))
    sent = index.sparkSession.sparkContext.broadcast(dict(queries))
    # the items' terms are a block of bounded size; they meet the lists in a join like any other table
    lists = index.join(block.select("term").distinct(), "term", "left_semi").unionByName(index.where("term is null"))
    names = ["shard", "term", "lasts", "counts", "best", "blocks", "ids", "lengths"]

    def run(batches):
        def heaps(lists):
            rows = [(item, s, d) for item, query in sent.value.items() for s, d in lists.top(query, k)]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["item_id", "score", "doc_id"])

        shard, lists = None, None
        for b in batches:
            for row in b.to_pylist():
                if row["shard"] != shard:
                    if lists is not None:
                        yield heaps(lists)
                    shard, lists = row["shard"], Lists(n, total)
                lists.add(row)
        if lists is not None:
            yield heaps(lists)

    dealt = lists.select(*names).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "item_id long, score long, doc_id long")


def merged(heaps: DataFrame, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of each item out of all shards' heaps, in two steps, so that no task
    gathers the heaps of all shards."""
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    some = heaps.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGED)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*best))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(spark: SparkSession, index: DataFrame, benchmark: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, of those with a score above zero.

    Equal scores rank by ascending doc_id, null ids first; repeated rows of documents rank each on their own. Rows of
    one item id are one query of all their terms; null ids, null texts and texts without a term ask nothing. Items
    are asked in blocks of about ASKED terms, each of which passes over the lists of its terms. An empty table gives no rows.
    """
    n, total = index.where("term is null").agg(F.sum("n_docs"), F.sum("n_tokens")).first()
    items = materialize(items_of(benchmark).withColumn("salt", F.xxhash64("item_id")))
    blocks = -(-items.count() // ASKED)
    found = None
    if total:
        for b in range(blocks):
            block = items.where(F.pmod("salt", F.lit(blocks)) == b).select("item_id", "term")
            heaps = materialize(_evaluated(index, block, n, total, k))
            found = heaps if found is None else found.unionByName(heaps)
    if found is None:
        found = spark.createDataFrame([], "item_id long, score long, doc_id long")
    return merged(found, k)


def rank_documents(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, k: int = TOP) -> DataFrame:
    """search() over an index of all documents; columns other than doc_id, text and item_id are not looked at."""
    return search(spark, build_index(documents), benchmark, k)
