"""Benchmark decontamination with a distributed positional inverted index.

Training token postings (term, document, position) are stored for the terms that
the benchmark's windows need: of each window its rarest terms, by counts over the
whole corpus. Windows, counts and places of terms are tables, so a benchmark of any
size takes the same two passes over the texts. Postings are shifted by the term's offset in the item; where the
lists of a window's rare terms meet on one document and one shift, the window is a
candidate, and its words are then compared one by one in the whole document.
Proximity matches use the same lists with a tolerance on the shift.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.common import WORD_TABLE, discard, keyed, materialize, own_id, small_batches
from padron.llm.oph_minhash import WordHashes

WINDOW = 10
#: Rarest distinct terms of a window whose postings are intersected.
TERMS = 3
#: Words that a task counts before it passes the counts on.
COUNTED = 500_000
#: Terms that are sent to all tasks; with more, all postings are written and joined with the terms.
BROADCAST_TERMS = 1_000_000

_words = WordHashes()


def _term(w: bytes) -> int:
    return _words[w] - (1 << 63)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_TABLE).split() if text else []


def windows_of(words: list[bytes]) -> list[tuple[int, int]]:
    """(start, length) of an item's windows."""
    n = len(words)
    return [(0, n)] if n < WINDOW else [(i, WINDOW) for i in range(n - WINDOW + 1)]


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, item, text): item tells different texts of one id apart. Null ids and null texts are left out."""
    rows = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item"), F.col("text").cast("binary").alias("text"))
    return rows.dropDuplicates(["item_id", "item"])


def window_terms(items: DataFrame) -> DataFrame:
    """(item_id, item, start, term, word, offset): the distinct words of each window, with their first places in the item."""

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for item_id, item, text in zip(*[c.to_pylist() for c in b.columns]):
                words = words_of(text)
                for start, length in windows_of(words) if words else ():
                    first: dict[bytes, int] = {}
                    for i in range(start, start + length):
                        first.setdefault(words[i], i)
                    for w, i in first.items():
                        for c, v in zip(cols, (item_id, item, start, _term(w), w, i)):
                            c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["item_id", "item", "start", "term", "word", "offset"])

    return items.mapInArrow(run, "item_id long, item long, start int, term long, word binary, offset int")


def sent_to_all(words: DataFrame):
    """The different words of words(word) as a broadcast set, None if there are more than BROADCAST_TERMS."""
    different = words.select("word").distinct()
    if different.count() > BROADCAST_TERMS:
        return None
    return words.sparkSession.sparkContext.broadcast({bytes(r["word"]) for r in different.collect()})


def term_counts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(term, n): occurrences of the words asked(term, word), and maybe of others, in all documents."""
    wanted = sent_to_all(asked)

    def run(batches):
        seen: Counter = Counter()
        known = wanted.value if wanted is not None else seen

        def rows():
            own = [w for w in seen if w in known]
            return pa.RecordBatch.from_arrays([pa.array([_term(w) for w in own], pa.int64()), pa.array([seen[w] for w in own], pa.int64())], ["term", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(words_of(t))
                if len(seen) > COUNTED:
                    yield rows()
                    seen.clear()
        yield rows()

    return docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def postings(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The positional index (term, id, th, position) of the terms of places, stored in the shared folder.

    One row a document without a term carries its number of words.
    """
    wanted = sent_to_all(places)

    def run(batches):
        known = wanted.value if wanted is not None else None
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                rows, at, terms, sizes = [], [], [], []
                for k, t in enumerate(part.column(2).to_pylist()):
                    words = words_of(t)
                    sizes.append(len(words))
                    if known is not None and known.isdisjoint(words):
                        continue
                    own = [i for i, w in enumerate(words) if w in known] if known is not None else range(len(words))
                    rows += [k] * len(own)
                    at += own
                    terms += [_term(words[i]) for i in own]
                rows = pa.array(list(range(len(sizes))) + rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None] * len(sizes) + terms, pa.int64()), part.column(0).take(rows), part.column(1).take(rows), pa.array(sizes + at, pa.int32())], ["term", "id", "th", "position"]
                )

    found = docs.mapInArrow(run, "term long, id long, th long, position int")
    if wanted is None:
        found = found.join(places.select("term").distinct().hint("merge"), "term", "left_semi").unionByName(found.where("term is null"))
    return materialize(found)


def rarest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, item, start, offsets, terms, words): of each window the places of its TERMS rarest words, rarest first.

    Windows with a word that no document holds cannot occur and are left out.
    """
    windows = materialize(window_terms(items))
    # written first: the join can then split a word that many windows hold
    counts = materialize(term_counts(docs, windows).join(windows.select("term").distinct().hint("merge"), "term", "left_semi"))
    ranked = windows.join(counts, "term", "left").groupBy("item_id", "item", "start").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset", "term"))).alias("all"))
    chosen = ranked.where(F.col("all")[0]["n"] > 0).withColumn("best", F.slice("all", 1, TERMS))
    out = materialize(chosen.select("item_id", "item", "start", F.col("best.offset").alias("offsets"), F.col("best.term").alias("terms"), F.col("best.word").alias("words")))
    discard(windows, counts)
    return out


def candidates(docs: DataFrame, items: DataFrame, slack: int = 0) -> tuple[DataFrame, DataFrame]:
    """Alignments (id, th, item_id, item, shift) at which all rare terms of some window meet, and the postings.

    docs: keyed rows. shift is the item's word 0 in the document's words; with
    slack, terms may stand so many words off their places.
    """
    windows = rarest(docs, items)
    places = materialize(windows.select("item_id", "item", F.explode(F.arrays_zip("terms", "words", "offsets")).alias("p")).select("item_id", "item", F.col("p.terms").alias("term"), F.col("p.words").alias("word"), F.col("p.offsets").alias("offset")).distinct())
    index = postings(docs, places)
    shifted = index.where("term is not null").join(places.drop("word"), "term").select("id", "th", "item_id", "item", (F.col("position") - F.col("offset")).alias("shift"), "offset")
    if slack:
        shifted = shifted.withColumn("shift", F.explode(F.sequence(F.col("shift") - slack, F.col("shift") + slack)))
    # an alignment has as many places as its item has chosen words at most
    met = shifted.groupBy("id", "th", "item_id", "item", "shift").agg(F.collect_set("offset").alias("met"))
    least = windows.select(F.min(F.size("offsets"))).first()[0] or 1
    met = met.where(F.size("met") >= least)
    asked = windows.select("item_id", "item", F.col("offsets")[0].alias("offset"), "offsets").distinct()
    full = met.withColumn("offset", F.explode("met")).join(asked, ["item_id", "item", "offset"])
    full = full.where(F.size(F.array_except("offsets", "met")) == 0)
    return full.select("id", "th", "item_id", "item", "shift").distinct(), index


def match(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of documents.

    Null and empty texts have no words. Items that are null or without words
    match nothing; items that repeat an id count once. Repeated document rows
    each get a row; columns other than doc_id, text and item_id are not looked at.
    """
    small_batches(spark)
    docs, items = keyed(documents), materialize(items_of(benchmark))
    found, index = candidates(docs, items)
    by_doc = verified(docs, materialize(found), items).groupBy("id", "th").agg(F.collect_set(F.struct("item_id", "start", "end")).alias("hits"))

    def combine(batches):
        for b in batches:
            n_hit, n_items, sha = [], [], []
            for n, ids, starts, ends in zip(*[b.column(i).to_pylist() for i in range(1, 5)]):
                mark = np.zeros(n + 1, np.int64)
                if ids:
                    np.add.at(mark, starts, 1)
                    np.add.at(mark, ends, -1)
                n_hit.append(int((np.cumsum(mark)[:-1] > 0).sum()))
                own = sorted(map(str, set(ids or ())))
                n_items.append(len(own))
                sha.append(hashlib.sha256(",".join(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    counted = index.where("term is null").select("id", "th", F.col("position").cast("long").alias("n_words"))
    joined = counted.join(by_doc, ["id", "th"], "left").select(own_id().alias("doc_id"), "n_words", F.col("hits.item_id").alias("ids"), F.col("hits.start").alias("starts"), F.col("hits.end").alias("ends"))
    return joined.mapInArrow(combine, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def verified(docs: DataFrame, found: DataFrame, items: DataFrame) -> DataFrame:
    """(id, th, item_id, start, end): runs of document words that equal at least a window of the item.

    Only documents with candidates are read again, whole; a document has at most
    as many alignments as words, times the places where an item repeats itself.
    """
    shifts = found.groupBy("id", "th", "item_id", "item").agg(F.collect_set("shift").alias("shifts"))
    by_doc = shifts.join(items.withColumnRenamed("text", "own"), ["item_id", "item"]).groupBy("id", "th").agg(F.collect_list(F.struct("item_id", "own", "shifts")).alias("found"))
    joined = docs.join(by_doc.hint("merge"), ["id", "th"]).select("id", "th", "text", "found")

    def verify(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for d, th, t, found in zip(*[c.to_pylist() for c in b.columns]):
                words = words_of(t)
                for f in found:
                    own = words_of(f["own"])
                    need = min(WINDOW, len(own))
                    for shift in f["shifts"]:
                        lo, hi, run = max(0, -shift), min(len(own), len(words) - shift), 0
                        for i in range(lo, hi + 1):
                            if i < hi and own[i] == words[i + shift]:
                                run += 1
                                continue
                            if run >= need:
                                for c, v in zip(out, (d, th, f["item_id"], shift + i - run, shift + i)):
                                    c.append(v)
                            run = 0
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["id", "th", "item_id", "start", "end"])

    return joined.mapInArrow(verify, "id long, th long, item_id long, start int, end int")


def proximity(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, slack: int = 2) -> DataFrame:
    """(doc_id, item_id, shift) where a window's rare terms stand within slack words of their places."""
    small_batches(spark)
    found, _ = candidates(keyed(documents), materialize(items_of(benchmark)), slack)
    return found.groupBy("id", "item_id").agg(F.min("shift").alias("shift")).select(own_id().alias("doc_id"), "item_id", "shift")
