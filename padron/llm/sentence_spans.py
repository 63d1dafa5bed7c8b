"""Substring deduplication on sliding runs of sentences.

Sentences of over PIECE words are cut into parts at words that their content chooses.
From every part starts, and in every part ends, one run: the shortest one of at least
MIN_SENTENCES parts and of as many words as the caller asks for (none by default). Runs are hashed and joined over the whole corpus;
the first place of a run keeps it, and parts that any later place covers go.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.common import discard, materialize, mix64, small_batches
from padron.llm.oph_minhash import WordHashes

MIN_SENTENCES = 2
#: Words that a repeated run has at least in production: "Yes. No." in two texts says nothing about them.
PRODUCTION_WORDS = 16
#: Words of a part at most; longer sentences are cut.
PIECE = 16

_SENTENCE = re.compile(rb"[^.!?\n]*(?:[.!?]+|\n|$)\s*")
_WORD = re.compile(rb"\S+")
_HALF = np.uint64(0xFFFFFFFF)
_BASES, _WHOLE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95), np.uint64(0x5851F42D4C957F2D)

_words = WordHashes()
_tables = [np.ones(1, np.uint64)] * 4


def _powers(n: int) -> list[np.ndarray]:
    """Powers of each base and of its inverse modulo 2^64, n at least; up to a stated size they are kept."""
    if len(_tables[0]) >= n:
        return _tables
    size = 1 << (n - 1).bit_length()
    out = []
    for base in (x for b in _BASES for x in (b, pow(b, -1, 1 << 64))):
        x = np.full(size, base, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    if size <= 1 << 20:
        _tables[:] = out
    return out


def _split(text: bytes | None) -> list[bytes]:
    return [m for m in _SENTENCE.findall(text) if m] if text else []


class _Units:
    """The parts of several texts, all at once: texts is a list of sentence lists."""

    def __init__(self, texts: list[list[bytes]]):
        words = [p.lower().split() for t in texts for p in t]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.n = n = int(sizes.sum())
        self.hashes = h = np.fromiter((_words[x] for w in words for x in w), np.uint64, n)
        sentence = np.repeat(np.arange(len(words)), sizes)
        start = np.zeros(n, bool)
        start[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        cut = np.zeros(n, bool)
        if n >= PIECE:
            # the smallest upper half of a hash in each window, the last of equal ones
            low = (h & ~_HALF) | (_HALF - np.arange(n, dtype=np.uint64))
            width = 1
            while width < PIECE:
                step = min(width, PIECE - width)
                low = np.minimum(low[:-step], low[step:])
                width += step
            inside = (sentence[: n - PIECE + 1] == sentence[PIECE - 1 :]) & (sizes[sentence[PIECE - 1 :]] > PIECE)
            cut[(_HALF - (low[inside] & _HALF)).astype(np.int64)] = True
            cut &= ~start
        counts = np.fromiter(map(len, texts), np.int64, len(texts))
        text = np.repeat(np.arange(len(texts)), counts)
        #: parts of each text, first word of each part, text and place in the text of each part with words
        self.parts = counts + np.bincount(text[sentence[cut]], minlength=len(texts))
        self.starts = np.flatnonzero(start | cut)
        self.text = text[sentence[self.starts]]
        self.place = sentence[self.starts] + np.cumsum(cut)[self.starts] - (np.cumsum(self.parts) - self.parts)[self.text]
        self.cuts = np.flatnonzero(cut)
        self.sizes = sizes


def sentences(text: bytes | None) -> list[bytes]:
    """The text cut after . ! ? and line ends, white space kept, so that joining gives the text back.

    A sentence of over PIECE words is cut before the smallest word hash (the last of
    equal ones) of every PIECE consecutive words. Pieces have PIECE words at most and
    their cuts follow from the words around them, so any 51 consecutive words hold the
    same run of whole parts wherever they stand: the first and the last common cut lie
    at most PIECE words from the ends, and the 19 words or more between them are
    PRODUCTION_WORDS and more than one part.
    """
    parts = _split(text)
    units = _Units([parts])
    if not len(units.cuts):
        return parts
    out, at, cuts = [], 0, units.cuts.tolist()[::-1]
    for p, size in zip(parts, units.sizes.tolist()):
        edges = []
        while cuts and cuts[-1] < at + size:
            edges.append(cuts.pop() - at)
        if edges:
            places = [m.start() for m in _WORD.finditer(p)]
            edges = [0, *[places[e] for e in edges], len(p)]
            out += [p[x:y] for x, y in zip(edges, edges[1:])]
        else:
            out.append(p)
        at += size
    return out


def _runs(units: _Units, min_words: int) -> tuple[np.ndarray, ...]:
    """(text, hash, check, first, last) of the runs; hash and check are two polynomials, of which 96 bits are joined on."""
    k = np.arange(len(units.starts))
    if not len(k):
        return k, k, k, k, k
    edges, text = np.append(units.starts, units.n), units.text
    # the first part with which the run has enough words, and the last from which it has
    stop = np.maximum(np.searchsorted(edges, edges[:-1] + min_words) - 1, k + MIN_SENTENCES - 1)
    start = np.minimum(np.searchsorted(edges, edges[1:] - min_words, "right") - 1, k - MIN_SENTENCES + 1)
    ahead = (stop < len(k)) & (text[np.minimum(stop, len(k) - 1)] == text)
    behind = (start >= 0) & (text[np.maximum(start, 0)] == text) & (stop[np.maximum(start, 0)] != k)
    # texts in which no run is long enough
    low = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    high = np.append(low[1:], len(k)) - 1
    whole = ~ahead[low]
    i = np.concatenate([k[ahead], start[behind], low[whole]])
    j = np.concatenate([stop[ahead], k[behind], high[whole]])
    # polynomials over the hashes of the words, taken from prefix sums
    tables = _powers(units.n)
    a, b = edges[i], edges[j + 1]
    at = len(i) - int(whole.sum())
    both = []
    for power, back in (tables[:2], tables[2:]):
        sums = np.append(np.uint64(0), np.cumsum(units.hashes * power[: units.n], dtype=np.uint64))
        h = mix64((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64))
        h[at:] = mix64(h[at:] + _WHOLE)
        both.append(h.view(np.int64))
    return text[i], *both, units.place[i], units.place[j]


def runs(parts: list[bytes], min_words: int = 0) -> list[tuple[tuple[int, int], int, int]]:
    """(hash, first, last) of the shortest run from each part and of the shortest run up to each part.

    A part that any longer run holds stands in one of these within that run, so
    longer ones need no hash. Where no run is long enough, the whole text is one,
    which only whole copies share. Parts without a word do not count. Runs compare
    lower-cased words (A-Z), so spacing does not matter.
    """
    _, h, c, i, j = _runs(_Units([parts]), min_words)
    return list(zip(zip(h.tolist(), c.tolist()), i.tolist(), j.tolist()))


def duplicate_spans(documents: DataFrame, min_words: int = 0) -> DataFrame:
    """(doc_id, row, first, last) of each repeated run but the first of its hash.

    The first is that with the smallest (doc_id, row, first); within a document
    a run may repeat too. row is a hash of the text, so rows sharing an id keep
    apart; equal rows count as the same place.
    """

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 200):
                ids, rows, texts = b.slice(a, 200).columns
                at, hashes, checks, firsts, lasts = _runs(_Units([_split(t) for t in texts.to_pylist()]), min_words)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays([ids.take(at), rows.take(at), pa.array(hashes, pa.int64()), pa.array((checks >> 32).astype(np.int32)), pa.array(firsts.astype(np.int32)), pa.array(lasts.astype(np.int32))], ["doc_id", "row", "hash", "check", "first", "last"])

    body = documents.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text"))
    # the texts are cut once; what is written are places
    places = materialize(body.mapInArrow(run, "doc_id long, row long, hash long, check int, first int, last int"))
    # partial minima and counts leave the map side: a run in a third of all rows is one row a task. They are
    # written before the join: two plain exchanges can split a hot hash
    heads = materialize(places.groupBy("hash", "check").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "first")).alias("head")).where("n > 1").select("hash", "check", "head"))
    later = places.join(heads, ["hash", "check"]).where(~F.struct("doc_id", "row", "first").eqNullSafe(F.col("head"))).select("doc_id", "row", "first", "last")
    spans = materialize(later.distinct())
    discard(places, heads)
    return spans


def remove_repeats(spark: SparkSession, documents: DataFrame, min_words: int = 0) -> DataFrame:
    """(doc_id, n_sentences, n_removed, kept_text) of each row of documents(doc_id, text).

    Any run of two or more parts goes where it is not the first of its kind; with min_words, only runs of so many words,
    and whole copies of shorter texts.
    Null texts stay null with 0 sentences, empty ones stay empty. A null id sorts
    before all others. Equal rows (same id and text) are one place and are treated
    alike. Columns other than doc_id and text are not looked at.
    """
    small_batches(spark)
    spans = duplicate_spans(documents, min_words)
    # a document has as many spans as sentences at most
    by_row = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    body = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text"))
    joined = body.alias("d").join(by_row.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.row") == F.col("s.row")), "left").select("d.doc_id", "text", F.col("spans.first").alias("firsts"), F.col("spans.last").alias("lasts"))

    def cut(batches):
        for b in batches:
            n, gone, kept = [], [], []
            for a in range(0, b.num_rows, 200):
                texts, starts, stops = [b.column(i).slice(a, 200).to_pylist() for i in (1, 2, 3)]
                counts = _Units([_split(t) for t in texts]).parts.tolist()
                for t, size, firsts, lasts in zip(texts, counts, starts, stops):
                    n.append(size)
                    if not firsts:
                        gone.append(0)
                        kept.append(None if t is None else t.decode("utf-8", "replace"))
                        continue
                    parts = sentences(t)
                    drop = np.zeros(size + 1, np.int64)
                    np.add.at(drop, firsts, 1)
                    np.add.at(drop, np.array(lasts) + 1, -1)
                    out = np.cumsum(drop)[:-1] > 0
                    gone.append(int(out.sum()))
                    kept.append(b"".join(p for p, o in zip(parts, out) if not o).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_sentences", "n_removed", "kept_text"])

    return joined.mapInArrow(cut, "doc_id long, n_sentences long, n_removed long, kept_text string")
