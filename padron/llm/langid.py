"""Language identification with segmentation-marginalised unigram models.

Each language has a probability for every piece of a fixed public vocabulary. A
word's likelihood is the sum over all ways to cut it into pieces (the forward
algorithm), so no single segmentation is trusted. The probabilities come from
expectation-maximisation over the same lattice on a bounded sample of labelled
documents; every text is then scored whole. Words of any length are summed over
all their segmentations: long ones carry the forward sums of the longest piece.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a word up to which words are scored side by side; longer ones are scored one by one in logarithms.
SHORT = 24
#: Bytes of a long word whose pieces are looked up at once.
STRETCH = 1 << 16
#: Words whose scores a Python worker keeps, and words scored at once.
CACHE_WORDS, SCORE_BLOCK = 400_000, 8192

#: Letters stay (A-Z lower-cased), bytes from 0x80 stay, the rest separates words.
LETTER_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Lattice:
    """The pieces of a vocabulary file that can occur in normalised words, found by a rolling hash.

    The table holds all beginnings of pieces too, so that a look-up stops where no piece goes on.
    """

    def __init__(self, path: str):
        pieces = {bytes([c]) for c in range(256)}
        with open(path, "rb") as f:
            for line in f:
                raw = base64.b64decode(line.split()[0])
                body = raw[1:] if raw[:1] == b" " else raw
                if body and body.translate(LETTER_TABLE) == body and b" " not in body:
                    pieces.add(raw)
        self.pieces = sorted(pieces)
        self.longest = max(map(len, self.pieces))
        number = {p: i for i, p in enumerate(self.pieces)}
        known = sorted({p[:n] for p in self.pieces for n in range(1, len(p) + 1)})
        h = np.zeros(len(known), np.uint64)
        lengths = np.array([len(p) for p in known])
        for j in range(self.longest):
            live = np.flatnonzero(lengths > j)
            h[live] = h[live] * _BASE + np.array([known[i][j] for i in live], np.uint64) + np.uint64(1)
        h = self.spread(h)
        order = np.argsort(h)
        self.keys = h[order]
        #: piece number, -1 for what is only the beginning of pieces
        self.key_piece = np.array([number.get(known[i], -1) for i in order], np.int32)
        assert (self.keys[1:] > self.keys[:-1]).all()
        # the top 20 bits of the hash lead to the first key of that prefix
        self.start = np.searchsorted(self.keys, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
        self.deep = int(np.bincount((self.keys >> np.uint64(44)).astype(np.int64)).max())

    @staticmethod
    def spread(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 if only longer pieces begin so, -2 if none does."""
        h = self.spread(h)
        at = self.start[(h >> np.uint64(44)).astype(np.int64)].astype(np.int64)
        out = np.full(h.shape, -2, np.int32)
        for k in range(self.deep):
            i = np.minimum(at + k, len(self.keys) - 1)
            hit = self.keys[i] == h
            out[hit] = self.key_piece[i[hit]]
        return out

    def arcs(self, words: list[bytes]):
        """Lattice arcs of words of one block by their end, as (word, start, piece), and the word lengths."""
        lengths = np.array([len(w) for w in words], np.int64)
        n, m = len(words), int(lengths.max(initial=1))
        grid = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(n, m).astype(np.uint64)
        by_end: list[list] = [[] for _ in range(m + 1)]
        for i in range(m):
            live = np.flatnonzero(lengths > i)
            h = np.zeros(len(live), np.uint64)
            for k in range(1, min(self.longest, m - i) + 1):
                h = h * _BASE + grid[live, i + k - 1] + np.uint64(1)
                p = self.find(h)
                ok = p >= 0
                if ok.any():
                    by_end[i + k].append((live[ok], i, p[ok]))
                on = (p >= -1) & (lengths[live] > i + k)
                live, h = live[on], h[on]
                if not len(live):
                    break
        return by_end, lengths, n, m

    def arcs_of(self, word: bytes):
        """(start, end, piece) of all arcs of one word, in order of end."""
        x = np.frombuffer(word, np.uint8).astype(np.uint64)
        found = []
        live, h = np.arange(len(x)), np.zeros(len(x), np.uint64)
        for k in range(1, self.longest + 1):
            h = h * _BASE + x[live + k - 1] + np.uint64(1)
            p = self.find(h)
            ok = p >= 0
            found.append((live[ok], live[ok] + k, p[ok]))
            on = (p >= -1) & (live + k < len(x))
            live, h = live[on], h[on]
            if not len(live):
                break
        start, end, piece = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(end, kind="stable")
        return start[order], end[order], piece[order]


@functools.lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def forward(lat: Lattice, words: list[bytes], prob: np.ndarray, keep: bool = False):
    """log P(word | language) summed over all segmentations: (words, languages).

    prob: (languages, pieces). For words of at most SHORT bytes: each piece's
    probability is at least 1e-12, so doubles do not underflow.
    """
    by_end, lengths, n, m = lat.arcs(words)
    k = prob.shape[0]
    cols = np.ascontiguousarray(prob.T)
    alpha = np.zeros((m + 1, n, k))
    alpha[0] = 1.0
    for j in range(1, m + 1):
        for w, i, p in by_end[j]:
            alpha[j, w] += alpha[i, w] * cols[p]
    last = np.log(alpha[lengths, np.arange(n)])
    return (last, alpha, by_end, lengths) if keep else last


def expected_counts(lat: Lattice, words: list[bytes], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Expected piece counts (languages, pieces) of weighted words: one E step (forward-backward)."""
    last, alpha, by_end, lengths = forward(lat, words, prob, keep=True)
    n, k = last.shape
    m = alpha.shape[0] - 1
    cols = np.ascontiguousarray(prob.T)
    beta = np.zeros((m + 1, n, k))
    beta[lengths, np.arange(n)] = weight / np.exp(last)
    pieces, flows = [], []
    for j in range(m, 0, -1):
        for w, i, p in by_end[j]:
            flow = cols[p] * beta[j, w]
            beta[i, w] += flow
            pieces.append(p)
            flows.append(flow * alpha[i, w])
    pieces, flows = np.concatenate(pieces), np.concatenate(flows)
    return np.stack([np.bincount(pieces, flows[:, c], minlength=len(lat.pieces)) for c in range(k)])


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(0)
    return top + np.log(np.exp(x - top).sum(0))


def long_forward(lat: Lattice, word: bytes, log_prob: np.ndarray) -> np.ndarray:
    """log P(word | language), all segmentations summed, for a word of any length.

    The word is read in stretches that overlap by the longest piece; only the
    sums of the last longest-piece bytes are carried. log_prob: (pieces, languages).
    """
    back = lat.longest
    alpha = {0: np.zeros(log_prob.shape[1])}
    for first in range(0, len(word), STRETCH):
        lo = max(0, first - back)
        start, end, piece = lat.arcs_of(word[lo : first + STRETCH])
        new = end + lo > first  # the others ended in the stretch before
        start, end, piece = (start[new] + lo).tolist(), end[new] + lo, piece[new]
        score = log_prob[piece]
        edges = np.flatnonzero(np.append(True, end[1:] != end[:-1])).tolist() + [len(end)]
        for a, b in zip(edges, edges[1:]):
            j = int(end[a])
            # pieces that begin before the stretch's first byte are among those of the overlap
            alpha[j] = _log_sum(score[a:b] + np.array([alpha[i] for i in start[a:b]]))
            alpha.pop(j - back - 1, None)
    return alpha[len(word)]


def long_counts(lat: Lattice, word: bytes, weight: np.ndarray, log_prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, expected count by language) of each arc of one weighted word, in logarithms."""
    start, end, piece = lat.arcs_of(word)
    score = log_prob[piece]
    alpha = np.full((len(word) + 1, log_prob.shape[1]), -np.inf)
    beta = alpha.copy()
    alpha[0] = beta[-1] = 0
    edges = np.flatnonzero(np.append(True, end[1:] != end[:-1])).tolist() + [len(end)]
    for a, b in zip(edges, edges[1:]):
        alpha[end[a]] = _log_sum(score[a:b] + alpha[start[a:b]])
    order = np.argsort(start, kind="stable")
    edges = np.flatnonzero(np.append(True, start[order][1:] != start[order][:-1])).tolist() + [len(start)]
    for a, b in reversed(list(zip(edges, edges[1:]))):
        own = order[a:b]
        beta[start[own[0]]] = _log_sum(score[own] + beta[end[own]])
    return piece, weight * np.exp(alpha[start] + score + beta[end] - alpha[-1])


def split_words(text: bytes) -> list[bytes]:
    """Normalised words with their leading space."""
    if not text.isascii():
        text = text.decode("utf-8", "replace").lower().encode()
    return [b" " + w for w in text.translate(LETTER_TABLE).split()]


def has_letter(text: bytes) -> bool:
    if any(97 <= c <= 122 for c in set(text.translate(LETTER_TABLE))):
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def fit(docs: DataFrame, vocabulary: str | None = None, docs_per_language: int = 200, rounds: int = 3, floor: float = 0.05, max_word: int = 1000):
    """(languages, probabilities) from labelled documents (columns text, lang).

    At most about docs_per_language documents of each language are used, drawn
    by a hash of the text, and in any case the text of smallest hash of each language;
    words of over max_word bytes are scored but not learned from. These bounds keep the
    fit small. Rows whose text or lang is null are left out. Without such rows there
    are no languages.
    """
    vocabulary = vocabulary or default_vocabulary()
    labelled = docs.where("text is not null and lang is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("text"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((0, 0))
    share = F.create_map(*[x for l in languages for x in (F.lit(l), F.lit(min(1.0, docs_per_language / sizes[l])))])
    drawn = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)

    # copies of few texts may all miss the share: one text of each language is always in
    drawn = drawn.union(labelled.groupBy("lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))

    def count(batches):
        seen: dict = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = seen.setdefault(lang, {})
                for w in split_words(text):
                    if len(w) <= max_word:
                        own[w] = own.get(w, 0) + 1
        for lang, own in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())], ["lang", "word", "n"]
            )

    got = drawn.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    at: dict[bytes, int] = {}
    which = np.array([at.setdefault(w, len(at)) for w in got.column("word").to_pylist()], np.int64)
    index = {l: i for i, l in enumerate(languages)}
    lang = np.array([index[l] for l in got.column("lang").to_pylist()], np.int64)
    words = list(at)
    weight = np.zeros((len(words), len(languages)))
    np.add.at(weight, (which, lang), got.column("n").to_numpy())

    lat = lattice(vocabulary)
    size = np.array([len(p) for p in lat.pieces])
    prob = np.repeat((np.where(size == 1, 1e-4, 1e-5))[None, :], len(languages), 0)
    order = sorted((i for i, w in enumerate(words) if len(w) <= SHORT), key=lambda i: len(words[i]))
    long = [i for i, w in enumerate(words) if len(w) > SHORT]
    for _ in range(rounds):
        counts = np.zeros_like(prob)
        log_prob = np.log(prob).T
        for i in long:
            piece, flow = long_counts(lat, words[i], weight[i], log_prob)
            np.add.at(counts.T, piece, flow)
        for a in range(0, len(order), SCORE_BLOCK):
            block = order[a : a + SCORE_BLOCK]
            counts += expected_counts(lat, [words[i] for i in block], weight[block], prob)
        counts += floor
        prob = np.maximum(counts / counts.sum(1, keepdims=True), 1e-12)
    return languages, prob


class WordScores(dict):
    """Row number of each word seen; the rows are filled in blocks."""

    def __init__(self, lat, prob):
        super().__init__()
        self.lat, self.prob = lat, prob
        self.log_prob = np.ascontiguousarray(np.log(prob).T) if prob.size else None
        self.clear_rows()

    def clear_rows(self):
        self.clear()
        self.pending: list[bytes] = []
        self.rows = np.zeros((1 << 14, self.prob.shape[0]))

    def __missing__(self, w):
        self.pending.append(w)
        self[w] = n = len(self)
        return n

    def settle(self):
        first = len(self) - len(self.pending)
        if len(self) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(len(self) - len(self.rows), len(self.rows)), self.rows.shape[1]))])
        for i, w in enumerate(self.pending):
            if len(w) > SHORT:
                self.rows[first + i] = long_forward(self.lat, w, self.log_prob)
        order = sorted((i for i, w in enumerate(self.pending) if len(w) <= SHORT), key=lambda i: len(self.pending[i]))
        for a in range(0, len(order), SCORE_BLOCK):
            block = order[a : a + SCORE_BLOCK]
            self.rows[[first + i for i in block]] = forward(self.lat, [self.pending[i] for i in block], self.prob)
        self.pending = []


def scorer(languages: list[str], prob: np.ndarray, vocabulary: str):
    """A function from raw texts to (language or 'und', probability) lists."""
    table = WordScores(lattice(vocabulary), prob)

    def predict(texts: list[bytes | None]):
        ids, starts, at = [], [], 0
        for t in texts:
            own = [table[w] for w in split_words(t)] if t and languages else []
            ids.append(np.array(own, np.int64))
            starts.append(at)
            at += len(own)
        table.settle()
        names, scores = [], []
        for t, own in zip(texts, ids):
            if not languages or not t or not has_letter(t):
                names.append("und")
                scores.append(0.0)
                continue
            total = table.rows[own].sum(0)
            p = np.exp(total - total.max())
            best = int(np.argmax(p))
            names.append(languages[best])
            scores.append(float(p[best] / p.sum()))
        if len(table) > CACHE_WORDS:
            table.clear_rows()
        return names, scores

    return predict


def identify(docs: DataFrame, languages: list[str], prob: np.ndarray, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs(doc_id, text), whole texts.

    A text that is null, empty or without a letter gets 'und' and score 0, and so
    does every text when no language was learned. Equal likelihoods go to the
    language that sorts first. Repeated rows each get a row; further columns of
    docs are not looked at, whatever their names. One pass, no shuffle.
    """
    vocabulary = vocabulary or default_vocabulary()
    model = docs.sparkSession.sparkContext.broadcast((languages, prob))  # languages x vocabulary, independent of the data

    def run(batches):
        predict = scorer(*model.value, vocabulary)
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                names, scores = predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id):
    """The contract's fold: crc32 of the id's digits, modulo 3, equals 1."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def predict_languages(spark: SparkSession, documents: DataFrame, vocabulary: str | None = None, **fit_args) -> DataFrame:
    """Learn on the documents outside the held-out fold, predict all of them."""
    fold = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    languages, prob = fit(documents.where(~fold).where("doc_id is not null"), vocabulary, **fit_args)
    out = identify(documents, languages, prob, vocabulary)
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
