"""Licence detection with a positional index of rare licence words.

The templates are whole public licence texts (the files in licences/) and the usual
short notices. Their words are weighed by how rare they are in the corpus, and the
postings (template, position) of each template's rarest words are indexed. Of each
file, the highest-weighted licence words that it holds are looked up; their places
and the postings vote for a relative position of a template in the file. A template
is reported where enough of the weight agrees on one position, give or take edits,
and all its mandatory phrases stand there word for word.
"""

from __future__ import annotations

import math
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.common import WORD_TABLE

# Phrase and label of the base search.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Label of a whole licence text in licences/, and its mandatory phrases.
TEXTS = {
    "apache-2.0": ("apache license version 2 0", "grant of patent license"),
    "artistic-1.0": ("the artistic license", "standard version"),
    "bsd-2-clause": ("redistributions of source code must retain", "redistributions in binary form must reproduce"),
    "bsd-3-clause": ("redistributions in binary form must reproduce", "endorse or promote products"),
    "cc0-1.0": ("cc0 1 0 universal", "affirmer"),
    "gpl-2.0": ("gnu general public license", "version 2 june 1991"),
    "gpl-3.0": ("gnu general public license", "version 3 29 june 2007"),
    "isc": ("permission to use copy modify and or distribute this software for any purpose", "the author disclaims all warranties"),
    "lgpl-2.1": ("gnu lesser general public license", "version 2 1 february 1999"),
    "lgpl-3.0": ("gnu lesser general public license", "version 3 29 june 2007"),
    "mit": ("permission is hereby granted free of charge", "the software is provided as is"),
    "mpl-2.0": ("mozilla public license version 2 0", "covered software"),
}

# Label of a short notice, its words, mandatory phrases.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("general public license", "version 2")),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("general public license", "version 3")),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", ("affero general public license", "version 3")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4",)),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("reserved", "copyright all rights reserved", ("all rights reserved",)),
)
#: Indexed words of a template (and share of its different words), words looked up for each template, share of
#: their weight that must agree, words an alignment may slip (and share of the template's length).
INDEXED, INDEXED_SHARE, RARE, AGREE, SLIP, SLIP_SHARE = 48, 0.6, 12, 0.6, 2, 0.05


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_TABLE).split() if text else []


def templates() -> list[tuple[str, list[bytes], list[list[bytes]]]]:
    """(label, words, mandatory phrases as words) of the whole texts, then of the notices."""
    where = Path(__file__).parent / "licences"
    split = lambda phrases: [p.encode().split() for p in phrases]
    out = [(label, words_of((where / f"{label}.txt").read_bytes()), split(phrases)) for label, phrases in TEXTS.items()]
    return out + [(label, text.encode().split(), split(phrases)) for label, text, phrases in NOTICES]


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """Documents in all, and how many hold each word of the templates: one row for each such word comes back."""

    def run(batches):
        n, df = 0, dict.fromkeys(vocabulary, 0)
        for b in batches:
            for t in b.column(0).to_pylist():
                n += 1
                for w in vocabulary.intersection(words_of(t)):
                    df[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([b"", *df], pa.binary()), pa.array([n, *df.values()], pa.int64())], ["word", "n"])

    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    got = {bytes(r["word"]): r["n"] for r in rows}
    return got.pop(b"", 0), got


def holds(window: list[bytes], phrase: list[bytes]) -> bool:
    return any(window[i] == phrase[0] and window[i : i + len(phrase)] == phrase for i in range(len(window) - len(phrase) + 1))


class Index:
    """Postings of each template's rarest words, word -> [(template, positions)], with weights by inverse frequency."""

    def __init__(self, n_docs: int, df: dict[bytes, int], known=None):
        self.templates = known or templates()
        self.idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1e-6 for _, words, _ in self.templates for w in words}
        self.postings: dict[bytes, list[tuple[int, list[int]]]] = {}
        self.needed, self.slip = [], []
        for t, (_, words, _) in enumerate(self.templates):
            different = sorted(set(words), key=self.order)
            chosen = different[: min(INDEXED, math.ceil(INDEXED_SHARE * len(different)))]
            at: dict[bytes, list[int]] = {w: [] for w in chosen}
            for i, w in enumerate(words):
                if w in at:
                    at[w].append(i)
            for w, places in at.items():
                self.postings.setdefault(w, []).append((t, places))
            self.needed.append(AGREE * sum(self.idf[w] for w in chosen[:RARE]))
            self.slip.append(max(SLIP, int(SLIP_SHARE * len(words))))

    def order(self, w: bytes):
        return -self.idf[w], w

    def looked_up(self, present: set[bytes]) -> dict[int, list[bytes]]:
        """The RARE highest-weighted indexed words of each template that a file holds, where their weight can suffice."""
        by_template: dict[int, list[bytes]] = {}
        for w in sorted(present, key=self.order):
            for t, _ in self.postings[w]:
                own = by_template.setdefault(t, [])
                if len(own) < RARE:
                    own.append(w)
        return {t: own for t, own in by_template.items() if len(own) > 1 and sum(map(self.idf.__getitem__, own)) >= self.needed[t]}

    def matches(self, words: list[bytes], present: set[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, start, length, share of the template's words found there) of each verified template.

        A match inside the place of a longer template with at least its share is left out.
        """
        chosen = self.looked_up(present)
        if not chosen:
            return []
        asked = {w for own in chosen.values() for w in own}
        at: dict[bytes, list[int]] = {w: [] for w in asked}
        for i, w in enumerate(words):
            if w in asked:
                at[w].append(i)
        found = []
        for t, own in chosen.items():
            label, body, phrases = self.templates[t]
            slip = self.slip[t]
            votes: dict[int, set[bytes]] = {}
            for w in own:
                places = next(p for k, p in self.postings[w] if k == t)
                for i in at[w]:
                    for p in places:
                        votes.setdefault(i - p, set()).add(w)
            starts, used, hi, near = sorted(votes), None, 0, {}
            for k, start in enumerate(starts):
                # words that vote for a start within slip of this one, kept as counts while the window moves
                while hi < len(starts) and starts[hi] <= start + slip:
                    for w in votes[starts[hi]]:
                        near[w] = near.get(w, 0) + 1
                    hi += 1
                if (used is None or start > used + slip) and len(near) > 1 and sum(map(self.idf.__getitem__, near)) >= self.needed[t]:
                    lo = max(0, start - slip)
                    window = words[lo : start + len(body) + 2 * slip]
                    if all(holds(window, p) for p in phrases):
                        here = set(window)
                        found.append((label, max(0, start), len(body), sum(w in here for w in body) / len(body)))
                        used = start
                for w in votes[start]:
                    near[w] -= 1
                    if not near[w]:
                        del near[w]
        return [m for m in found if not any(o[2] > m[2] and o[3] >= m[3] - 0.1 and o[1] - 5 <= m[1] and m[1] + m[2] <= o[1] + o[2] + 5 for o in found)]


def base_places(words: list[bytes], at: dict[bytes, list[int]]) -> list[tuple[str, int]]:
    """(label, start) of every base phrase. at: where each first word of a phrase stands."""
    out = []
    for phrase, label in BASE:
        p = phrase.encode().split()
        out += [(label, i) for i in at.get(p[0], ()) if words[i : i + len(p)] == p]
    return out


def detect(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of docs.

    labels joins the base labels with those of verified templates, versions included; score is the
    best share of a template's words found at its place, 1 for a base phrase, 0
    without any. Null and empty texts have no words and no labels. Repeated rows
    get a row each; other columns are not looked at. One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)  # the templates' words only

    def run(batches):
        ix = shared.value
        firsts = {p.encode().split()[0] for p, _ in BASE}
        looked = firsts | ix.postings.keys()
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for t in b.column(1).to_pylist():
                words = words_of(t)
                base, more = [], []
                present = looked.intersection(words)
                if present:
                    at: dict[bytes, list[int]] = {}
                    if not firsts.isdisjoint(present):
                        for i, w in enumerate(words):
                            if w in firsts:
                                at.setdefault(w, []).append(i)
                    base = base_places(words, at)
                    more = ix.matches(words, present & ix.postings.keys())
                starts = [i for _, i in base]
                own = sorted({l for l, _ in base})
                for c, v in zip(cols, (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(own), ",".join(sorted({*own, *(m[0] for m in more)})), 1.0 if base else max((m[3] for m in more), default=0.0))):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return body.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan_licenses(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Weigh the template words over all documents, then detect in all of them."""
    known = templates()
    return detect(documents, Index(*document_frequencies(documents, {w for _, words, _ in known for w in words}), known))
