"""Secret scanning with probabilistic automata learned from known credentials.

Fixed base patterns find credentials of known form. A bounded sample of what they
find trains one automaton for each kind: a prefix tree whose states are merged where
their next symbols, their endings and the lengths that are left agree statistically.
One more automaton learns ordinary tokens of the same corpus. Every other token of 8
or more symbols is scored whole by the likelihood of its format, its end included,
under each kind against ordinary text, so that credentials without a telling context
are found too.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.llm.common import materialize, small_batches

KINDS = ("assign", "access", "hex", "model")
# The base patterns are fixed values; `assign` runs on lower-cased bytes, which
# keeps offsets and gives "either case" for A-Z only.
ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: A run of credential symbols; its parts between / . = + and between all separators are judged as well.
RUN = re.compile(rb"[A-Za-z0-9+/_.=-]{8,}")
PART, ATOM = re.compile(rb"[A-Za-z0-9_-]{8,}"), re.compile(rb"[A-Za-z0-9]{8,}")
SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_CODE = np.full(256, len(SYMBOLS) - 1, np.int64)
_CODE[list(SYMBOLS)] = np.arange(len(SYMBOLS))

#: Learning only: longer tokens are scored whole but not learned from; a kind needs an example for each fold.
LONGEST, FEWEST = 256, 3
#: Visits both states need before their symbols are compared, and levels of significance tried.
VISITS, ALPHAS, FOLDS = 12, (0.2, 0.02), 3
#: Added to each symbol's count; share of a kind's own examples that its threshold lets through; bits over ordinary text.
SMOOTH, ACCEPT, MARGIN = 0.1, 0.97, 10.0
#: Visits of each state that come from the kind's symbols as a whole.
PRIOR = 20.0
_LETTER = re.compile(rb"[A-Za-z]")
_WORD = re.compile(rb"[A-Za-z]?[a-z]+|[A-Z]+")
#: Runs whose verdict a worker keeps; tokens scored at once.
CACHE_RUNS, SCORE_BLOCK, WIDE = 300_000, 4096, 64


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in bytes of the base patterns, in order of start, then kind."""
    out = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text.lower()) if m.end(1) - m.start(1) >= LEAST["assign"]]
    out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def value_of(text: bytes, kind: int, start: int, end: int) -> bytes:
    """The credential itself: of an assignment its right-hand side."""
    if kind:
        return text[start:end]
    m = ASSIGN.match(text[start:end].lower())
    return text[start:end][m.start(1) : m.end(1)]


class Automaton:
    """Deterministic probabilistic automaton over SYMBOLS.

    For each state: successors and counts by symbol, endings, visits, and how many
    visits had how many symbols left (which tells positions of a fixed format apart
    where the symbols are all alike).
    """

    def __init__(self, tokens=()):
        self.next: list[dict[int, int]] = []
        self.count: list[dict[int, int]] = []
        self.left: list[dict[int, int]] = []
        self.end: list[int] = []
        self.visits: list[int] = []
        self._state()
        for t in tokens:
            self.add(t)

    def _state(self) -> int:
        self.next.append({})
        self.count.append({})
        self.left.append({})
        self.end.append(0)
        self.visits.append(0)
        return len(self.next) - 1

    def add(self, token: bytes):
        at, left = 0, len(token)
        for c in _CODE[np.frombuffer(token, np.uint8)].tolist():
            self.visits[at] += 1
            self.left[at][left] = self.left[at].get(left, 0) + 1
            self.count[at][c] = self.count[at].get(c, 0) + 1
            if c not in self.next[at]:
                self.next[at][c] = self._state()
            at = self.next[at][c]
            left -= 1
        self.visits[at] += 1
        self.left[at][0] = self.left[at].get(0, 0) + 1
        self.end[at] += 1

    def length_gap(self, a: int, b: int) -> float:
        """Kolmogorov-Smirnov distance of the lengths that are left; 2 if no length is shared."""
        x, y, nx, ny = self.left[a], self.left[b], self.visits[a], self.visits[b]
        if x.keys().isdisjoint(y):
            return 2.0
        sx = sy = 0
        far = 0.0
        for k in sorted(x.keys() | y.keys()):
            sx += x.get(k, 0)
            sy += y.get(k, 0)
            far = max(far, abs(sx / nx - sy / ny))
        return far

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether no symbol's or ending's frequency, here and below, differs by more than the
        Hoeffding bound; states with fewer than VISITS visits show nothing."""
        factor = math.sqrt(0.5 * math.log(2 / alpha))
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            na, nb = self.visits[a], self.visits[b]
            if na < VISITS or nb < VISITS or a == b:
                continue
            bound = factor * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(self.end[a] / na - self.end[b] / nb) > bound:
                return False
            x, y = self.count[a], self.count[b]
            for c in x.keys() | y.keys():
                if abs(x.get(c, 0) / na - y.get(c, 0) / nb) > bound:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    stack.append((self.next[a][c], self.next[b][c]))
        return True

    def distance(self, a: int, b: int, alpha: float) -> float | None:
        """How unlike state b is to the settled state a; None if the difference is significant."""
        gap, na, nb = self.length_gap(a, b), self.visits[a], self.visits[b]
        if gap > 1 or gap > math.sqrt(0.5 * math.log(2 / alpha)) * math.sqrt((na + nb) / (na * nb)):
            return None
        if not self.compatible(a, b, alpha):
            return None
        spare = SMOOTH * (len(SYMBOLS) + 1)
        bits = -sum(n * math.log2((self.count[a].get(c, 0) + SMOOTH) / (na + spare)) for c, n in self.count[b].items())
        return gap * 10 + bits / nb

    def fold(self, into: int, other: int) -> list[int]:
        """Add the tree below `other` to `into`; the states that it was added to."""
        stack, touched = [(into, other)], []
        while stack:
            a, b = stack.pop()
            touched.append(a)
            self.end[a] += self.end[b]
            self.visits[a] += self.visits[b]
            for mine, new in ((self.count[a], self.count[b]), (self.left[a], self.left[b])):
                for c, n in new.items():
                    mine[c] = mine.get(c, 0) + n
            for c, t in self.next[b].items():
                if c in self.next[a]:
                    stack.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t
        return touched

    def infer(self, alpha: float) -> "Automaton":
        """Merge states, the most visited first, each into the settled state it is most like, or settle it."""
        settled, is_settled = [0], {0}
        open_: list[tuple[int, int, int, int]] = []

        def offer(states):
            for r in states:
                if r in is_settled:
                    for c, t in self.next[r].items():
                        if t not in is_settled:
                            heapq.heappush(open_, (-self.visits[t], r, c, t))

        offer([0])
        while open_:
            visits, parent, symbol, child = heapq.heappop(open_)
            if child in is_settled or self.next[parent].get(symbol) != child or -visits != self.visits[child]:
                continue  # it was settled or merged, or has gained visits and was offered anew
            best = min(((d, r) for r in settled if (d := self.distance(r, child, alpha)) is not None), default=None)
            if best is None:
                settled.append(child)
                is_settled.add(child)
                offer([child])
            else:
                self.next[parent][symbol] = best[1]
                offer(self.fold(best[1], child))
        return self.reachable(settled)

    def reachable(self, settled: list[int]) -> "Automaton":
        """Only the settled states, numbered anew; the root stays 0."""
        number = {s: i for i, s in enumerate(settled)}
        out = Automaton()
        for s in settled[1:]:
            out._state()
        for s, i in number.items():
            out.next[i] = {c: number[t] for c, t in self.next[s].items()}
            out.count[i], out.left[i], out.end[i], out.visits[i] = self.count[s], self.left[s], self.end[s], self.visits[s]
        return out


class Table:
    """An automaton for scoring: successor and log2 probability by state and symbol, and of the end.

    A symbol that a state has not seen leads where most of its visits go on.
    """

    def __init__(self, a: Automaton, weight: float = 0.0):
        """weight: so many visits of each state are taken from the automaton's symbols as a whole, which tell more than
        a state's own where examples are few."""
        n, k = len(a.next), len(SYMBOLS)
        self.next = np.zeros((n, k), np.int64)
        self.bits = np.zeros((n, k))
        self.end = np.zeros(n)
        share = np.full(k + 1, SMOOTH)
        for s in range(n):
            for c, m in a.count[s].items():
                share[c] += m
            share[k] += a.end[s]
        share *= weight / share.sum()
        for s in range(n):
            total = math.log2(a.visits[s] + SMOOTH * (k + 1) + weight)
            onward: dict[int, int] = {}
            for c, m in a.count[s].items():
                t = a.next[s][c]
                onward[t] = onward.get(t, 0) + m
            self.next[s] = max(onward, key=lambda t: (onward[t], -t)) if onward else s
            self.bits[s] = np.log2(SMOOTH + share[:k]) - total
            for c, m in a.count[s].items():
                self.next[s, c] = a.next[s][c]
                self.bits[s, c] = math.log2(m + SMOOTH + share[c]) - total
            self.end[s] = math.log2(a.end[s] + SMOOTH + share[k]) - total

    def log2(self, tokens: list[bytes]) -> np.ndarray:
        """log2 probability of each whole token, its end included."""
        out = np.zeros(len(tokens))
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        order = np.argsort(-sizes, kind="stable")
        wide = int((sizes > WIDE).sum())
        for i in order[:wide]:  # long ones one by one
            at, total, step, bits = 0, 0.0, self.next, self.bits
            for c in _CODE[np.frombuffer(tokens[i], np.uint8)].tolist():
                total += bits[at, c]
                at = step[at, c]
            out[i] = total + self.end[at]
        for a in range(wide, len(order), SCORE_BLOCK):
            block = order[a : a + SCORE_BLOCK]
            width = int(sizes[block[0]])
            grid = _CODE[np.frombuffer(b"".join(tokens[i].ljust(width, b"-") for i in block), np.uint8).reshape(len(block), width)]
            at, total = np.zeros(len(block), np.int64), np.zeros(len(block))
            lengths = sizes[block]
            for j in range(width):
                live = int(np.searchsorted(-lengths, -j))  # lengths fall, those above j stand first
                total[:live] += self.bits[at[:live], grid[:live, j]]
                at[:live] = self.next[at[:live], grid[:live, j]]
            out[block] = total + self.end[at]
        return out


def infer_checked(tokens: list[bytes], alphas=ALPHAS) -> tuple[Automaton, np.ndarray]:
    """The automaton of the tokens and, for each token, the mean log2 probability of a symbol that an
    automaton of the other folds gives it. The level of significance is the one with the best such mean."""
    best = None
    size = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    for alpha in alphas:
        held = np.zeros(len(tokens))
        for f in range(FOLDS):
            own = np.arange(len(tokens)) % FOLDS == f
            model = Table(Automaton([t for t, o in zip(tokens, own) if not o]).infer(alpha), PRIOR)
            held[own] = model.log2([t for t, o in zip(tokens, own) if o])
        if best is None or held.sum() > best[0]:
            best = held.sum(), alpha, held / size
    return Automaton(tokens).infer(best[1]), best[2]


class Models:
    """Tables by kind with their thresholds, and the table of ordinary tokens."""

    def __init__(self, tables: dict[str, Table], thresholds: dict[str, float], ordinary: Table | None, states: dict[str, int]):
        self.tables, self.thresholds, self.ordinary, self.states = tables, thresholds, ordinary, states

    def accepted(self, tokens: list[bytes], plain: np.ndarray | None = None, margin: float = MARGIN) -> np.ndarray:
        """Tokens whose mean log2 probability reaches a kind's threshold and whose probability under that
        kind is at least margin bits above that of ordinary text (plain, where it is given). Words and numbers are
        never among them, however much they are like a kind: see is_plain()."""
        out = np.zeros(len(tokens), bool)
        if not tokens or not self.tables:
            return out
        size = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
        # without ordinary tokens all symbols and the end are alike
        if plain is None:
            plain = self.ordinary.log2(tokens) if self.ordinary else -size * math.log2(len(SYMBOLS) + 1)
        for kind, table in self.tables.items():
            p = table.log2(tokens)
            out |= (p / size >= self.thresholds[kind]) & (p - plain >= margin)
        for i in np.flatnonzero(out):
            out[i] = not is_plain(tokens[i])
        return out


def is_plain(token: bytes) -> bool:
    """Words and numbers, also several with separators between them: never a credential by their looks alone."""
    return not _LETTER.search(token) or all(_WORD.fullmatch(p) or p.isdigit() for p in re.split(rb"[+/_.=-]+", token) if p)


def learn(positives: dict[str, list[bytes]], ordinary: list[bytes]) -> Models:
    """One automaton for each kind with at least FEWEST distinct examples. A kind's threshold is what
    ACCEPT of its examples reach under automata that have not seen them."""
    tables, thresholds, states = {}, {}, {}
    for kind, tokens in sorted(positives.items()):
        # by hash, so that neighbours in order of name do not share a fold
        tokens = sorted({t for t in tokens if len(t) <= LONGEST}, key=lambda t: (xxhash.xxh3_64_intdigest(t), t))
        if len(tokens) >= FEWEST:
            automaton, held = infer_checked(tokens)
            tables[kind], states[kind] = Table(automaton, PRIOR), len(automaton.next)
            # of few examples the least tells little, so two deviations below the mean are let through as well
            thresholds[kind] = float(min(np.quantile(held, 1 - ACCEPT), held.mean() - 2 * held.std()))
    plain = sorted({t for t in ordinary if len(t) <= LONGEST}, key=lambda t: (xxhash.xxh3_64_intdigest(t), t))
    if not plain or not tables:
        return Models(tables, thresholds, None, states)
    kinds, automaton = Models(tables, thresholds, None, states), None
    while plain:
        automaton, held = infer_checked(plain, ALPHAS[:1])
        # bare credentials are among the drawn tokens: those go that a kind explains better than the tokens of the
        # other folds do, until none is left; words and numbers always stay
        taken = kinds.accepted(plain, held * (np.fromiter(map(len, plain), np.int64, len(plain)) + 1), MARGIN / 2)
        if not taken.any():
            break
        plain, automaton = [t for t, out in zip(plain, taken) if not out], None
    if automaton is not None:
        states["ordinary"] = len(automaton.next)
    return Models(tables, thresholds, Table(automaton, PRIOR) if automaton is not None else None, states)


def parts_of(run: bytes) -> list[tuple[int, int]]:
    """(start, end) within a run of what is judged: the run without punctuation at its ends, then its
    parts between / . = +, then those between all separators; 8 symbols at least, each once."""
    start = len(run) - len(run.lstrip(b"._-/+="))
    whole = (start, len(run.rstrip(b"._-/+")))
    if run.isalnum():
        return [whole]
    found = [whole, *(m.span() for m in PART.finditer(run)), *(m.span() for m in ATOM.finditer(run))]
    return [s for s in dict.fromkeys(found) if s[1] - s[0] >= 8]


class Judge(dict):
    """For each run of symbols seen by a worker, the spans in it that the models accept."""

    def __init__(self, models: Models):
        super().__init__()
        self.models = models

    def settle(self, runs: set[bytes]):
        """Judge all runs that are not known yet."""
        if len(self) > CACHE_RUNS:
            self.clear()
        fresh = [r for r in runs if r not in self]
        parts = [parts_of(r) for r in fresh]
        ok = self.models.accepted([r[a:b] for r, p in zip(fresh, parts) for a, b in p]).tolist()
        i = 0
        for r, p in zip(fresh, parts):
            taken: list[tuple[int, int]] = []
            for span, good in zip(p, ok[i : i + len(p)]):
                # larger parts come first, and no part is taken twice
                if good and not any(span[0] < e and s < span[1] for s, e in taken):
                    taken.append(span)
            i += len(p)
            self[r] = sorted(taken)


def model_spans(text: bytes, judge: Judge, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Accepted spans of the text, those left out that touch a base span. The text's runs are settled."""
    busy = sorted((s, e) for _, s, e in base)
    starts, out = np.array([s for s, _ in busy]), []
    for m in RUN.finditer(text):
        for a, b in judge[m[0]]:
            s, e = m.start() + a, m.start() + b
            # base spans of different kinds may overlap: look at all that start before e
            if not any(x < e and s < y for x, y in busy[: int(np.searchsorted(starts, e))]):
                out.append((3, s, e))
    return out


def scan_texts(texts: list[bytes | None], judge: Judge) -> list[tuple[list, list]]:
    """(base spans, model spans) of each whole text, in bytes."""
    base = [base_spans(t) if t else [] for t in texts]
    if not judge.models.tables:
        return [(b, []) for b in base]
    runs = [RUN.findall(t) if t else [] for t in texts]
    judge.settle({r for own in runs for r in own})
    return [(b, model_spans(t, judge, b) if any(map(judge.__getitem__, own)) else []) for t, b, own in zip(texts, base, runs)]


class Smallest:
    """The k distinct values of smallest hash among all that are added."""

    def __init__(self, k: int):
        self.k, self.held, self.bound = k, {}, 1 << 64

    def add(self, value: bytes):
        h = xxhash.xxh3_64_intdigest(value)
        if h <= self.bound:
            self.held[value] = h
            if len(self.held) > 4 * self.k + 1000:
                self.cut()

    def cut(self):
        best = sorted(self.held.items(), key=lambda x: (x[1], x[0]))[: self.k]
        self.held = dict(best)
        if len(best) == self.k and best:
            self.bound = best[-1][1]
        return best


def sample(docs: DataFrame, per_kind: int, ordinary: int) -> dict[str, list[bytes]]:
    """At most per_kind distinct credentials of each base kind, and ordinary tokens drawn from all texts:
    those of smallest hash, kept by each task and then over all tasks."""

    def run(batches):
        kept = {k: Smallest(per_kind) for k in KINDS[:3]} | {"ordinary": Smallest(ordinary)}
        for b in batches:
            for t in b.column(0).to_pylist():
                spans = base_spans(t)
                for k, s, e in spans:
                    kept[KINDS[k]].add(value_of(t, k, s, e))
                if spans:
                    # what the base patterns found is not ordinary
                    for _, s, e in sorted(spans, key=lambda x: -x[2]):
                        t = t[:s] + b" " + t[e:]
                add = kept["ordinary"].add
                for r in RUN.findall(t):
                    if r.isalnum():
                        add(r)
                    else:
                        for x, y in parts_of(r):
                            add(r[x:y])
        for kind, own in kept.items():
            rows = own.cut()
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(rows), pa.string()), pa.array([h - (1 << 63) for _, h in rows], pa.int64()), pa.array([v for v, _ in rows], pa.binary())], ["kind", "h", "value"])

    small_batches(docs.sparkSession)
    body = docs.where("text is not null").select(F.col("text").cast("binary").alias("text"))
    found = materialize(body.mapInArrow(run, "kind string, h long, value binary").distinct())
    parts = [found.where(F.col("kind") == k).orderBy("h", "value").limit(n).select("kind", "value") for k, n in (*((k, per_kind) for k in KINDS[:3]), ("ordinary", ordinary))]
    out: dict[str, list[bytes]] = {}
    for r in parts[0].union(parts[1]).union(parts[2]).union(parts[3]).collect():
        out.setdefault(r["kind"], []).append(bytes(r["value"]))
    return out


def train(docs: DataFrame, per_kind: int = 600, ordinary: int = 2000) -> Models:
    """Automata from at most per_kind base credentials of each kind and so many ordinary tokens of docs(text)."""
    found = sample(docs, per_kind, ordinary)
    plain = found.pop("ordinary", [])
    return learn(found, plain)


def to_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    lead = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(k, int(lead[s]), int(lead[e])) for k, s, e in spans]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], x[0])))


def scan(docs: DataFrame, models: Models) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model) for each row of docs(doc_id, text).

    Null and empty texts count as empty: no spans and the hash of the empty
    string. Repeated rows get a row each; other columns are not looked at.
    One pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)  # a few automata of at most per_kind tokens each
    small_batches(docs.sparkSession)

    def run(batches):
        judge = Judge(shared.value)
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                texts = part.column(1).to_pylist()
                n, sha, all_spans = [[], [], [], []], [], []
                for t, (base, more) in zip(texts, scan_texts(texts, judge)):
                    base, more = to_code_points(t or b"", base), to_code_points(t or b"", more)
                    for k in range(3):
                        n[k].append(sum(x[0] == k for x in base))
                    n[3].append(len(more))
                    sha.append(hashlib.sha256(written(base).encode()).hexdigest())
                    all_spans.append(written(base + more))
                counts = [pa.array(x, pa.int64()) for x in n]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *counts[:3], pa.array(sha, pa.string()), pa.array(all_spans, pa.string()), counts[3]],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"],
                )

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return body.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long")


def redact(docs: DataFrame, models: Models, mark: str = "<SECRET>") -> DataFrame:
    """docs with every found span of `text` replaced by mark; overlapping spans become one mark.

    All columns stay; n_chars, where there is one, follows the new text. Null
    texts stay null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    small_batches(docs.sparkSession)

    def clean(batches):
        judge = Judge(shared.value)
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                texts, out = part.column(0).to_pylist(), []
                for t, (base, more) in zip(texts, scan_texts(texts, judge)):
                    at, pieces = 0, []
                    for _, s, e in sorted(base + more, key=lambda x: x[1]):
                        if s >= at:
                            pieces += [t[at:s], mark.encode()]
                        at = max(at, e)
                    out.append(t if t is None or not pieces else b"".join([*pieces, t[at:]]))
                text = pa.array([None if t is None else t.decode("utf-8", "replace") for t in out], pa.string())
                yield pa.RecordBatch.from_arrays([text, *part.columns[1:]], ["text", *part.schema.names[1:]])

    rest = [c for c in docs.columns if c != "text"]
    schema = T.StructType([T.StructField("text", T.StringType()), *[docs.schema[c] for c in rest]])
    done = docs.select(F.col("text").cast("binary").alias("text"), *[F.col(f"`{c}`") for c in rest]).mapInArrow(clean, schema)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
