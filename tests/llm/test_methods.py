"""The methods of the training-data operators against plain versions, and each stage of the pipeline on awkward rows."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from padron.llm import common, hilbert_packing, license_index, nn_descent, oph_minhash, phrase_index, queries, secret_automata, sentence_spans, suffix_dedup
from tests.llm.test_operators import DE, EN, LONG, brute_components, brute_repeats, by_row, documents
from tests.test_oracles import rows as comparable

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert comparable(queries.queries()[name](spark, SF).toPandas()) == comparable(con.sql(queries.oracle_sql()[name]).df())


# ---- shared helpers ----


def test_components_of_chains_stars_and_cycles(spark):
    rng = np.random.default_rng(0)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(2000, 2001), (2001, 2002), (2002, 2000), (7, 7)] + [tuple(x) for x in rng.integers(3000, 3400, (260, 2)).tolist()]
    nodes = sorted({x for e in edges for x in e})
    linked = {tuple(sorted(e)) for e in edges}
    at = {n: i for i, n in enumerate(nodes)}
    want = list(range(len(nodes)))
    moved = True
    while moved:
        moved = False
        for a, b in linked:
            low = min(want[at[a]], want[at[b]])
            for x in (a, b):
                if want[at[x]] != low:
                    want[at[x]], moved = low, True
    got = {r["id"]: r["component"] for r in common.connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: nodes[w] for n, w in zip(nodes, want) if nodes[w] != n}
    assert common.connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_discarded_tables_leave_no_folder(spark):
    import os

    df = common.materialize(spark.range(10))
    path = df._padron_path.removeprefix("file://")
    assert os.path.isdir(path) and df.count() == 10
    common.discard(df, None, spark.range(3))
    assert not os.path.exists(path)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError):
        common.shared_dir(Session())


# ---- 2 ----


def test_periodic_text_makes_few_pieces():
    text = b"A" * 200_000
    found = suffix_dedup.anchors(text)
    assert len(found) < 60 and sum(z - a + 1 for _, _, a, z, _ in found) == len(text) - suffix_dedup.SPAN + 1


@pytest.mark.parametrize("split", [4000, 3])
def test_repeats_in_periodic_and_shared_texts(spark, monkeypatch, split):
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    monkeypatch.setattr(suffix_dedup, "PIECE_WINDOWS", 700)
    rng = np.random.default_rng(4)
    draw = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = draw(700)
    rows = [(i, draw(300) + shared[: 500 + 20 * i] + draw(300)) for i in range(10)]
    rows += [(20, "xy" * 1500), (21, draw(50) + "xy" * 900), (22, "0123456789" * 40), (None, shared), (None, draw(900)), (None, None), (30, "ab" * 199 + "a")]
    assert by_row(suffix_dedup.remove_repeats(spark, documents(spark, rows))) == brute_repeats(rows, suffix_dedup.SPAN)


# ---- 3 ----


def drawn(rng, symbols, n):
    return rng.choice(np.frombuffer(symbols, np.uint8), n).tobytes()


def hex_keys(rng, n, size):
    return [drawn(rng, b"0123456789abcdef", size) for _ in range(n)]


def test_likelihood_of_an_automaton():
    """Against a plain walk over the counts, endings included; long and short tokens are scored alike."""
    a = secret_automata.Automaton([b"ab12", b"ab99", b"ac12", b"b"]).infer(0.05)
    table = secret_automata.Table(a)
    tokens = [b"ab12", b"b", b"zz", b"ab12" * 30, b"a"]

    def plain(token):
        at, total = 0, 0.0
        for c in token:
            k = secret_automata.SYMBOLS.index(c)
            spare = a.visits[at] + secret_automata.SMOOTH * 69
            total += math.log2((a.count[at].get(k, 0) + secret_automata.SMOOTH) / spare)
            onward = {}
            for s, n in a.count[at].items():
                onward[a.next[at][s]] = onward.get(a.next[at][s], 0) + n
            at = a.next[at].get(k, max(onward, key=lambda t: (onward[t], -t)) if onward else at)
        return total + math.log2((a.end[at] + secret_automata.SMOOTH) / (a.visits[at] + secret_automata.SMOOTH * 69))

    assert np.allclose(table.log2(tokens), [plain(t) for t in tokens])


def test_a_state_counts_what_the_tokens_do():
    tokens = [b"aa", b"ab", b"a", b"ba"]
    a = secret_automata.Automaton(tokens)
    assert a.visits[0] == 4 and a.left[0] == {2: 3, 1: 1} and sum(a.end) == 4
    before = sum(sum(c.values()) for c in a.count)
    child = a.next[0][secret_automata.SYMBOLS.index(b"b")]
    other = a.next[0][secret_automata.SYMBOLS.index(b"a")]
    a.fold(other, child)
    # folding moves counts, it loses none
    assert a.visits[other] == 4 and sum(sum(c.values()) for i, c in enumerate(a.count) if i != child and i != a.next[child].get(secret_automata.SYMBOLS.index(b"a"))) == before


def test_compatible_states_merge_and_others_do_not():
    rng = np.random.default_rng(2)
    fixed = secret_automata.Automaton([b"KEY-" + k for k in hex_keys(rng, 300, 12)]).infer(0.05)
    # one state for each position of the format, and the end
    assert len(fixed.next) == 17
    free = secret_automata.Automaton([drawn(rng, b"xyz", 1 + rng.geometric(0.2)) for _ in range(400)]).infer(0.05)
    assert len(free.next) < 8


def test_held_out_credentials_are_accepted_and_words_are_not():
    rng = np.random.default_rng(3)
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "an", "er")]
    words = sorted({"".join(rng.choice(syllables, rng.integers(4, 7))).encode() for _ in range(3000)})
    numbers = [b"%d.%d.%d.%d" % tuple(rng.integers(10, 255, 4)) for _ in range(200)] + [b"report-%d" % i for i in range(100, 400)]
    ordinary = [w for w in words if len(w) >= 8] + numbers
    rng.shuffle(ordinary)
    kinds = {
        "assign": [drawn(rng, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 24) for _ in range(500)],
        "access": [b"AKIA" + drawn(rng, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16) for _ in range(500)],
        "hex": hex_keys(rng, 500, 40),
    }
    models = secret_automata.learn({k: v[:300] for k, v in kinds.items()}, ordinary[:1500])
    assert all(n > 10 for n in models.states.values())
    for k, v in kinds.items():
        assert models.accepted(v[300:]).mean() >= 0.93, k
    assert models.accepted(ordinary[1500:]).mean() <= 0.01


@pytest.mark.parametrize("examples", [300, 8])
def test_numbers_and_names_are_no_credentials(examples):
    """Bare credentials with card numbers, phones, dates, names and words around them, learned from many or few examples."""
    rng = np.random.default_rng(11)
    alnum = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    kinds = {"assign": [drawn(rng, alnum, 24) for _ in range(500)], "access": [b"AKIA" + drawn(rng, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16) for _ in range(500)], "hex": hex_keys(rng, 500, 40)}
    syllables = [a + b for a in "bdfgklmnprst" for b in ("a", "e", "i", "o", "u", "an", "er")]
    words = ["".join(rng.choice(syllables, rng.integers(4, 7))).encode() for _ in range(3000)]
    card = lambda: b"%d" % rng.integers(4 * 10**15, 6 * 10**15)
    plain = words + [w.title() for w in words[:300]] + [card() for _ in range(60)] + [b"-".join(b"%04d" % n for n in rng.integers(0, 10**4, 4)) for _ in range(30)] + [b"2024-%02d-%02d" % (m, d) for m in range(1, 13) for d in (3, 17)] + [b"+52%d" % rng.integers(10**9, 10**10) for _ in range(30)] + [b"INVOICE-%d" % n for n in range(1000, 1040)]
    plain = [w for w in plain if len(w) >= 8]
    rng.shuffle(plain)
    models = secret_automata.learn({k: v[:examples] for k, v in kinds.items()}, plain[: len(plain) // 2])
    assert set(models.states) == {"assign", "access", "hex", "ordinary"}
    bare, other = [t for v in kinds.values() for t in v[300:]], plain[len(plain) // 2 :]
    text = b" ".join(x for pair in zip(bare, other) for x in pair) + b" " + b" ".join(other[len(bare) :])
    found = [text[s:e] for _, s, e in secret_automata.model_spans(text, settled(models, text), [])]
    right = set(found) & set(bare)
    assert len(right) >= 0.9 * len(found)
    for k, v in kinds.items():
        assert len(right & set(v[300:])) >= 0.9 * 200, k
    assert not any(t.isdigit() for t in found) and not models.accepted([card() for _ in range(500)]).any()


def settled(models, text):
    judge = secret_automata.Judge(models)
    judge.settle(set(secret_automata.RUN.findall(text)))
    return judge


def test_merging_goes_by_visits():
    """The heap of open states gives the order of a search through all of them at each step."""
    rng = np.random.default_rng(8)
    tokens = hex_keys(rng, 60, 12) + [b"ab-" + drawn(rng, b"xyz", 9) for _ in range(60)]
    fast = secret_automata.Automaton(tokens).infer(0.05)
    a = secret_automata.Automaton(tokens)
    settled_, seen = [0], {0}
    while True:
        open_ = [(-a.visits[t], r, c, t) for r in settled_ for c, t in a.next[r].items() if t not in seen]
        if not open_:
            break
        _, parent, symbol, child = min(open_)
        best = min(((d, r) for r in settled_ if (d := a.distance(r, child, 0.05)) is not None), default=None)
        if best is None:
            settled_.append(child)
            seen.add(child)
        else:
            a.next[parent][symbol] = best[1]
            a.fold(best[1], child)
    slow = a.reachable(settled_)
    assert (fast.next, fast.count, fast.end, fast.visits) == (slow.next, slow.count, slow.end, slow.visits)


def test_parts_of_long_tokens_are_judged():
    rng = np.random.default_rng(5)
    keys = hex_keys(rng, 120, 40)
    models = secret_automata.learn({"hex": keys[:100]}, [b"directory", b"documents", b"production", b"configuration"] * 3)
    judge = secret_automata.Judge(models)
    path = b"/".join([b"directory"] * 40) + b"/" + keys[101]
    texts = [path, b"x=" + keys[102] + b".", keys[103] * 2000, None, b""]
    out = secret_automata.scan_texts(texts, judge)
    text = path.replace(keys[101], b"z" + keys[101])  # no base hex run of its own any more changes nothing here
    assert [s[1:] for s in out[0][0]] == [(len(path) - 40, len(path))] and out[3] == ([], []) and len(text) == len(path) + 1
    # upper-case digits are no base pattern: only the parts can be found
    upper = [k.upper() for k in keys]
    models = secret_automata.learn({"hex": upper[:100]}, [b"directory", b"documents", b"production", b"configuration"] * 3)
    (base, more), = secret_automata.scan_texts([b"/".join([b"directory"] * 40) + b"/" + upper[101]], secret_automata.Judge(models))
    assert base == [] and [(e - s) for _, s, e in more] == [40]


# ---- 4 ----


def test_like_documents_share_sequences(spark):
    rng = np.random.default_rng(6)
    topics = [[f"{p}{i}" for i in range(60)] for p in ("stone", "river", "cloud", "engine", "garden", "music")]
    rows = [(i, " ".join(rng.choice(topics[i % 6], 60))) for i in range(360)]
    pieces = hilbert_packing.pack(spark, documents(spark, rows)).toPandas()
    pieces["topic"] = pieces.doc_id % 6
    same = pieces.groupby("sequence_id").topic.agg(lambda t: t.value_counts(normalize=True).iloc[0])
    assert np.average(same, weights=pieces.groupby("sequence_id").length.sum()) > 0.5  # by chance about 0.35
    tokens = pieces.groupby("sequence_id").length.sum()
    assert all(n == 2048 or n & (n - 1) == 0 for n in tokens)


def test_dense_cells_are_cut_along_the_curve(spark, monkeypatch):
    """Half of the rows in one small part of the curve, many of them copies: ranges are about equal, in order, and neighbours stay."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(hilbert_packing, "PARTITION_BYTES", 20_000)
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(80)]
    near = [(i, " ".join(base[:70] + rng.choice(base, 3).tolist())) for i in range(400)]
    copies = [(1000 + i % 150, "copy of one text " * 20) for i in range(300)]
    other = [(3000 + i, " ".join(f"{c}{x}" for c in rng.choice(list("abcdef"), 3) for x in rng.integers(0, 99, 20))) for i in range(300)]
    df = documents(spark, near + copies + other)
    got = hilbert_packing.along_the_curve(spark, df).select(F.spark_partition_id().alias("range"), "curve", "doc_id").collect()
    sizes = np.bincount([r["range"] for r in got])
    assert len(sizes) > 12 and sizes.max() <= 2.5 * sizes.mean()
    # ranges follow the curve, and no key is dealt about
    spans = {}
    for r in got:
        lo, hi = spans.get(r["range"], (r["curve"], r["curve"]))
        spans[r["range"]] = min(lo, r["curve"]), max(hi, r["curve"])
    ordered = [spans[k] for k in sorted(spans)]
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    assert len({r["range"] for r in got if 1000 <= r["doc_id"] < 3000}) >= 3
    pieces = hilbert_packing.pack(spark, df)
    assert pieces.count() >= 1000 and pieces.select("doc_id").distinct().count() == 850


def test_equal_rows_fill_several_ranges(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(hilbert_packing, "PARTITION_BYTES", 2_000)
    df = documents(spark, [(1, "the same row, again and again")] * 300)
    got = hilbert_packing.along_the_curve(spark, df).groupBy(F.spark_partition_id()).count().collect()
    assert len(got) > 5 and max(r["count"] for r in got) < 100


# ---- 6 ----


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_open_buckets_are_compared_whole(spark, monkeypatch, rounds):
    """Families whose members are near some others only: stars leave pairs, blocks find them."""
    monkeypatch.setattr(oph_minhash, "ROUNDS", rounds)
    monkeypatch.setattr(oph_minhash, "BLOCK", 7)
    monkeypatch.setattr(oph_minhash, "SPREAD", 5)
    rng = np.random.default_rng(rounds)
    rows = []
    for f in range(6):
        base = [f"f{f}w{i}" for i in range(90)]
        for k in range(25):
            w = list(base)
            for _ in range(k % 5):
                w[rng.integers(0, len(w))] = f"n{rng.integers(0, 10**6)}"
            rows.append((100 * f + k, " ".join(w)))
    sets = [set(oph_minhash.shingles(t.encode()).tolist()) for _, t in rows]
    want = brute_components(rows, lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]), [i for i, _ in rows])
    got = {r["doc_id"]: r["component_id"] for r in oph_minhash.near_duplicates(spark, documents(spark, rows)).collect()}
    assert got == want


def test_an_id_with_two_texts(spark):
    one, two = EN * 3, DE * 3
    got = by_row(oph_minhash.near_duplicates(spark, documents(spark, [(1, one), (1, two), (5, two), (0, one)])).select("doc_id", "component_id", "kept"))
    assert got == sorted([(1, 0, False), (1, 1, True), (5, 1, False), (0, 0, True)], key=str)


def test_shared_counts_of_a_block():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (5, 20, 40, 1)]
    held = oph_minhash.Held(sets)
    for s in [*sets, np.array([999], np.uint64)]:
        assert held.shared(s).tolist() == [len(np.intersect1d(s, x)) for x in sets]


# ---- 7 ----


def test_recall_is_measured_where_nothing_links(spark, monkeypatch):
    """Random vectors have no links: planted pairs tell whether any would be found, and a graph that finds none fails."""
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 32)))] + [(400, None), (401, [0.0] * 32), (402, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nn_descent.near_duplicates(spark, df).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == {(i, 0, i, True) for i in range(403)}
    classes = spark.createDataFrame([(7, 7, 1, 32, np.eye(32)[3].tobytes())], "node long, first long, weight long, dim int, unit binary")
    partner = np.frombuffer(nn_descent.planted(classes).first()["unit"], np.float64)
    assert nn_descent.COSINE <= partner[3] <= nn_descent.COSINE + 1e-5 and abs(partner @ partner - 1) < 1e-12
    monkeypatch.setattr(nn_descent, "TRIES", 1)
    found = nn_descent.confirmed
    monkeypatch.setattr(nn_descent, "confirmed", lambda graph, nodes: found(graph, nodes).limit(0))
    with pytest.raises(RuntimeError):
        nn_descent.near_duplicates(spark, df)
    # with many true links the audit itself sees that they are missing
    many = spark.createDataFrame([(i, (np.eye(16)[i % 16] + 0.01 * v).tolist()) for i, v in enumerate(rng.normal(size=(300, 16)))], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError):
        nn_descent.near_duplicates(spark, many)


def test_every_component_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 8)
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(30, 24))
    x = np.concatenate([rng.normal(size=(200, 24)), np.repeat(centre, 5, 0) + rng.normal(size=(150, 24)) * 0.09, centre[:1] + rng.normal(size=(90, 24)) * 0.1])
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)] + [(500, x[4].tolist()), (501, x[4].tolist()), (502, (x[3] * 4).tolist()), (502, x[220].tolist()), (None, x[3].tolist()), (None, None)]
    got = nn_descent.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows)
    known = [(i, np.array(v) / np.linalg.norm(v)) for i, v in rows if i is not None]
    unit = np.array([u for _, u in known])
    near = unit @ unit.T >= nn_descent.COSINE
    label = list(range(len(known)))
    for a in range(len(known)):
        for b in np.flatnonzero(near[a]):
            la, lb = label[a], label[b]
            if la != lb:
                label = [min(la, lb) if x in (la, lb) else x for x in label]
    lowest = {}
    for (i, _), c in zip(known, label):
        lowest[c] = min(i, lowest.get(c, i))
    want = [(i, int(near[k].sum()) - 1, lowest[label[k]]) for k, (i, _) in enumerate(known)]
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None) == sorted(want)
    assert all((r["n_links"], r["component_id"], r["kept"]) == (0, None, True) for r in got if r["vec_id"] is None)


def test_low_recall_fails(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "audit", lambda *a: (0.5, 300))
    monkeypatch.setattr(nn_descent, "TRIES", 1)
    with pytest.raises(RuntimeError):
        nn_descent.near_duplicates(spark, spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.1])], "vec_id long, embedding array<double>"))


# ---- 8 ----


def test_repeats_of_rows_without_an_id(spark):
    text = "One sentence of some length stands here. Another one of some more length follows it here at once. End."
    got = [r["kept_text"] for r in sentence_spans.remove_repeats(spark, documents(spark, [(None, text), (3, text), (2, "Something else.")])).orderBy("doc_id").collect()]
    assert got == [text, "Something else.", ""]


# ---- 9 ----


def test_whole_and_edited_licences(spark):
    rng = np.random.default_rng(10)
    rows = []
    known = license_index.templates()
    for k, label in enumerate(license_index.TEXTS):
        words, phrases = next(([w.decode() for w in w], p) for l, w, p in known if l == label)
        for _ in range(len(words) // 80):
            at = int(rng.integers(0, len(words)))
            edited = [*words[:at], "inserted", *words[at:]]
            if all(b" ".join(p).decode() in " ".join(edited) for p in phrases):  # mandatory phrases stay whole
                words = edited
        rows.append((k, f"{EN} {' '.join(words)} {DE}"))
    rows += [(100, EN * 30), (101, "merchantability warranty copyright holders liable software sublicense noninfringement"), (102, "Licensed under CC BY-SA 4.0"), (103, "licensed under the GNU General Public License, version 3."), (104, "GNU General Public License"), (105, None)]
    out = {r["doc_id"]: r for r in license_index.scan_licenses(spark, documents(spark, rows)).collect()}
    for k, label in enumerate(license_index.TEXTS):
        assert label in out[k]["labels"].split(","), label
    assert "bsd-2-clause" not in out[list(license_index.TEXTS).index("bsd-3-clause")]["labels"]
    assert "gpl-3.0" not in out[list(license_index.TEXTS).index("gpl-2.0")]["labels"]
    assert out[100]["labels"] == out[101]["labels"] == out[105]["labels"] == "" and out[104]["labels"] == "gpl"
    assert out[102]["labels"] == "cc-by,cc-by-sa-4.0" and out[103]["labels"] == "gpl,gpl-3.0"


def test_alignments_against_a_plain_search():
    """The same votes, found by comparing every word of a file with every word of every template."""
    rng = np.random.default_rng(11)
    known = license_index.templates()
    index = license_index.Index(100, {b"the": 90, b"of": 80, b"license": 5}, known)
    files = []
    for k in range(14):
        t = known[k][1]
        cut = [w for w in t if rng.random() > 0.03]
        files.append([b"pad"] * int(rng.integers(0, 30)) + cut + [b"tail"] * 5 + (known[(k + 3) % 14][1] if k % 4 == 0 else []))
    files += [[b"merchantability", b"sublicense"] * 20, list(known[0][1][: len(known[0][1]) // 3])]
    for words in files:
        want = set()
        for t, (label, body, phrases) in enumerate(known):
            listed = {w for w, p in index.postings.items() if any(k == t for k, _ in p)}
            own = sorted(listed & set(words), key=lambda w: (-index.idf[w], w))[: license_index.RARE]
            votes = [(i - p, w) for w in own for i, x in enumerate(words) if x == w for p, y in enumerate(body) if y == w]
            for start in sorted({s for s, _ in votes}):
                near = {w for s, w in votes if start <= s <= start + index.slip[t]}
                window = words[max(0, start - index.slip[t]) : start + len(body) + 2 * index.slip[t]]
                text = b" " + b" ".join(window) + b" "
                if len(near) > 1 and sum(index.idf[w] for w in near) >= index.needed[t] and all(b" " + b" ".join(p) + b" " in text for p in phrases):
                    want.add(label)
        matches = index.matches(words, index.postings.keys() & set(words))
        got = {m[0] for m in matches}
        # what stands within a longer match is left out, such as the notices that a licence text quotes
        assert got <= want and bool(got) == bool(want)
        quoted = {l for l, body, _ in known for m in matches for o in known if o[0] == m[0] and len(o[1]) > len(body)}
        assert want - got <= quoted


# ---- the pipeline ----


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """labels and benchmark beside documents of every awkward kind."""
    where = tmp_path_factory.mktemp("tables")
    rng = np.random.default_rng(0)
    plain = [f"plain{i}" for i in range(300)]
    text = lambda bad: " ".join([*rng.choice(plain, 60), *rng.choice(["idiot", "moron", "scum"], bad)])
    item = " ".join(f"bench{i}" for i in range(14))
    rows = [(i, text(0)) for i in range(60)] + [(60 + i, text(4)) for i in range(30)]
    rows += [(None, None), (200, None), (201, ""), (202, LONG), (203, EN), (203, EN), (None, EN), (204, DE), (204, item + " x"), (None, item), (None, text(5)), (205, "password = abcdefgh12"), (206, EN + " more")]
    spark.createDataFrame([(i, int(i >= 60)) for i in range(90)], "doc_id long, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return str(where), documents(spark, rows).selectExpr("*", "1 as row_number"), rows


def kept_of(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_toxicity_stage(spark, tables):
    where, docs, rows = tables
    out = corpus_pipeline.drop_toxic(spark, docs, where)
    assert out.columns == docs.columns
    assert kept_of(out) == sorted([r for r in rows if not (r[1] and any(w in r[1] for w in ("idiot", "moron", "scum")))], key=str)
    assert corpus_pipeline.drop_toxic(spark, docs.limit(0), where).count() == 0


def test_near_copy_stage(spark, tables):
    where, docs, rows = tables
    out = corpus_pipeline.drop_near_copies(spark, docs, where)
    assert out.columns == docs.columns
    # 204's second text is a near copy of the row without an id, which comes last
    want = [r for r in rows if r[1] != EN and not (r[0] is None and r[1] and "bench3" in r[1])] + [(203, EN)]
    sets = [oph_minhash.shingles((EN + " more").encode()), oph_minhash.shingles(EN.encode())]
    both = len(np.intersect1d(*sets))
    if 100 * both >= corpus_pipeline.NEAR_PERCENT * len(np.union1d(*sets)):
        want.remove((206, EN + " more"))
    assert kept_of(out) == sorted(want, key=str)
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), where).count() == 0


def test_leak_stage(spark, tables):
    where, docs, rows = tables
    out = corpus_pipeline.drop_leaks(spark, docs, where)
    assert out.columns == docs.columns
    # the other text of id 204 and the other rows without an id stay
    assert kept_of(out) == sorted([r for r in rows if not (r[1] and "bench3" in r[1])], key=str)
    assert corpus_pipeline.drop_leaks(spark, docs.limit(0), where).count() == 0


def test_secret_stage(spark, tables):
    where, docs, rows = tables
    out = corpus_pipeline.redact_secrets(spark, docs, where)
    assert out.columns == docs.columns
    assert kept_of(out) == sorted([(i, "<SECRET>" if i == 205 else t) for i, t in rows], key=str)
    assert corpus_pipeline.redact_secrets(spark, docs.limit(0), where).count() == 0


def test_packing_stage_and_the_whole_run(spark, tables):
    where, docs, rows = tables
    pieces = corpus_pipeline.pack(spark, docs, where)
    whole = pieces.groupBy("doc_id").sum("length").count()
    assert whole == len({i for i, _ in rows}) and pieces.where("doc_id = 201").collect()[0]["doc_tokens"] == 1
    assert corpus_pipeline.pack(spark, docs.limit(0), where).count() == 0
    docs.write.mode("overwrite").parquet(f"{where}/documents.parquet")
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, where).collect()}
    assert packed == {i for i, t in rows if t is None or not any(w in t for w in ("idiot", "moron", "scum"))} - ({206} & ({206} - packed))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "decontamination", "secrets", "packing"]
    assert hashlib.sha256(b"").hexdigest() in {r["items_sha256"] for r in phrase_index.match(spark, docs, spark.read.parquet(f"{where}/benchmark.parquet")).collect()}
