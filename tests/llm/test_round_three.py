"""Manifest, lexical search and pattern packing against plain versions, on rows of every awkward kind."""

import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from padron.llm import lexical_search, merkle_manifest, pattern_packing
from tests.llm.test_operators import DE, EN, LONG, by_row, documents

H = lambda s: sha256(s.encode()).hexdigest()


# ---- 11 ----


def brute_tree(nodes):
    """(root, for each node its siblings with their sides) by the definition, level by level."""
    proofs = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            run = nodes[p - p % 2 : p - p % 2 + 2]
            proofs[k].append("N" if len(run) == 1 else ("L" + run[0] if p % 2 else "R" + run[1]))
        nodes = [H("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        place = [p // 2 for p in place]
    return nodes[0], proofs


@pytest.mark.parametrize("n", [*range(1, 20), 31, 32, 33, 100])
def test_appending_gives_the_tree_and_its_witnesses(n):
    leaves = [H(str(i)) for i in range(n)]
    steps, root = merkle_manifest.append_all(leaves, True, 10)
    assert (root, steps) == brute_tree(leaves)


def test_the_last_block_rises_to_full_height():
    steps, root = merkle_manifest.append_all([H("a")], False, 3)
    assert steps == [["N", "N", "N"]] and root == H(H(H(H("a"))))


def manifest_rows(spark):
    odd = [(None, "no id", "en"), (None, "no id", "en"), (3, None, None), (3, "", None), (4, LONG, "en"), (5, "ß…—", ""), (5, "same", "de"), (5, "same", "de"), (5, "other", "de")]
    rows = [(i, f"text {i}", ("en", "en", "en", "de", "fr")[i % 5]) for i in range(100, 230)] + odd
    df = spark.createDataFrame([(i, t, lang, None if i == 110 else "s", None if i == 121 else i) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({"grp": F.lit(1), "idx": F.lit("x"), "digest": F.lit(0), "steps": F.lit(0), "key": F.lit("k"), "root": F.lit("r")})


def brute_manifest(rows):
    def leaf(r, more=0):
        n = None if r["n_chars"] is None else r["n_chars"] + more
        values = [r["doc_id"], r["source"], r["lang"], n, r["text"]]
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = own, *brute_tree([leaf(r) for r in own])
    root, above = brute_tree([trees[g][1] for g in order])
    out = []
    for k, g in enumerate(order):
        own, subroot, proofs = trees[g]
        for r, proof in zip(own, proofs):
            steps = proof + above[k]
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            at = leaf(r, 1) if bad else leaf(r)
            for s in steps:
                at = H(s[1:] + at if s[0] == "L" else at + s[1:] if s[0] == "R" else at)
            out.append((r["doc_id"], leaf(r), subroot, root, H("".join(s[1:] for s in steps)), at, at == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("shift", [10, 2])
def test_manifest_of_odd_rows(spark, monkeypatch, shift):
    monkeypatch.setattr(merkle_manifest, "SHIFT", shift)
    df = manifest_rows(spark)
    got = by_row(merkle_manifest.verify(spark, df))
    assert got == brute_manifest(df.collect())
    # tampered rows fail, and no others
    assert {r[6] for r in got} == {True, False} and all((r[1] == r[1] and r[5] == r[3]) == r[6] for r in got)


def test_manifest_of_one_row_and_of_none(spark):
    df = manifest_rows(spark)
    one = df.filter("doc_id = 4")
    assert by_row(merkle_manifest.verify(spark, one)) == brute_manifest(one.collect())
    assert merkle_manifest.verify(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("cuts", [(0.4, 0.7), (0.02, 0.5)])
def test_appends_extend_the_witnesses_of_earlier_rows(spark, monkeypatch, cuts):
    """Rows appended in three parts have the witnesses and roots of a manifest built at once."""
    monkeypatch.setattr(merkle_manifest, "SHIFT", 2)
    rows = [(f"g{i % 10 if i % 10 < 2 else 0}", i, H(str(i))) for i in range(150)] + [("late", 1000 + i, H(f"late{i}")) for i in range(5)]
    df = spark.createDataFrame(rows, "grp string, key int, digest string")
    whole = merkle_manifest.append(None, df, ["key"])
    parts = [df.filter(f"key < {150 * cuts[0]}"), df.filter(f"key >= {150 * cuts[0]} and key < {150 * cuts[1]}"), df.filter(f"key >= {150 * cuts[1]}")]
    grown = None
    for p in parts:
        grown = merkle_manifest.append(grown, p, ["key"])
        so_far = merkle_manifest.append(None, df.filter(f"key <= {p.agg(F.max('key')).first()[0]}"), ["key"])
        want, got = (sorted(map(tuple, m.witnesses().select("grp", "idx", "key", "digest", "subroot", "steps").collect()), key=str) for m in (so_far, grown))
        assert got == want
    assert sorted(map(tuple, grown.roots().collect())) == sorted(map(tuple, whole.roots().collect()))
    # full blocks of leaves are carried over as they were
    assert grown.sizes().filter("grp = 'g0'").first()["n"] == sum(r[0] == "g0" for r in rows)


# ---- 12 ----


def brute_ranks(rows, items, k):
    docs = [(i, Counter(lexical_search.words_of((t or "").encode()))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs]
    n, total = sum(s > 0 for _, _, s in docs), sum(s for _, _, s in docs)
    df = Counter(w for _, c, _ in docs for w in c)
    terms = {}
    for i, t in items:
        if i is not None and t is not None:
            terms.setdefault(i, set()).update(lexical_search.words_of(t.encode()))
    out = []
    for item, own in terms.items():
        scored = []
        for i, c, s in docs:
            score = sum(lexical_search.weight(n, df[w]) * lexical_search.impact(c[w], s, n, total) for w in own if c[w])
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def searched():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    share = 1 / np.arange(1, 401)
    draw = lambda n: " ".join(rng.choice(vocabulary, n, p=share / share.sum()))
    rows = [(i, draw(int(rng.integers(1, 80)))) for i in range(700)]
    rows += [(None, "w3 w399 alone"), (None, None), (701, ""), (702, " … . "), (703, LONG), (704, "w7 " * 3000), (705, "Ünïcode w5"), (706, "ÜNÏCODE W5"), (9, rows[9][1]), (9, rows[9][1]), (707, "tie tie"), (708, "tie tie"), (5000, "tie tie"), (-3, "tie tie")]
    items = [(i, draw(12)) for i in range(25)] + [(100, None), (None, "w1"), (101, "  . "), (102, "nowhere to be found"), (103, "w1 w1 w1"), (104, "tie"), (105, "w2"), (105, "w3 tie"), (106, "ünïcode"), (107, "w0")]
    return rows, items


@pytest.mark.parametrize("docs, k", [(65_000, 50), (150, 5), (90, 1)])
def test_search_equals_scoring_all(spark, monkeypatch, searched, docs, k):
    """Exact ranks, ties and all, with shards of several sizes."""
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", docs)
    rows, items = searched
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    got = by_row(lexical_search.rank_documents(spark, documents(spark, rows), bench, k))
    assert got == brute_ranks(rows, items, k)


@pytest.mark.parametrize("block, window, k", [(8, 16, 1), (3, 7, 5), (128, 512, 50), (1, 1, 2)])
def test_a_shards_heap_equals_scoring_all(monkeypatch, searched, block, window, k):
    """With blocks and windows of several sizes, so that bounds reject at all of their edges."""
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "FIRST_WINDOW", window)
    rows, items = searched
    shard = lexical_search.Shard()
    for i, t in rows:
        shard.add(i, t.encode() if t is not None else None)
    rows_of = [r for b in shard.rows(0) for r in b.to_pylist()]
    n, total = rows_of[0]["n_docs"], rows_of[0]["n_tokens"]
    lists = lexical_search.Lists(n, total)
    for r in rows_of:
        lists.add(r)
    df = {r["term"]: r["df"] for r in rows_of[1:]}
    want = brute_ranks(rows, items, k)
    for item in {i for i, _ in items if i is not None}:
        own = {w for i, t in items if i == item and t for w in lexical_search.words_of(t.encode())} & df.keys()
        query = [(w, v := lexical_search.weight(n, df[w]), v * int(lists.lists[w][1].max())) for w in own]
        assert [(item, r, i, s) for r, (s, i) in enumerate(lists.top(query, k), 1)] == sorted((x for x in want if x[0] == item), key=lambda x: x[1])


def test_items_in_several_blocks(spark, monkeypatch, searched):
    rows, items = searched
    monkeypatch.setattr(lexical_search, "ASKED", 40)
    got = by_row(lexical_search.rank_documents(spark, documents(spark, rows[:200]), spark.createDataFrame(items, "item_id long, text string"), 7))
    assert got == brute_ranks(rows[:200], items, 7)


def test_blocks_hold_what_went_in():
    rng = np.random.default_rng(1)
    docs = np.sort(rng.choice(60_000, 1000, replace=False))
    tf, lengths = rng.choice([1, 2, 255, 256, 257, 70_000], 1000), rng.integers(1, 5000, 1000)
    starts = np.array([0, 128, 256, 300, 999])
    blocks, lasts, counts, best = lexical_search.compressed(docs, tf, lengths, starts)
    back = [lexical_search.opened(b) for b in blocks]
    assert (np.concatenate([d for d, _ in back]) == docs).all() and (np.concatenate([t for _, t in back]) == tf).all()
    assert lasts.tolist() == docs[[127, 255, 299, 998, 999]].tolist()
    # the best pairs give each block's maximum under any statistics
    ends = np.cumsum(counts)
    for n, total in ((1000, 10_000), (7, 3_000_000)):
        for k, (a, z) in enumerate(zip(starts, [*starts[1:], 1000])):
            p = best[ends[k] - counts[k] : ends[k]]
            assert lexical_search.impact(p[:, 0], p[:, 1], n, total).max() == lexical_search.impact(tf[a:z], lengths[a:z], n, total).max()


def test_bounds_leave_blocks_closed():
    """A rare and a very common term: once the heap is full, blocks of the common one stay compressed."""
    shard = lexical_search.Shard()
    for i in range(20_000):
        shard.add(i, b"common rare rare" if i < 300 else b"common filler" + b" x" * (i % 50))
    lists = lexical_search.Lists(20_000, sum(shard.lengths))
    rows = [r for b in shard.rows(0) for r in b.to_pylist() if r["term"] in (None, b"common", b"rare")]
    for r in rows:
        lists.add(r)
    df = {r["term"]: r["df"] for r in rows if r["term"]}
    query = [(t, w := lexical_search.weight(20_000, df[t]), w * int(lists.lists[t][1].max())) for t in df]
    query[0] = (query[0][0], 5, 5 * int(lists.lists[query[0][0]][1].max()))  # a small weight instead of none
    top = lists.top(query, 10)
    assert [i for _, i in top] == list(range(10))
    assert lists.opened < 12 < len(lists.lists[b"common"][2])


def test_search_of_empty_tables(spark, searched):
    rows, items = searched
    docs, bench = documents(spark, rows[:50]), spark.createDataFrame(items, "item_id long, text string")
    assert lexical_search.rank_documents(spark, docs.limit(0), bench).count() == 0
    assert lexical_search.rank_documents(spark, docs, bench.limit(0)).count() == 0
    assert lexical_search.rank_documents(spark, documents(spark, [(1, None), (2, "")]), bench).count() == 0


# ---- 13 ----


def plain_ids(text):
    return pattern_packing._tokenizer(pattern_packing.default_tokenizer()).encode(text or "", add_special_tokens=False).ids + [pattern_packing.END]


ODD_TEXTS = [None, "", " ", "áb don't I'M x'lls 12 34", " x y　z\x85w", "ΑΣ ΣΑΣ.", "<|endoftext|> a", "a <|startoftext|>b", "a\x1cb", "İstanbul ÄÖ", "ﬁ ½ ²³ x²", "é É ño", "́ x", "a​b﻿c", "x'\nS y's", "É É, K, Å. x.. y.! z, 3.14 a.b", "Ωmega Straße ǅ ŉ", "emoji 😀👍🏽 end", "…“—” "]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_tokens_are_the_tokenizers(text):
    path = pattern_packing.default_tokenizer()
    for _ in range(2):  # from the tokenizer, then from memory
        assert np.frombuffer(pattern_packing.token_bytes(text, path), "<u4").tolist() == plain_ids(text)


def covered(kinds):
    out = np.zeros(pattern_packing.LENGTH + 1, np.int64)
    for runs, n in kinds:
        assert n > 0 and sum(a * b for a, b in runs) <= pattern_packing.LENGTH
        for length, copies in runs:
            out[length] += copies * n
    return out


def histogram(lengths):
    return np.bincount(lengths, minlength=pattern_packing.LENGTH + 1)


@pytest.mark.parametrize("seed", range(4))
def test_plans_place_every_document_once_and_tightly(seed):
    rng = np.random.default_rng(seed)
    made = [np.minimum(2048, rng.lognormal(6.5, 1, 20_000).astype(int) + 1), rng.integers(1, 60, 5000), rng.integers(700, 1400, 5000), np.append(np.full(3000, 1500), rng.integers(1, 2049, 3000))][seed]
    counts = histogram(made)
    kinds = pattern_packing.plan(counts)
    assert (covered(kinds) == counts).all()
    used, least = sum(n for _, n in kinds), -(-int(made.sum()) // pattern_packing.LENGTH)
    plain = sum(n for _, n in pattern_packing.best_fit(counts))
    assert used <= plain
    if seed < 2:
        assert used <= 1.001 * least + 1


def test_patterns_and_fit():
    counts = np.zeros(pattern_packing.LENGTH + 1, np.int64)
    counts[[1024, 2000, 48, 1000, 24]] = [10, 7, 4, 6, 12]
    ways = pattern_packing.patterns(counts)
    assert sorted(map(tuple, ways.tolist())) == [(1000, 1000, 48), (1024, 1000, 24), (1024, 1024, 0), (2000, 24, 24), (2000, 48, 0)]
    x = pattern_packing.fit(counts, ways, 3000)
    use = np.zeros(len(counts))
    for n, way in zip(x, ways):
        for length in way:
            use[length] += n * (length > 0)
    assert (x >= 0).all() and np.abs(use - counts)[1:].max() < 0.05
    kinds, left = pattern_packing.rounded(x, ways, counts)
    assert ((covered(kinds) + left) == counts).all() and (left >= 0).all()
    assert sum(n for _, n in pattern_packing.plan(counts)) == 15  # 30,720 ids: 15 full sequences


def test_best_fit_of_few():
    assert pattern_packing.plan(histogram([1])) == [([(1, 1)], 1)]
    assert pattern_packing.plan(histogram([])) == []
    assert sum(n for _, n in pattern_packing.plan(histogram([2048] * 3 + [1] * 5000))) == 3 + 3
    assert sum(n for _, n in pattern_packing.best_fit(histogram([1500] * 10 + [300] * 3 + [500] * 4))) == 10


def test_packing_round_trip(spark):
    rows = [(i, f"{EN} {i} {DE}" * (1 + i % 40)) for i in range(150)] + list(enumerate(ODD_TEXTS, 1000)) + [(None, EN), (7, EN), (7, EN), (7, None), (2000, LONG), (2001, "a " * 2047), (2002, "a " * 2048), (2003, "a " * 4095)]
    df = documents(spark, rows).selectExpr("*", "1 as length", "'x' as number", "2 as part")
    pieces = pattern_packing.pack(spark, df).collect()
    # every id lies in one piece, and the pieces are those of the contract
    want = []
    for i, t in rows:
        ids = np.array(plain_ids(t), "<u4")
        want += [(i, k // 2048, k, len(own := ids[k : k + 2048]), zlib.crc32(own.tobytes())) for k in range(0, len(ids), 2048)]
    assert sorted((tuple(p)[:5] for p in pieces), key=str) == sorted(want, key=str)
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1.01 * -(-sum(p["length"] for p in pieces) // 2048) + 1
    made = {r["sequence_id"]: r for r in pattern_packing.sequences(spark, df).collect()}
    assert sum(len(r["ids"]) for r in made.values()) == sum(p["length"] for p in pieces) and max(len(r["ids"]) for r in made.values()) <= 2048
    own = next(p for p in pieces if p["doc_id"] == 2000 and p["piece"] == 0)
    seq = next(r for r in made.values() if 2000 in r["doc_ids"])
    at = seq["offsets"][seq["doc_ids"].index(2000)]
    assert zlib.crc32(np.array(seq["ids"][at : at + own["length"]], "<u4").tobytes()) in {p["ids_crc32"] for p in pieces if p["doc_id"] == 2000}
    assert pattern_packing.pack(spark, df.limit(0)).count() == 0
