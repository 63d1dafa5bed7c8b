"""The training-data operators against brute force, on rows of every awkward kind."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from padron.llm import hilbert_packing, langid, license_index, nn_descent, oph_minhash, ordinal_toxicity, phrase_index, secret_automata, sentence_spans, suffix_dedup

# columns whose names the operators use themselves
EXTRA = "node long, key string, component long, id string, n int, severity string, label string, curve long, doc_key string"
LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(20_000))
EN = "The quick brown fox jumps over the lazy dog and runs through the quiet forest near the old river mill. "
DE = "Der schnelle braune Fuchs springt über den faulen Hund und läuft durch den stillen Wald an der alten Mühle. "


def documents(spark, rows):
    rows = [(i, t, None, *([0, "k", 1, "i", 2, "s", "l", 3, "d"])) for i, t in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {EXTRA}")


@pytest.fixture(scope="module")
def texts(spark):
    """Given texts and awkward ones: null, empty, blank, very long, repeated, without an id."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(120).collect()]
    odd = [(9001, None), (9002, ""), (9003, "   \n"), (9004, LONG), (9005, LONG + " tail"), (9006, EN * 6), (9006, EN * 6), (9007, EN * 6), (None, "no id at all"), (9008, "ab"), (9009, "ß…—“é”" * 100), (9010, "Orre " * 300), (9011, "one two three four"), (9012, "ONE two three four")]
    return docs + odd


def by_row(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- 1 ----


def test_forward_sums_all_segmentations(monkeypatch):
    """Against sums over all ways to cut a word; long words are read in stretches, over which pieces reach."""
    lat = langid.lattice(langid.default_vocabulary())
    prob = np.random.default_rng(0).random((2, len(lat.pieces))) / 100
    at = {p: i for i, p in enumerate(lat.pieces)}

    def totals(w):
        """log of the sum over all segmentations, by a plain recursion from the front, exact integers scaled."""
        out = []
        for k in range(2):
            sums = [1.0] + [0.0] * len(w)
            for j in range(1, len(w) + 1):
                sums[j] = sum(sums[i] * prob[k, at[w[i:j]]] * 50 ** (j - i) for i in range(j) if w[i:j] in at)
            out.append(np.log(sums[-1]) - len(w) * np.log(50))
        return out

    def cuts(w, k):
        return 1.0 if not w else sum(prob[k, at[w[:n]]] * cuts(w[n:], k) for n in range(1, len(w) + 1) if w[:n] in at)

    short = [b" the", b" b", b" thing", b"\xc3\xa9t", b" representative"]
    want = np.log([[cuts(w, k) for k in range(2)] for w in short])
    assert np.allclose(langid.forward(lat, short, prob), want) and np.allclose([totals(w) for w in short], want)
    long = [b" " + b"internationalization" * 5, b" " + "überraschung".encode() * 9, b" x" * 60, b" " + b"abc" * 80]
    assert max(map(len, lat.pieces)) > 24
    for stretch in (1 << 16, 16):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        got = [langid.long_forward(lat, w, np.log(prob).T) for w in short + long]
        assert np.allclose(got, [totals(w) for w in short + long])


def test_long_words_are_learned_like_short_ones():
    lat = langid.lattice(langid.default_vocabulary())
    prob = np.random.default_rng(1).random((2, len(lat.pieces))) / 100
    weight = np.array([[2.0, 1.0]])
    want = langid.expected_counts(lat, [b" thinking"], weight, prob)
    piece, flow = langid.long_counts(lat, b" thinking", weight[0], np.log(prob).T)
    got = np.zeros_like(want)
    np.add.at(got.T, piece, flow)
    assert np.allclose(got, want)


def test_language_predictions(spark):
    from pyspark.sql import functions as F

    rows = [(i, (EN if i % 2 else DE) + f"zahl {i}", "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 34 …", "de"), (103, EN, None), (103, EN, None), (None, DE, "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(7))
    out = {r["doc_id"]: r for r in langid.predict_languages(spark, df).collect()}
    assert all(out[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    assert [(out[i]["lang_pred"], out[i]["score"]) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert out[103]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in out.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items() if i is not None)
    assert langid.predict_languages(spark, df).count() == len(rows)


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = langid.predict_languages(spark, d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").selectExpr("avg(cast(lang = lang_pred as int))").first()[0]
    assert r > 0.95


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, EN, None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in langid.predict_languages(spark, df).collect()] == [("und", 0.0)]


# ---- 2 ----


def brute_repeats(rows, span):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for k, (_, t) in enumerate(texts):
        for p in range(len(t) - span + 1):
            seen.setdefault(t[p : p + span], []).append((k, p))
    marks = [np.zeros(len(t) + 1, int) for _, t in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                marks[k][p] += 1
                marks[k][p + span] -= 1
    out = []
    for (i, t), m in zip(texts, marks):
        gone = np.cumsum(m)[:-1] > 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), len(suffix_dedup.runs_of(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [4000, 2])
def test_suffix_dedup(spark, texts, monkeypatch, split):
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    rows = texts + [(9100, "A" * 900), (9101, "x" + EN * 5 + "y"), (9102, "é" * 450)]
    assert by_row(suffix_dedup.remove_repeats(spark, documents(spark, rows))) == brute_repeats(rows, suffix_dedup.SPAN)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    t = rng.integers(1, 3, 600).astype(np.uint16)
    sa = suffix_dedup.suffix_array(t, 600)
    s = bytes(t.astype(np.uint8))
    assert sa.tolist() == sorted(range(600), key=lambda i: s[i:])
    lcp = suffix_dedup.common_prefixes(t, sa, np.array([0]), np.array([600]), 600)

    def common(a, b):
        n = 0
        while max(a, b) + n < 600 and s[a + n] == s[b + n]:
            n += 1
        return n

    assert lcp[1:600].tolist() == [common(sa[k - 1], sa[k]) for k in range(1, 600)]


# ---- 3 ----

SECRETS = ["password = \"hunter2hunter2\"", "API_KEY: abcd1234efgh", "token=short", "AKIA" + "Z9" * 8, "AKIAX", "0123456789abcdef" * 2, "x" + "0123456789abcdef" * 3 + "y", "é secret:'Zm9vYmFyYmF6' ß", "apikey=\"" + "f0" * 20 + "\" token = a1b2c3d4e5", None, "", "PASSWD  =  aaaaaaaaaaaa"]


def test_base_secret_spans(spark):
    import re

    out = {r["doc_id"]: r for r in secret_automata.scan(documents(spark, list(enumerate(SECRETS))), secret_automata.learn({}, [])).collect()}
    for i, t in enumerate(SECRETS):
        t = t or ""
        spans = [("assign", m.start(), m.end()) for m in re.finditer(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[2]) >= 8]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        order = ["assign", "access", "hex"]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order.index(s[0]))))
        assert (out[i]["spans"], out[i]["base_sha256"]) == (text, hashlib.sha256(text.encode()).hexdigest()), t
        assert [out[i][f"n_{k}"] for k in order] == [sum(s[0] == k for s in spans) for k in order]


def test_automata_find_bare_credentials(spark):
    rng = np.random.default_rng(0)
    keys = ["".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZ23456789"), 24)) for _ in range(80)]
    rows = [(i, f"secret: \"{k}\" and words {EN}") for i, k in enumerate(keys[:60])] + [(100 + i, f"{EN} {k} {EN}") for i, k in enumerate(keys[60:])] + [(200, EN * 20), (201, "averyverylongordinarywordwithouttheslightestsecret " * 3), (202, None)]
    df = documents(spark, rows)
    out = {r["doc_id"]: r for r in secret_automata.scan(df, secret_automata.train(df)).collect()}
    assert sum(out[100 + i]["n_model"] for i in range(20)) >= 17
    assert out[200]["n_model"] == out[201]["n_model"] == out[202]["n_model"] == 0


def test_redaction(spark):
    df = documents(spark, [(1, "a token = abcdefgh12 b"), (2, None), (3, "clean")])
    got = {r["doc_id"]: r["text"] for r in secret_automata.redact(df, secret_automata.learn({}, [])).collect()}
    assert got == {1: "a <SECRET> b", 2: None, 3: "clean"}


# ---- 4 ----


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(hilbert_packing.default_tokenizer())
    rows = [(i if i is not None else -1, t) for i, t in texts if i != 9006] + [(9200, "two  spaces\n\nand <|endoftext|> it's")]
    pieces = hilbert_packing.pack(spark, documents(spark, rows)).toPandas().sort_values(["doc_id", "start"])
    assert set(pieces.doc_id) == {i for i, _ in rows}
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, hilbert_packing.END], "<u4")
        own, at = pieces[pieces.doc_id == i], 0
        for p in own.itertuples():
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert (s.offset == s.length.cumsum() - s.length).all()
        n = int(s.length.sum())
        assert n <= hilbert_packing.LENGTH and n & (n - 1) == 0


def test_repeated_rows_and_null_ids_are_packed(spark):
    out = hilbert_packing.pack(spark, documents(spark, [(1, EN), (1, EN), (None, None)])).toPandas()
    assert out.length.sum() == 2 * out[out.doc_id == 1].doc_tokens.iloc[0] + 1


def test_hilbert_curve_is_continuous(monkeypatch):
    monkeypatch.setattr(hilbert_packing, "BITS", 2)
    grid = np.array(np.meshgrid(*[range(4)] * 4)).reshape(4, -1).T
    key = hilbert_packing.hilbert_key(grid)
    assert sorted(key) == list(range(256))
    assert np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1).max() == 1


# ---- 5 ----


def test_decontamination(spark, texts):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    items = [(1, item), (2, "short item here"), (3, None), (4, "!!"), (5, " ".join(["the"] * 12)), (6, EN), (6, DE), (None, "nobody")]
    rows = texts + [(9300, f"x {item.upper()} y"), (9301, " ".join(item.split()[2:])), (9302, " ".join(item.split()[4:])), (9303, "a short item here, short item here"), (9304, "the " * 30), (9305, "é " + EN)]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id")
    got = by_row(phrase_index.match(spark, documents(spark, rows), bench))
    windows = {}
    for i, t in items:
        w = phrase_index.words_of((t or "").encode())
        for s, n in phrase_index.windows_of(w) if w and i is not None else []:
            windows.setdefault(tuple(w[s : s + n]), set()).add(i)
    want = []
    for i, t in rows:
        w, hit, ids = phrase_index.words_of((t or "").encode()), set(), set()
        for n in {len(k) for k in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    ids |= windows[tuple(w[p : p + n])]
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want, key=str)


def test_proximity_allows_slack(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = documents(spark, [(1, item.replace("beta", "beta extra")), (2, "nothing to see")])
    found = phrase_index.proximity(spark, docs, spark.createDataFrame([(7, item)], "item_id long, text string"), slack=1).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 7)]


def test_more_terms_than_are_sent_to_all_tasks(spark, texts, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = documents(spark, texts)
    whole = by_row(phrase_index.match(spark, docs, bench))
    monkeypatch.setattr(phrase_index, "BROADCAST_TERMS", 0)
    monkeypatch.setattr(phrase_index, "COUNTED", 50)
    assert by_row(phrase_index.match(spark, docs, bench)) == whole


# ---- 6 ----


def brute_components(rows, linked, ids):
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if linked(a, b):
                x, y = find(ids[a]), find(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, texts):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in rng.integers(0, 400, 200)]
    near = []
    for k in range(60):
        w = list(base)
        for _ in range(k % 6):
            w[rng.integers(0, len(w))] = f"new{rng.integers(0, 10**6)}"
        near.append((9400 + k, " ".join(w)))
    rows = [(i, t) for i, t in texts if i is not None] + near
    sets = [set(oph_minhash.shingles((t or "").encode()).tolist()) for _, t in rows]

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and 100 * len(x & y) >= 85 * len(x | y)

    want = brute_components(rows, linked, [i for i, _ in rows])
    got = oph_minhash.near_duplicates(spark, documents(spark, rows + [(None, "no id at all")])).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
            continue
        assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    sizes = {i: len(s) for (i, _), s in zip(rows, sets)}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in got if r["doc_id"] is not None)


def test_a_split_star_confirms_the_same_links(spark, texts, monkeypatch):
    docs = documents(spark, texts)
    whole = by_row(oph_minhash.near_duplicates(spark, docs))
    monkeypatch.setattr(oph_minhash, "STAR", 1)
    assert by_row(oph_minhash.near_duplicates(spark, docs)) == whole


def test_the_pipeline_drops_near_copies_from_80_percent(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(104)]
    swap = lambda *at: " ".join("new" + w if i in at else w for i, w in enumerate(words))
    # 90 of 110 shingles are shared, then 85 of 115
    docs = documents(spark, [(1, " ".join(words)), (2, swap(20, 60)), (3, swap(10, 40, 80))])
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 3]
    assert oph_minhash.near_duplicates(spark, docs).where("kept").count() == 3


# ---- 7 ----


def test_nn_descent(spark):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(40, 16))
    x = np.concatenate([rng.normal(size=(300, 16)), np.repeat(centre, 6, 0) + rng.normal(size=(240, 16)) * 0.1, centre[:1] + rng.normal(size=(80, 16)) * 0.02])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, x[3].tolist()), (1001, (x[3] * 2).tolist()), (2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] + [1.0] * 15), (2004, []), (2005, [1.0, 2.0]), (2006, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'a' as node", "1 as label", "2.0 as sim")
    got = {r["vec_id"]: r for r in nn_descent.near_duplicates(spark, df).collect()}
    assert len(got) == len(rows)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0}
    ids = sorted(unit)
    true = {i: [j for j in ids if j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= nn_descent.COSINE] for i in ids}
    found, total = sum(got[i]["n_links"] for i in ids), sum(map(len, true.values()))
    assert total * 0.9 <= found <= total and all(got[i]["n_links"] <= len(true[i]) for i in ids)
    for i in (2000, 2001, 2002, 2003, 2004):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[2006]["component_id"] == 2005 and got[1001]["component_id"] == 3


# ---- 8 ----


def plain_parts(text):
    """The text's parts, written anew: sentences, then cuts before the smallest hash of every 16 words of a long one."""
    sentences, start = [], 0
    for m in re.finditer(rb"[.!?]+\s*|\n\s*", text):
        sentences.append(text[start : m.end()])
        start = m.end()
    sentences += [text[start:]] if start < len(text) else []
    out = []
    for s in sentences:
        words = [(m.start(), m.end()) for m in re.finditer(rb"\S+", s)]
        cuts = set()
        if len(words) > 16:
            high = [int(sentence_spans._words[s[a:b].lower()]) >> 32 for a, b in words]
            for k in range(len(words) - 15):
                low = min(high[k : k + 16])
                cuts.add(max(i for i in range(k, k + 16) if high[i] == low))
        edges = [0, *[words[c][0] for c in sorted(cuts - {0})], len(s)]
        out += [s[a:b] for a, b in zip(edges, edges[1:])]
    return out


def brute_spans(rows, min_words, longer=False):
    """The shortest runs of two or more parts with enough words from and up to each part, against all others; or all
    longer ones too, then equal part by part."""
    seen, places = {}, []
    for i, t in {(i, t) for i, t in rows}:
        words = [p.lower().split() for p in plain_parts((t or "").encode())]
        real = [k for k, w in enumerate(words) if w]
        enough = [(x, y) for x in range(len(real)) for y in range(x + 1, len(real)) if sum(len(words[k]) for k in real[x : y + 1]) >= min_words]
        first, last = {}, {}
        for x, y in enough:
            first[x], last[y] = min(y, first.get(x, y)), max(x, last.get(y, x))
        chosen = set(enough) if longer else set(first.items()) | {(x, y) for y, x in last.items()}
        said = lambda x, y: tuple(tuple(words[k]) for k in real[x : y + 1]) if longer else tuple(w for k in real[x : y + 1] for w in words[k])
        own = [(said(x, y), real[x], real[y]) for x, y in chosen]
        if not own and real:
            own = [(("whole", *[w for k in real for w in words[k]]), real[0], real[-1])]
        places += [(h, (i, t), a, b) for h, a, b in own]
    for h, row, a, _ in sorted(places, key=lambda p: (p[1][0], xxh64_of(p[1][1]), p[2])):
        seen.setdefault(h, (row, a))
    out = []
    for i, t in rows:
        parts = plain_parts((t or "").encode())
        gone = set()
        for h, row, a, b in places:
            if row == (i, t) and seen[h] != (row, a):
                gone |= set(range(a, b + 1))
        out.append((i, len(parts), len(gone), None if t is None else b"".join(p for k, p in enumerate(parts) if k not in gone).decode()))
    return sorted(out, key=str)


def xxh64_of(text):
    """Spark's xxhash64 of a text as a signed number."""
    import xxhash

    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


@pytest.mark.parametrize("min_words", [0, sentence_spans.PRODUCTION_WORDS])
def test_sentence_spans(spark, texts, min_words):
    odd = [(1, "alpha beta. gamma delta."), (2, "Zeta eta! alpha  beta.\ngamma delta. theta"), (3, "the. the. the. the."), (4, "one two three. " * 5), (5, "  \n\n . . "), (6, "No end"), (6, "other. text. of six."), (9, "alpha beta. gamma delta.")]
    rows = [(i + 100, t if t is None else t[:700]) for i, t in texts if i is not None] + odd
    assert by_row(sentence_spans.remove_repeats(spark, documents(spark, rows), min_words)) == brute_spans(rows, min_words)
    # longer repeated runs would take nothing more
    assert all(more[2] <= own[2] for own, more in zip(brute_spans(odd + rows[:60], min_words), brute_spans(odd + rows[:60], min_words, True)))
    got = {r["doc_id"]: r["kept_text"] for r in sentence_spans.remove_repeats(spark, documents(spark, odd), min_words).collect()}
    # two repeated sentences go, unless so few words are not to count
    assert got[2] == ("Zeta eta! theta" if min_words == 0 else odd[1][1])


def test_repeated_passages_of_over_50_words_are_caught(spark):
    """Every 51 words that two documents share touch a removed part of the later one, however they are punctuated."""
    rng = np.random.default_rng(8)
    draw = lambda n: [f"v{x}" for x in rng.integers(0, 10**6, n)]
    rows, where = [], {}
    for k in range(60):
        passage = draw(51 + k % 5)
        for at in ([], [20], [25, 40], [10, 11, 12, 50])[k % 4]:
            passage[at] += "."
        for i in (2 * k, 2 * k + 1):
            before, after = draw(rng.integers(0, 40)), draw(rng.integers(0, 40))
            rows.append((i, " ".join(before + passage + after)))
            where[i] = len(before), passage
    whole = [(500, "One short title"), (501, "One short title"), (502, "Two. Words."), (503, "Two. Words."), (504, " ".join(draw(20)) + ". " + " ".join(draw(20)) + ". End. Of it.")]
    rows += whole + [(505, whole[-1][1]), (506, "One short title and more")]
    got = {r["doc_id"]: r for r in sentence_spans.remove_repeats(spark, documents(spark, rows), sentence_spans.PRODUCTION_WORDS).collect()}
    for k in range(60):
        assert got[2 * k]["kept_text"] == rows[2 * k][1]
        _, passage = where[2 * k + 1]
        kept = set(got[2 * k + 1]["kept_text"].split())
        assert len([w for w in passage if w not in kept]) >= 19
        assert set(rows[2 * k + 1][1].split()) - set(passage) <= kept
    assert [got[i]["kept_text"] for i in (501, 503, 505, 506)] == ["", "", "", "One short title and more"]


def test_sentences_join_to_the_text():
    for t in (b"A b. C!! d\n\n e? f", b"", b"...", b"no end", b"\n\n"):
        assert b"".join(sentence_spans.sentences(t)) == t


# ---- 9 ----


def test_licenses(spark, texts):
    rows = texts + [(9500, "x Licensed under the Apache License, Version 2.0. y"), (9501, "ALL RIGHTS RESERVED all rights reserved"), (9502, "CC-BY 4.0"), (9503, "GNU General Public License"), (9504, "apache software version"), (9505, "Licensed under the Apache Licence 2.0, apache license"), (9506, "the mit license is released under something")]
    out = {r["doc_id"]: r for r in license_index.scan_licenses(spark, documents(spark, rows)).collect()}
    assert "apache-2.0" in out[9500]["labels"].split(",") and out[9504]["labels"] == ""
    assert (out[9501]["n_base"], out[9501]["first_word"], out[9501]["last_word"], out[9501]["base_labels"]) == (2, 0, 3, "reserved")
    assert out[9502]["base_labels"] == "cc-by" and out[9503]["base_labels"] == "gpl" and out[9001]["first_word"] is None
    for i, t in rows:
        if i is None or i == 9006:
            continue
        words = license_index.words_of((t or "").encode())
        places = [(l, k) for p, l in license_index.BASE for k in range(len(words)) if words[k : k + len(p.split())] == p.encode().split()]
        assert (out[i]["n_words"], out[i]["n_base"], out[i]["base_labels"]) == (len(words), len(places), ",".join(sorted({l for l, _ in places})))
        assert {*out[i]["base_labels"].split(","), ""} <= {*out[i]["labels"].split(","), ""} and 0 <= out[i]["score"] <= 1


# ---- 10 ----


def test_toxicity(spark):
    rng = np.random.default_rng(0)
    plain = [f"plain{i}" for i in range(300)]

    def text(n_bad):
        return " ".join([*rng.choice(plain, 60), *rng.choice(["idiot", "moron", "scum"], n_bad)])

    rows = [(i, text(0)) for i in range(300)] + [(300 + i, text(1 + i % 9)) for i in range(100)]
    labels = [(i, int(i >= 300)) for i in range(400) if i % 4] + [(5, None), (None, 1), (1, 0)]
    more = [(9001, None), (9002, ""), (9003, LONG), (9004, "You idiot, you moron, you scum"), (9004, "You idiot, you moron, you scum")]
    docs = documents(spark, rows + more)
    model = ordinal_toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert (np.diff(model.thresholds) > 0).all()
    out = {r["doc_id"]: r for r in ordinal_toxicity.score(docs.select("doc_id", "text"), model).collect()}
    assert sum(out[i]["rejected"] for i in range(300)) == 0 and sum(out[i]["rejected"] for i in range(300, 400)) >= 97
    assert not out[9001]["rejected"] and not out[9002]["rejected"] and not out[9003]["rejected"] and out[9004]["rejected"]
    mild, severe = ([out[i]["severity"] for i in range(300, 400) if (i - 300) % 9 == k] for k in (0, 8))
    assert np.mean(severe) > np.mean(mild)
    assert ordinal_toxicity.score(docs, model).count() == len(rows + more)


def test_one_class_rejects_nothing(spark):
    docs = documents(spark, [(1, "a"), (2, "b")])
    model = ordinal_toxicity.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert not any(r["rejected"] for r in ordinal_toxicity.score(docs, model).collect())


# ---- empty tables ----


def test_empty_tables(spark):
    docs = documents(spark, [])
    bench, labels, vectors = (spark.createDataFrame([], s) for s in ("item_id long, text string", "doc_id long, toxic int", "vec_id long, embedding array<float>"))
    assert langid.predict_languages(spark, docs).count() == 0
    assert suffix_dedup.remove_repeats(spark, docs).count() == 0
    assert secret_automata.scan(docs, secret_automata.train(docs)).count() == 0
    assert hilbert_packing.pack(spark, docs).count() == 0
    assert phrase_index.match(spark, docs, bench).count() == 0
    assert oph_minhash.near_duplicates(spark, docs).count() == 0
    assert nn_descent.near_duplicates(spark, vectors).count() == 0
    assert sentence_spans.remove_repeats(spark, docs).count() == 0
    assert license_index.scan_licenses(spark, docs).count() == 0
    assert ordinal_toxicity.toxicity(spark, docs, labels).count() == 0


def test_an_empty_benchmark_hits_nothing(spark, texts):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in phrase_index.match(spark, documents(spark, texts), bench).collect())
