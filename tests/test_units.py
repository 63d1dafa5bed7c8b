"""Known answers of single functions and invariants of merges and diffs."""

import datetime as dt

from pyspark.sql import functions as F

from padron.functions import clean, rules
from padron.operators import changes, extract, joins, listing
from padron.streaming import items, metrics

C = F.col


def values(spark, inputs, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in df.select("i", f(C("x")).alias("y")).orderBy("i").collect()]


def test_phones(spark):
    cases = ["5555555555", "52 555 555 5555", "+525555555555", "123", None]
    assert values(spark, cases, clean.normalize_phone_raw) == ["+525555555555"] * 3 + ["123", None]
    assert values(spark, ["052 555 555 5555", "tel 12"], clean.normalize_phone_v2) == ["+525555555555", "12"]


def test_text(spark):
    assert values(spark, ["  Centro Certificador  ", "a  b​c", "", None], clean.clean_text) == ["Centro Certificador", "a bc", "", None]
    assert values(spark, ["d.f.", "nuevo león", "ÁREA x1y", None], clean.title_case) == ["D.F.", "Nuevo León", "Área X1Y", None]
    assert values(spark, ["cdmx", "CDMX", "mexico", "NL", "Jalisco"], clean.normalize_state_name) == ["Ciudad de México", "Ciudad de México", "Estado de México", "Nuevo León", "Jalisco"]
    assert values(spark, ["En línea", "PRESENCIAL", "Híbrido", None], clean.modality_norm) == ["en_linea", "presencial", "mixto", None]
    assert values(spark, ["https://example.com/page/", "x"], clean.url_norm) == ["https://example.com/page", "x"]
    assert values(spark, ["é ‘q’"], clean.unicode_nfc) == ["é 'q'"]


def test_dates_and_numbers(spark):
    day = dt.date(2023, 1, 15)
    assert values(spark, ["2023-01-15", "15/01/2023", "15-01-2023", "15 de enero de 2023", "invalid date", "", None], clean.parse_date_raw) == [day] * 4 + [None] * 3
    assert values(spark, ["el 15/1/2023.", "x 2023-01-15 y", "15 de Enero de 2023", "2013", "no"], lambda c: clean.parse_date_iso(c, True)) == [day] * 3 + [dt.date(2013, 1, 1), None]
    assert values(spark, ["15 estándares", "Total: 100 items", "none", None], clean.first_number) == [15, 100, None, None]
    got = values(spark, ["19.4326,-99.1332", "19.4326, -99.1332", "invalid"], clean.latlong_parse)
    assert [g and (g["lat"], g["lon"]) for g in got] == [(19.4326, -99.1332)] * 2 + [None]
    assert values(spark, ["https://x/sector/1", "https://x/?a=2&id=5", "/invalid/url"], clean.id_from_url)[1:] == ["5", None]
    assert values(spark, ["https://x/sector/1"], lambda c: clean.id_from_url(c, "sector")) == ["1"]


def test_raw_rules(spark):
    df = spark.createDataFrame([("ec_standard", "INVALID", "", "invalid"), ("ec_standard", "EC0001.01", "t", "3"), (None, "x", "y", "1"), ("other", "x", "y", "1")], "type string, code string, title string, level string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("name", "contact_email", "rfc", "certificador_code", "ec_code", "duration")})
    errors = [r["errors"] for r in rules.raw_errors(df).collect()]
    assert {e["field"] for e in errors[0]} == {"code", "title", "level"} and errors[1] == []
    assert errors[2][0]["field"] == errors[3][0]["field"] == "type"


def test_state_code(spark):
    df = spark.createDataFrame([("Ciudad de México",), ("JALISCO",), ("Edo. Nuevo León",), ("Unknown",), ("",), (None,), ("cdmx",)], "estado string")
    got = {r["estado"]: r["estado_inegi"] for r in joins.state_code(df, "estado").collect()}
    assert got == {"Ciudad de México": "09", "JALISCO": "14", "Edo. Nuevo León": "19", "Unknown": None, "": None, None: None, "cdmx": "09"}


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "k string, titulo string, codes array<string>")


def test_compare_known_answers(spark):
    old = snapshot(spark, [("EC0217", "Old Title", ["a", "b"]), ("EC1", "x", None), (None, "lost", None)])
    new = snapshot(spark, [("EC0217", "New Title", ["b", "c"]), ("EC0435", "y", None), ("EC1", "x", None)])
    d = {r["k"]: r for r in changes.compare(old, new, "k", ["titulo"], lists="codes").collect()}
    assert {k: r["op"] for k, r in d.items()} == {"EC0217": "modified", "EC0435": "added", "EC1": "unchanged"}
    assert [tuple(c) for c in d["EC0217"]["changes"]] == [("titulo", "Old Title", "New Title")]
    assert (d["EC0217"]["list"]["added"], d["EC0217"]["list"]["removed"]) == (["c"], ["a"])
    assert {r["op"] for r in changes.compare(old, old, "k", ["titulo"]).collect()} == {"unchanged"}


def test_baseline(spark):
    cur, base = (spark.createDataFrame([(i,) for i in x], "id int") for x in ([1, 2], [1, 3]))
    assert {r["id"]: r["op"] for r in changes.diff_baseline(cur, base, "id").collect()} == {1: "unchanged", 2: "added", 3: "removed"}


def test_upsert_is_idempotent(spark):
    now, later = (F.lit(t).cast("timestamp") for t in ("2024-01-01", "2024-01-02"))
    empty = spark.createDataFrame([], "k string, a string, b string, first_seen timestamp, last_seen timestamp")
    one = joins.upsert(empty, spark.createDataFrame([("x", "1", "2")], "k string, a string, b string"), "k", ["a", "b"], now)
    batch = spark.createDataFrame([("x", None, "3"), ("y", "9", None)], "k string, a string, b string")
    two = joins.upsert(one, batch, "k", ["a", "b"], later)
    again = joins.upsert(two, batch, "k", ["a", "b"], later)
    assert sorted(map(tuple, two.collect())) == sorted(map(tuple, again.collect()))
    x = two.filter("k = 'x'").first()
    assert (x["a"], x["b"], x["first_seen"].day, x["last_seen"].day) == ("1", "3", 1, 2)


def test_errors_in_a_batch_are_left_out(spark):
    target = spark.createDataFrame([], "k string, a string, first_seen timestamp, last_seen timestamp")
    batch = spark.createDataFrame([("x", "1", ["bad"]), ("y", "2", [])], "k string, a string, validation_errors array<string>")
    assert [r["k"] for r in joins.upsert(target, batch, "k", ["a"], F.current_timestamp()).collect()] == ["y"]


def test_listing_item(spark):
    html = '<div class="estandar-item"><span class="ec-code">EC0001</span><h3 class="ec-title">T &amp; x</h3><span class="nivel">3</span></div><p>unclosed <a href="/n">next'
    pages = spark.createDataFrame([(1, "https://example.org", html), (2, "u", None), (3, "u", "")], "page_id long, url string, html string")
    cells = extract.html_cells(pages)
    got = extract.extract_v1_items(cells, "ec_standard").collect()
    assert [(r["code"], r["title"], r["level"]) for r in got] == [("EC0001", "T & x", "3")]
    assert cells.filter("kind = 'link'").first()["href"] == "/n"


def test_search_is_literal(spark):
    df = spark.createDataFrame([("50%",), ("500",)], "x string")
    assert [r["x"] for r in listing.multi_field_search(df, "0%", ["x"]).collect()] == ["50%"]


def test_date_range_refuses_a_reversed_one(spark):
    import pytest

    with pytest.raises(ValueError):
        listing.date_range_filter(spark.range(1), "id", "2024-01-02", "2024-01-01")


def test_stream_dedup_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([("a", "h1", dt.datetime(2024, 1, 1, 0, m)) for m in range(5)] + [("a", "h2", dt.datetime(2024, 1, 1, 1)), ("b", "h1", dt.datetime(2024, 1, 1, 2))], "type string, content_hash string, extracted_at timestamp")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = items.read_stream(spark, f"{tmp_path}/in", df.schema)
    items.write_all(items.dedup_ttl(stream), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out").select("type", "content_hash")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, items.dedup_ttl(df).select("type", "content_hash").collect()))


def test_circuit(spark, tmp_path):
    at = [(i, "e", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), st) for i, (s, st) in enumerate([(0, 500), (1, 500), (2, 500), (3, 200), (400, 500), (800, 200), (9000, 200)])]
    df = spark.createDataFrame(at, "event_id int, endpoint string, ts timestamp, status int")
    one = metrics.failure_streaks(df, 3).collect()
    assert [(r["failures"], r["opened"].second) for r in one] == [(3, 2)]
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    with metrics.state_store(spark):
        items.write_all(metrics.failure_streaks_stream(items.read_stream(spark, f"{tmp_path}/in", df.schema), 3), f"{tmp_path}/out", f"{tmp_path}/cp")
    states = [(r["state"], (r["at"] - dt.datetime(2024, 1, 1)).seconds) for r in spark.read.parquet(f"{tmp_path}/out").orderBy("at").collect()]
    assert states == [("open", 2), ("half-open", 302), ("open", 400), ("half-open", 700), ("closed", 800)]


def test_listings_of_odd_pages(spark):
    from padron.operators import extract

    card = '<div class="centro-card" data-centro-id="CE1"><div class="x"><h3 class="centro-name">Uno</h3></div></div>'
    pages = spark.createDataFrame([
        (1, "u?list=CERT_CENTROS&id=OC7", card + '<span class="municipio">outside</span>'),
        (2, "u", '<table class="table"><tr><td>head</td></tr><tr><td>Dos</td></tr></table>' + card),  # rows come before cards, an id may be missing
        (3, "u", '<div class="centro-card"><h3 class="centro-name">Tres'),  # never closed
        (4, "u", None), (5, "u", ""), (6, "u", "</div></table></div>"),
    ], "page_id long, url string, html string")
    got = extract.list_centro(extract.html_cells(pages)).select("page_id", "form", "centro_id", "nombre", "municipio", "cert_id").collect()
    assert sorted(map(tuple, got)) == [(1, "card", "CE1", "Uno", None, "OC7"), (2, "table", None, "Dos", None, None), (3, "card", None, "Tres", None, None)]
    assert extract.list_sector(extract.html_cells(pages)).count() == 0


def files_below(path):
    import os

    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_merge_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    from padron.sources.merge_table import MergeTable

    table = MergeTable(spark, f"file://{tmp_path}/t", "k", ["a", "b"], buckets=8)
    now = [F.lit(f"2024-01-0{d}").cast("timestamp") for d in range(1, 5)]
    batch = lambda rows: spark.createDataFrame(rows, "k string, a string, b string")
    assert table.rows() is None and table.merge(batch([]), now[0]) == 0 and table.versions() == []
    table.merge(batch([(f"k{i}", str(i), None) for i in range(100)]), now[0])
    first = files_below(f"{tmp_path}/t/data")
    assert table.merge(batch([("k7", None, "new")]), now[1]) == 1
    second = files_below(f"{tmp_path}/t/data")
    # the files of one bucket are new, all others are untouched, and the bucket's old version still stands for a replay
    assert len(second.keys() - first.keys()) == 1 and all(second[f] == t for f, t in first.items())
    got = {r["k"]: r for r in table.rows().collect()}
    assert len(got) == 100 and (got["k7"]["a"], got["k7"]["b"], got["k7"]["first_seen"].day, got["k7"]["last_seen"].day) == ("7", "new", 1, 2)
    # a batch that runs again writes the same version again
    before = sorted(map(tuple, table.rows().collect()))
    assert table.merge(batch([("k7", None, "new")]), now[1], version=1) == 1 and sorted(map(tuple, table.rows().collect())) == before
    assert [r["b"] for r in table.rows(["k7", "none"]).collect()] == ["new"]
    for d in (2, 3):
        table.merge(batch([("k7", None, f"v{d}")]), now[d])
    # no more than two versions of a bucket and two commits are left
    own = {f.split("bucket=")[1].split("/")[1] for f in files_below(f"{tmp_path}/t/data") if f"{f.split('bucket=')[1].split('/')[0]}" == next(iter(second.keys() - first.keys())).split("bucket=")[1].split("/")[0]}
    assert own == {"version=2", "version=3"} and table.versions() == [2, 3]
    assert {r["b"] for r in table.rows().filter("k = 'k7'").collect()} == {"v3"}


def test_merge_table_of_odd_rows(spark, tmp_path):
    from padron.sources.merge_table import MergeTable

    table = MergeTable(spark, f"file://{tmp_path}/t", "k", ["a"], buckets=4)
    rows = spark.createDataFrame([("x", "1", 1), ("x", "2", 1), ("", None, 1), ("long" * 5000, "3", 1)], "k string, a string, bucket int")
    table.merge(rows, F.lit("2024-01-01").cast("timestamp"))
    assert sorted(map(tuple, table.rows().select("k", "a").collect())) == sorted([("x", "2"), ("", None), ("long" * 5000, "3")])


RAW_ITEMS = "type string, code string, title string, name string, ec_code string, level string, duration string, certificador_code string, extracted_at timestamp"


def raw_items(spark, path, rows):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(*r, at + dt.timedelta(minutes=i)) for i, r in enumerate(rows)], RAW_ITEMS)
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("contact_email", "rfc", "url")})
    df.coalesce(1).write.mode("append").parquet(path)
    return df


def test_item_stream_sends_every_item_to_a_sink(spark, tmp_path):
    from padron.sources.merge_table import MergeTable

    src, out, cp = (f"file://{tmp_path}/{n}" for n in ("in", "out", "cp"))
    ec = ("ec_standard", "EC0001", "A title", None, None, "3", None, None)
    course = ("course", None, "Course", "Name", "EC0001", None, "20 horas", None)
    rows = [ec, ec, ("ec_standard", "EC1", "bad code", None, None, "x", None, None), course, (None, "EC0002", "untyped", None, None, None, None, None), ("other", "x", None, None, None, None, None, None),
            ("center", None, None, "no code", None, None, None, "OC001"), ("course", None, "Course", "Other", "EC9999", None, None, None), ("other", "x", None, None, None, None, None, None)]
    df = raw_items(spark, src, rows)
    run = lambda: items.item_stream(items.read_stream(spark, src, df.schema), out, cp)
    query = run()
    query.awaitTermination()
    report = items.flow_report(query)
    tables = lambda: (
        [tuple(r) for r in MergeTable(spark, f"{out}/ec_standard", "code", [], 16).rows().select("code", "title").orderBy("code").collect()],
        sorted(tuple(r) for r in spark.read.parquet(f"{out}/courses").select("name", "ec_code", "ec_ref").collect()),
        sorted((r["type"] or "", sorted(e["field"] for e in r["errors"])) for r in spark.read.parquet(f"{out}/rejects").collect()),
    )
    want = [("EC0001", "A title")], [("Name", "EC0001", "EC0001"), ("Other", "EC9999", None)], sorted([("ec_standard", ["code", "level"]), ("", ["type"]), ("other", ["type"]), ("other", ["type"]), ("center", ["code"])])
    assert tables() == want
    # 9 in: 1 merged, 2 appended, 5 rejected (equal ones each), 1 repeated
    assert report == {"rows": 9, "rejects": 5, "repeated": 1, "late": 0}
    assert {r["way"]: r["n"] for r in spark.read.parquet(f"{out}/outcomes").groupBy("way").agg(F.sum("n").alias("n")).collect()} == {"upsert": 1, "append": 2, "reject": 5}
    # the last batch runs again, as after a failure before it was committed: every sink is as it was
    import os

    for d in ("commits",):
        last = max(int(f) for f in os.listdir(f"{tmp_path}/cp/{d}") if f.isdigit())
        os.remove(f"{tmp_path}/cp/{d}/{last}")
        crc = f"{tmp_path}/cp/{d}/.{last}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    run().awaitTermination()
    assert tables() == want
    # a later batch changes the standard, repeats a course and fills no other sink
    raw_items(spark, src, [("ec_standard", "EC0001", "A new title", None, None, "3", None, None), course])
    run().awaitTermination()
    assert tables() == ([("EC0001", "A new title")], *want[1:])


def test_circuit_waits_for_the_watermark(spark, tmp_path):
    """Shuffled rows in several batches give what a plain replay in order of time gives."""
    import random

    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows, at = [], {g: 0 for g in "abc"}
    for i in range(240):
        g = rng.choice("abc")
        at[g] += rng.choice((1, 5, 60, 400))
        rows.append((i, g, start + dt.timedelta(seconds=at[g]), rng.choice((200, 500, 500, 503))))
    rows.append((999, "d", start + dt.timedelta(days=2), 200))  # moves the watermark past all others
    want = []
    for g in "abc":
        mode, failures, until = "closed", 0, None
        for _, _, t, status in sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0])):
            if mode == "open" and t >= until:
                mode = "half-open"
                want.append((g, until, mode))
            if mode == "open":
                continue
            if status < 400:
                if mode == "half-open":
                    want.append((g, t, "closed"))
                mode, failures = "closed", 0
                continue
            failures += 1
            if failures >= 3 or mode == "half-open":
                mode, failures, until = "open", 0, t + dt.timedelta(seconds=300)
                want.append((g, t, "open"))
        if mode == "open":
            want.append((g, until, "half-open"))  # without a further request
    late = rows.pop()
    rng.shuffle(rows)
    schema = "event_id int, endpoint string, ts timestamp, status int"
    for k in range(3):
        spark.createDataFrame(rows[k::3], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: items.write_all(metrics.failure_streaks_stream(items.read_stream(spark, f"{tmp_path}/in", schema, 1), 3, delay="1 day"), f"{tmp_path}/out", f"{tmp_path}/cp")
    with metrics.state_store(spark):
        run()
        spark.createDataFrame([late], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run()
    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted(want) and {s for _, _, s in want} == {"open", "half-open", "closed"}


def test_sliding_rate_and_streaks_equal_one_level(spark):
    """Cut into small slices, both give what one pass over each whole key gives."""
    from pyspark.sql import Window as W

    log = spark.range(600).select(F.col("id").alias("event_id"), (F.col("id") % 3).cast("string").alias("host"), F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(900))).alias("ts"), F.when(F.xxhash64("id") % 4 == 0, 200).otherwise(500).alias("status"))
    plain = log.withColumn("at", F.unix_micros("ts")).withColumn("n", F.count("*").over(W.partitionBy("host").orderBy("at").rangeBetween(-60_000_000, 0)))
    got = metrics.sliding_rate(log, 60, 3, slices=1)
    assert sorted(map(tuple, got.select("event_id", "n").collect())) == sorted(map(tuple, plain.select("event_id", "n").collect()))
    cut, whole = (sorted(map(tuple, metrics.failure_streaks(log, 4, "host", slice=n).collect())) for n in (20, 10**8))
    assert cut == whole and len(whole) > 20
    odd = spark.createDataFrame([(1, "h", None, 500), (2, None, dt.datetime(2024, 1, 1), 500)], "event_id int, host string, ts timestamp, status int")
    assert sorted((r["event_id"], r["n"]) for r in metrics.sliding_rate(odd, 60, 3).collect()) == [(1, 0), (2, 1)]
    assert metrics.failure_streaks(odd, 1, "host").count() == 0


def test_sketches_merge_within_their_error(spark):
    log = spark.range(20_000).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("host"), (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 1000).alias("duration"), F.lit(200).alias("status"))
    parts = metrics.latency_summaries(log)
    assert parts.count() > 60
    for q in (0.5, 0.95):
        v = metrics.merge_summaries(parts).select(metrics.sketch_quantile(q)).first()[0]
        share = log.filter(F.col("duration") <= v).count() / 20_000
        assert abs(share - q) < 0.02
        hist = metrics.merge_summaries(parts).select(metrics.bucket_quantile(q)).first()[0]
        assert hist == 10.0  # beyond the last bound
    few = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a", 0.3, 200), (dt.datetime(2024, 1, 1), "a", None, 500)], "ts timestamp, host string, duration double, status int")
    r = metrics.latency_summaries(few).first()
    assert (r["n"], r["bad"], r["total"], list(r["below"])) == (2, 1, 0.3, [0, 1, 1, 1, 1, 1])
    assert metrics.latency_summaries(few.limit(0)).count() == 0


def test_snapshots_of_many_moments_are_an_equi_join(spark):
    base = dt.datetime(2000, 1, 1)
    rows = [(i, base + dt.timedelta(hours=i), base + dt.timedelta(hours=i) + dt.timedelta(days=d)) for i in range(60) for d in (0, 1, 40, 700, 30_000)] + [(99, None, base), (98, base, None), (97, base + dt.timedelta(days=1), base)]
    df = spark.createDataFrame(rows, "k int, first_seen timestamp, last_seen timestamp")
    asked = [base + dt.timedelta(hours=7 * i) for i in range(1200)] + [base, None]
    out = joins.snapshots_at(df, spark.createDataFrame([(t,) for t in asked], "t timestamp"))
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = out.groupBy("t").count().collect()
    want = {}
    for t in asked:
        n = sum(1 for _, a, z in rows if t and a and z and a <= t <= z)
        if n:
            want[t] = want.get(t, 0) + n
    assert {r["t"]: r["count"] for r in got} == want


def test_gate_counts_while_writing(spark, tmp_path):
    df = spark.createDataFrame([("ec_standard", "EC0001", "t", "1"), ("ec_standard", "X", "t", "1"), (None, "x", "y", "1"), ("zzz", "x", "y", "1")], "type string, code string, title string, level string")
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("name", "contact_email", "rfc", "certificador_code", "ec_code", "duration")})
    checked = rules.raw_errors(df)
    report = {r["type"]: (r["total"], r["valid"]) for r in rules.written_with_report(checked, lambda d: d.write.parquet(f"{tmp_path}/x")).collect()}
    assert report == {"ec_standard": (2, 1), "(none)": (1, 0), "(other)": (1, 0), "(all)": (4, 1)}
    assert spark.read.parquet(f"{tmp_path}/x").count() == 4
    assert rules.quality_gate(rules.written_with_report(checked.filter("code = 'EC0001'"), lambda d: d.write.parquet(f"{tmp_path}/y"))).first()["passed"]


def test_details_of_odd_pages(spark):
    pages = spark.createDataFrame([
        (1, "https://x/ver", "<table><tr><td>Cédula:</td><td>ECE001</td><td>z</td></tr><tr><td><b>Nombre o razón social</b></td><td></td><td>Uno, A.C.</td></tr><tr><td>Estatus"),  # never closed
        (2, "https://x/ver/OC77", "<table><tr><td><table><tr><td>Nombre</td><td>Dos</td></tr></table></td><td>fuera</td></tr><tr><td>Siglas</td><td>D</td></tr></table>"),  # a table in a cell
        (3, "https://x/ver/OC78", "<p>Nombre</p>"), (4, "https://x/ver/OC79", None), (5, "", ""),
        (6, "https://x/ver", '<div class="nombre-legal">Tres</div><script>modalData = {"standards": [{"code": "EC0001"}, {"code": "bad"}, {}], "contacts": [{"a": "b"}]};</script><table><tr><td>Cédula</td><td>OC5</td></tr></table>'),
        (7, "https://x/ver/ECE9", '<h1 class="cert-title" id="t">Cuatro</h1><script>modalData = {broken};</script><div class="modal-estandares"><span class="ec-code">EC0002</span></div>'),
    ], "page_id long, url string, html string")
    got = {r["cert_id"]: (r["nombre_legal"], r["siglas"], r["estatus"], r["codes"], r["contactos"]) for r in extract.extract_cert(extract.html_cells(pages)).collect()}
    assert got == {
        "ECE001": ("Uno, A.C.", None, "ACTIVO", [], None), "OC77": ("Dos", "D", "ACTIVO", [], None),
        "OC5": ("Tres", None, "ACTIVO", ["EC0001"], [{"a": "b"}]), "ECE9": ("Cuatro", None, "ACTIVO", ["EC0002"], None),
    }
    ec = spark.createDataFrame([
        (1, "https://x/d", '<h1 class="ec-title">Título uno</h1><table><tr><td>Código</td><td>EC0001</td></tr></table>'),
        (2, "https://x/?ESLACT", '<div><span class="ec-code">EC0002</span></div><div class="f"><span class="ec-code">EC0003</span><span class="ec-title">Tres</span></div>'),
        (3, "https://x/d/EC0004", "<p>sin título</p>"),
    ], "page_id long, url string, html string")
    assert {(r["ec_clave"], r["titulo"], r["vigente"]) for r in extract.extract_ec(extract.html_cells(ec)).collect()} == {("EC0001", "Título uno", None), ("EC0003", "Tres", True)}
    for f in (extract.extract_ec, extract.extract_cert, extract.extract_centro, extract.extract_sector_comite):
        assert f(extract.html_cells(pages.limit(0))).count() == 0


def test_records_of_one_element_close_together(spark):
    cells = extract.cells_of('<div class="a"><div class="b">x</div>y</div><h1 class="t" id="i">z</h1><ul class="u"><li>1<ul><li>2</li></ul></li></ul><table><tr><td>o<div class="d">in</div></td></tr></table>')
    by = {(c[0], c[7]): c[5] for c in cells}
    assert (by["class", "a"], by["class", "b"], by["class", "t"], by["heading", "h1"]) == ("xy", "x", "z", "z")
    assert [(c[5], c[12]) for c in cells if c[0] == "item"] == [("2", ["ul.u", ""]), ("12", ["ul.u"])] or [c[5] for c in cells if c[0] == "item"] == ["2", "12"]
    assert [(c[5], c[13]) for c in cells if c[0] == "cell"] == [("oin", "o")]


def test_what_is_registered_runs_by_name(spark, tmp_path):
    import pytest

    from padron.sources import sinks

    def of_page(rows):
        assert [r["seq"] for r in rows] == sorted(r["seq"] for r in rows)
        yield rows[0]["page_id"], " ".join(r["text"] for r in rows if r["kind"] == "item")

    extract.register_extractor("lists", extract.page_extractor("page_id long, items string", of_page))
    pages = spark.createDataFrame([(1, "u", "<ul><li>a</li><li>b</li></ul>"), (2, "u", ""), (3, "u", "<p class='x'>t</p>")], "page_id long, url string, html string")
    cells = extract.html_cells(pages)
    out = extract.run_extractor("lists", cells)
    assert sorted(map(tuple, out.collect())) == [(1, "a b"), (3, "")]
    assert extract.run_extractor("lists", cells.limit(0)).count() == 0
    rules.register_rules("lists", lambda df: [rules.required("items")])
    assert {r["page_id"]: len(r["errors"]) for r in rules.checked(out, "lists").collect()} == {1: 0, 3: 1}
    for f in (lambda: extract.run_extractor("none", cells), lambda: rules.checked(out, "none")):
        with pytest.raises(ValueError):
            f()
    sinks.register_writer("lines", lambda df, path, entity: df.select("items").write.text(path))
    sinks.write_bundle({"lists": out}, f"file://{tmp_path}", ("lines", "parquet"))
    assert spark.read.text(f"file://{tmp_path}/lines/lists").count() == spark.read.parquet(f"file://{tmp_path}/parquet/lists").count() == 2


def test_word_index_reads_the_asked_words_alone(spark, tmp_path):
    from padron.operators.wordindex import WordIndex

    rows = [(f"k{i}", f"Común palabra{i % 50}") for i in range(500)] + [("n", None), (None, "palabra1"), ("e", ""), ("long", "x " * 9000 + "palabra7")]
    df = spark.createDataFrame(rows, "k string, t string")
    index = WordIndex(spark, f"file://{tmp_path}/i", 16)
    assert index.search("a").count() == 0
    index.add(df, "e", "k", ["t"], 0)
    for q in ("PALABRA7 nada", "comun", "palabrá1, palabra2!", "", "...", "x"):
        assert sorted(map(tuple, index.matches(df, "e", "k", ["t"], q).collect())) == sorted(r for r in map(tuple, listing.token_search(df, q, ["t"]).collect()) if r[0] is not None)
    found = index.postings("palabra7 palabra8")
    read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    assert len(read) <= 2 < 16
    best = index.search("comun palabra7", 3).collect()
    assert [(r["key"], r["words"]) for r in best] == [("k107", ["comun", "palabra7"]), ("k157", ["comun", "palabra7"]), ("k207", ["comun", "palabra7"])]
    # a batch that is added again replaces itself; a changed row is found by its new words alone
    changed = spark.createDataFrame([("k7", "otra")], "k string, t string")
    for _ in range(2):
        index.add(changed, "e", "k", ["t"], 1)
    now = df.filter("k is distinct from 'k7'").unionByName(changed)
    assert [r["k"] for r in index.matches(now, "e", "k", ["t"], "otra").collect()] == ["k7"]
    assert "k7" not in {r["k"] for r in index.matches(now, "e", "k", ["t"], "palabra7").collect()}
    assert index.postings("otra").count() == 1


def test_pages_after_the_last_row(spark):
    df = spark.createDataFrame([(a, b) for a in (1, 2, 3) for b in ("x", "y")], "a int, b string")
    seen, last = [], None
    while rows := [tuple(r) for r in listing.page_after(df, ["a", "b"], last, 4).collect()]:
        seen, last = seen + rows, rows[-1]
    assert seen == sorted(seen) and len(seen) == 6
