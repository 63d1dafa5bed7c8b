"""One small test for each finding of the third review."""

import random
import re
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from padron import plans
from padron.operators import extract, joins, listing
from padron.streaming import metrics

QUERIES, ORACLES = plans.load()
SF = "/root/testdata/sf0.001"


def parses(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("MapInArrow") + plan.count("MapInPandas")


def test_details_parse_each_page_once(spark):
    pages = spark.createDataFrame([(1, "https://x/ver/OC1", "<p>x</p>")], "page_id long, url string, html string")
    for f in (extract.extract_ec, extract.extract_cert, extract.extract_centro, extract.extract_sector_comite):
        assert parses(f(extract.html_cells(pages))) == 1
    assert parses(QUERIES["L10_next_page_edges"](spark, SF)) == 1


def test_state_code_computes_its_input_once(spark):
    df = spark.range(1).select(F.lit("jalisco").alias("estado"))
    assert joins.state_code(df, "estado")._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_pages_of_one_file_are_dealt_to_tasks(spark):
    pages = spark.range(200).coalesce(1).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit('<p class="a">x</p>').alias("html"))
    cells = extract.html_cells(pages)
    assert cells.select(F.spark_partition_id()).distinct().count() > 1 and cells.count() == 200


def test_plain_markup_gives_the_parsers_cells():
    def parsed(html):
        p = extract._Cells()
        p.feed(html)
        p.close()
        for _, rec, _ in reversed(p.open):
            p._close(rec)
        extract._labels(p.out)
        return [tuple(r) for r in p.out]

    rng, bits = random.Random(1), ['<table>', "</table>", "<tr>", "</tr>", "<td>", "</td>", '<div class="a">', "</div>", "<p>", '<span class="ec-code">', "</span>", "EC0001", "&amp;", "&am", "x & y", "<title>", "</title>", "<script>", "</script>", '<a href="/x?a=1&y=2">', '<a href="?a&copy=2">', "</a>", "Nombre", "Estado:", "<", ">", "<!-- c -->", "<li>", "</li>", "<textarea>", "</textarea>"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 20))) for _ in range(3000)]
    assert sum(extract._plain(h) is not None for h in pages) > 300
    for h in pages:
        assert extract.cells_of(h) == parsed(h)


def test_equal_codes_are_listed_by_id(spark):
    rows = [(i, "ec_standard", "EC0001", f"the {i}", "valid") for i in random.Random(2).sample(range(200), 200)]
    items = spark.createDataFrame(rows, "item_id long, type string, code string, title string, status string").repartition(7)
    got = listing.item_explorer(items, type="ec_standard", status="valid", q="the", number=2, per_page=20)
    assert [r["title"] for r in got.collect()] == [f"the {i}" for i in range(20, 40)] and got.columns == ["type", "code", "title", "status"]


def test_headings_with_references_match_sql(spark, tmp_path):
    html = ["<h1>a &quot;b&quot; &amp;amp; c&amp;</h1>", "<h1>x &amp</h1>", "<h1>1 &lt; 2 &#39;q&#x27; &am</h1>", "<h1>plain</h1>"]
    spark.createDataFrame([(i, "u", h) for i, h in enumerate(html)], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.sql(ORACLES["K_registered_extractor"]).fetchall())
    assert sorted(map(tuple, QUERIES["K_registered_extractor"](spark, str(tmp_path)).collect())) == want
    assert [w[2] for w in want] == ['a "b" &amp; c&', "x &", "1 < 2 'q' &am", "plain"]


def test_quantile_of_the_values_themselves(spark):
    assert "exact" in QUERIES["E22_latency_quantile"](spark, SF).columns
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1.0, rng.random() * 100, rng.random()])) for _ in range(4000)] + [("one", 5.0), ("none", None)] + [("same", 2.0)] * 50
    df = spark.createDataFrame(rows, "host string, duration double")
    con = duckdb.connect()
    pdf = df.toPandas()  # noqa: F841
    for q in (0.0, 0.5, 0.95, 1.0):
        want = {k: round(v, 9) for k, v in con.sql(f"select host, quantile_cont(duration, {q}) from pdf where not isnan(duration) and duration is not null group by host").fetchall()}
        assert {r["host"]: round(r["exact"], 9) for r in metrics.exact_quantile(df, q).collect()} == want


def test_committees_pages_are_bounded(spark, tmp_path):
    for t in ("part", "nation", "region"):
        shutil.copy(f"{SF}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    one = spark.read.parquet(f"{SF}/part.parquet").limit(1).drop("p_partkey")
    many = spark.range(1, 20_001).select((F.col("id") * 25).alias("p_partkey")).crossJoin(one)
    many.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/part.parquet")
    seen, html_cells = [], extract.html_cells
    extract.html_cells = lambda pages: seen.append(pages) or html_cells(pages)
    try:
        QUERIES["K8_sector_edges"](spark, str(tmp_path))
    finally:
        extract.html_cells = html_cells
    assert seen[0].agg(F.max(F.length("html"))).first()[0] < 20_000


def test_versions_of_one_time_meet_the_moments_once(spark, monkeypatch):
    seen, snapshots_at = [], joins.snapshots_at
    monkeypatch.setattr(joins, "snapshots_at", lambda df, moments: seen.append(df) or snapshots_at(df, moments))
    QUERIES["D16_snapshots_at"](spark, SF)
    assert seen[0].count() == seen[0].select("first_seen", "last_seen").distinct().count()


def test_circuit_sets_one_timer_for_all_that_waits():
    pd = pytest.importorskip("pandas")
    timers, kept = [], []

    class Handle:
        registerTimer = staticmethod(timers.append)

    circuit = metrics.Circuit("endpoint", 3, 300)
    circuit.handle, circuit.waiting = Handle, type("Waiting", (), {"appendList": staticmethod(kept.extend)})
    rows = pd.DataFrame({"at_us": [5_000_000 - 1000 * i for i in range(1000)], "known": 1, "id": range(1000), "good": 0})
    list(circuit.handleInputRows(("a",), iter([rows]), None))
    assert timers == [4001] and len(kept) == 1


def test_edges_from_lists_keep_no_table_of_edges(spark):
    rows = [("a", ["x", "y", "x"], "d1"), ("a", ["y", None], "d1"), ("a", ["x"], "d2"), (None, ["x"], None), ("b", None, "d1")]
    df = spark.createDataFrame(rows, "cert_id string, codes array<string>, since string")
    for since in (None, "since"):
        out = extract.edges_from_lists(df, "cert_id", "codes", "R1", since)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Aggregate")  # unfolded last
        want = {(i, *([s] if since else []), c, "R1") for i, codes, s in rows for c in codes or ()}
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))


def test_bundle_shapes_are_compressed(spark, tmp_path):
    from padron.sources import sinks

    df = spark.range(1000).select(F.lit("cert_OC001").alias("source"), F.lit("ec_EC0001").alias("target"), "id")
    sinks.write_bundle({}, str(tmp_path), shapes={"graph/edges": df})
    assert list((tmp_path / "graph/edges").glob("*.json.gz"))
    assert spark.read.json(f"{tmp_path}/graph/edges").distinct().count() == 1000


def test_accreditations_are_grouped_by_many_tasks(spark):
    """The view and both queries deal rows by key themselves: Spark merges no partitions before they are grouped."""
    for name, least in (("E28_sector_flow", 2), ("D17_cert_by_state_docs", 3)):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") >= least
        # the view's rows are dealt before they are grouped: no grouping of a whole split
        scan = plan[: plan.index("lineitem")] if "lineitem" in plan else plan
        assert scan.rindex("REPARTITION_BY_NUM") > scan.rindex("HashAggregate")


def test_cert_state_standards_counts_rows_and_different_standards(spark):
    cert = spark.createDataFrame([("a", "X", "ECE", "Vigente"), ("b", "X", "ECE", "Vigente"), ("c", "X", "OC", "Vigente"), ("d", None, "OC", "Vigente"), ("e", "Y", "OC", "Cancelado")], "cert_id string, estado string, tipo string, estatus string")
    edges = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("d", "1"), ("d", "1"), ("e", "9")], "cert_id string, ec_clave string")
    assert set(map(tuple, joins.cert_state_standards(cert, edges).collect())) == {("X", "ECE", 3, 2), ("X", "OC", 1, 0), (None, "OC", 2, 1)}


def test_listings_parse_each_page_once(spark):
    for name in ("K4_list_centro", "K3_list_cert"):
        assert parses(QUERIES[name](spark, SF)) == 1
    html = [
        '<table class="x table"><tr><td>no</td></tr><tr data-id="D1"><td>A</td><td>B</td></tr><tr><td>C</td><td><a href="?id=L1">y</a></td></tr></table><table><tr><td>n</td></tr><tr><td>z</td></tr></table><div class="centro-card"><a href="?id=K">k</a></div>',
        '<div class="big centro-card" data-id="D2"><h3 class="centro-name">N</h3><div class="in"><span class="estado">E</span><a href="?CENTRO&id=L2">v</a></div></div>',
        '<p><a href="?CENTRO&id=L3">P</a><a href="?CENTRO&id=L3">Q</a><a href="?id=L4">R</a><a href="?CENTRO">S</a></p>',
        "<p>none</p>", None,
    ]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string").select("page_id", F.lit("u").alias("url"), "html")
    out = extract.list_centro(extract.html_cells(pages)).select("page_id", "form", "centro_id", "nombre", "cert_nombre", "estado")
    assert parses(out) == 1
    assert sorted(map(tuple, out.collect()), key=str) == [(0, "table", "D1", "A", "B", None), (0, "table", "L1", "C", "y", None), (1, "card", "D2", "N", None, "E"), (2, "link", "L3", "P", None, None), (2, "link", "L3", "Q", None, None)]


def test_older_items_parse_each_page_once(spark):
    for name in ("K9_extract_v1_items", "K9_v1_certificador", "K9_v1_center", "K9_v1_course"):
        assert parses(QUERIES[name](spark, SF)) == 1


def test_extractors_give_methods_that_the_jvm_compiles(spark, capsys):
    pages = spark.createDataFrame([(1, "https://x/ver/OC1", "<p>x</p>")], "page_id long, url string, html string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan tells no code
    try:
        for f in (extract.extract_ec, extract.extract_cert, extract.extract_centro, extract.extract_sector_comite):
            f(extract.html_cells(pages)).explain("codegen")
            sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
