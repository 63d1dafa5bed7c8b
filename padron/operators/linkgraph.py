"""L: links between stored pages, page classes, reachability from a root and request endpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.sources.storage import shared_dir

_BINARY = r"(?i)\.(pdf|jpe?g|png|gif|zip|docx?|xlsx?)([?#]|$)"

# Page types by address, then by phrases of the text.
URL_TYPES = (("ec_standard", ("/ec/", "estandar")), ("certificador", ("certificador", "/ece", "/oc")), ("center", ("centro",)), ("course", ("curso",)))
TEXT_TYPES = (("ec_standard", "estándar de competencia"), ("certificador", "entidad de certificación"), ("center", "centro de evaluación"), ("course", "curso"))


def absolute(base: Column, href: Column) -> Column:
    """href seen from the page base: full addresses stay, //host, /path and relative ones are completed."""
    scheme, host = F.regexp_extract(base, r"^(https?):", 1), F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract(base, r"^(https?://[^/?#]+(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(href.rlike("^https?://"), href).when(href.startswith("//"), F.concat(scheme, F.lit(":"), href)).when(href.startswith("/"), F.concat(host, href))
        .when(href.rlike("^(#|mailto:|javascript:|tel:)") | (href == ""), F.lit(None)).otherwise(F.concat(folder, href))
    )


def extract_links(pages: DataFrame) -> DataFrame:
    hrefs = pages.select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r"""href=["'](.*?)["']"""), 1)).alias("href"))
    return hrefs.select("page_id", "url", absolute(F.col("url"), F.col("href")).alias("target")).filter("target is not null")


def in_scope(links: DataFrame, hosts: DataFrame, visited: DataFrame | None = None) -> DataFrame:
    """Links to allowed hosts(host) that are not files and were not visited. visited(target)."""
    host = F.regexp_extract("target", r"^https?://([^/?#]+)", 1)
    out = links.filter(~F.col("target").rlike(_BINARY)).withColumn("host", host).join(hosts.select("host"), "host", "left_semi").select(*links.columns)
    return out.join(visited.select("target"), "target", "left_anti") if visited is not None else out


def page_title(html: Column, default: str = "Sin título") -> Column:
    def inner(tag):
        t = F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)
        return F.nullif(F.trim(F.regexp_replace(t, r"<[^>]*>|\s+", " ")), F.lit(""))
    return F.coalesce(inner("title"), inner("h1"), F.lit(default))


def classify(url: Column, html: Column, urls=URL_TYPES, texts=TEXT_TYPES) -> Column:
    out = None
    low, body = F.lower(url), F.lower(html)
    for t, parts in urls:
        for p in parts:
            out = F.when(low.contains(p), t) if out is None else out.when(low.contains(p), t)
    for t, p in texts:
        out = out.when(body.contains(p), t)
    return out.otherwise("general")


def classify_simple(html: Column) -> Column:
    b = F.lower(html)
    return F.when(b.contains("estándar") | b.contains("estandar"), "ec_standard").when(b.contains("certificador"), "certificador").when(b.contains("centro"), "center").when(b.contains("curso"), "course").otherwise("unknown")


def _checkpoint(df: DataFrame) -> DataFrame:
    sc = df.sparkSession.sparkContext
    if not df.sparkSession.conf.get("spark.checkpoint.dir", None) and not getattr(sc, "_padron_checkpoints", False):
        sc.setCheckpointDir(shared_dir(df.sparkSession))
        sc._padron_checkpoints = True
    return df.checkpoint()


def bfs_depth(links: DataFrame, root, max_depth: int = 5) -> DataFrame:
    """(node, depth, parent): fewest steps from root along links(src, dst), and the smallest parent one step before.

    A frontier at a time; nodes reached already are left out and each round is checkpointed.
    """
    spark = links.sparkSession
    kind = links.schema["dst"].dataType
    edges = links.select("src", "dst").distinct()
    seen = spark.range(1).select(F.lit(root).cast(kind).alias("node"), F.lit(0).alias("depth"), F.lit(None).cast(kind).alias("parent"))
    frontier = seen
    for depth in range(1, max_depth + 1):
        step = frontier.select(F.col("node").alias("src")).join(edges, "src").groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))
        frontier = _checkpoint(step.join(seen.select("node"), "node", "left_anti").select("node", F.lit(depth).alias("depth"), "parent"))
        if frontier.isEmpty():
            break
        seen = _checkpoint(seen.unionByName(frontier))
    return seen


def crawl_map(pages: DataFrame, depths: DataFrame, status: DataFrame | None = None, **rules) -> DataFrame:
    """One row of each address: hashes, title, type, depth and parent (null if not reached), and the status of
    its fetch from status(page_id, status). rules are those of classify."""
    one = pages.groupBy("url").agg(F.min_by(F.struct("page_id", "html"), "page_id").alias("p")).select("url", "p.*")
    out = one.select("page_id", "url", F.md5("url").alias("url_hash"), F.md5("html").alias("content_hash"), page_title(F.col("html")).alias("title"), classify(F.col("url"), F.col("html"), **rules).alias("type"), F.length("html").alias("content_length"))
    out = out.join(depths.withColumnRenamed("node", "page_id"), "page_id", "left")
    return out.join(status, "page_id", "left") if status is not None else out


def degrees(links: DataFrame) -> DataFrame:
    out, into = links.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("n_out")), links.groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n_in"))
    return out.join(into, "node", "full").select("node", F.coalesce("n_out", F.lit(0)).alias("n_out"), F.coalesce("n_in", F.lit(0)).alias("n_in"))


def page_signals(pages: DataFrame, terms=("estándar", "certificación", "competencia")) -> DataFrame:
    low = F.lower("html")
    topic = F.array_join(F.array_compact(F.array(*[F.when(low.contains(t), t) for t in terms])), ",")
    return pages.select("page_id", low.contains("<form").alias("has_form"), low.contains("<script").alias("has_script"), low.rlike("ajax|xmlhttprequest|fetch\\(").alias("has_ajax"), topic.alias("topics"))


# Marks of a link to the next page, in order of preference.
NEXT = ("siguiente", "next", "»", ">", "›")


def next_page(cells: DataFrame) -> DataFrame:
    """The page's link to the next one: the first mark that any link bears."""
    rank = None
    for i, mark in enumerate(NEXT):
        hit = F.lower("text") == mark
        rank = F.when(hit, i) if rank is None else rank.when(hit, i)
    found = cells.filter("kind = 'link'").withColumn("rank", rank).filter("rank is not null")
    return found.groupBy("page_id", "url").agg(F.min_by("href", F.struct("rank", "href")).alias("href")).select("page_id", "url", absolute(F.col("url"), F.col("href")).alias("target"))


def endpoint_registry(log: DataFrame) -> DataFrame:
    return log.filter(F.col("path").contains("/api/")).select("method", F.col("path").alias("url")).distinct()
