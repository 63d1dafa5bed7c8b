"""Queries of M: streams run over the given tables to their end, and their batch counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from padron.plans.catalog import query
from padron.plans.cleaning import RAW
from padron.sources.merge_table import MergeTable
from padron.sources.storage import scratch
from padron.streaming import items, metrics

C = F.col


def _stored_items(r):
    """Raw items as files for a stream, every third one twice, with an event time that grows with the id."""
    path = scratch(r.spark, "items-in")
    at = F.timestamp_seconds(F.lit(1704067200) + C("item_id") % 3600)
    df = r.items.select("item_id", "type", "code", "title", "name", "contact_email", "contact_phone", "state", "certificador_code", "ec_code", "level", "duration", "modality", "rfc", "url", "address", at.alias("extracted_at"))
    again = df.filter("item_id % 3 = 0").withColumn("extracted_at", C("extracted_at") + F.expr("interval 10 minutes"))
    df = df.unionByName(again).drop("item_id")
    df.write.parquet(path)
    return path, df.schema


def _log(r):
    path = scratch(r.spark, "log-in")
    df = r.request_log.withColumn("ts", C("ts").cast("timestamp")).select("event_id", "ts", "user_id", "host", "path", "component", "status", "duration", F.array_join(F.slice(F.filter(F.split("path", "/"), lambda p: p != ""), 1, 3), "/").alias("endpoint"))
    df.write.parquet(path)
    return path, df.schema


_BAD = " or ".join(f"(type = '{k}' and ({' or '.join(c for _, c in v)}))" for k, v in RAW.items())
# repeats are of content; a reject is nobody's repeat
_FLOW = f"""(select *, case when type is null or coalesce({_BAD}, false) then 'rejected' when type = 'course' then 'appended' when code is null then 'rejected' else 'upserted' end as outcome,
    concat_ws('|', type, upper(trim(code)), trim(name), trim(title), upper(trim(ec_code)), rfc) as content from (select * from items union all select * from items where item_id % 3 = 0))"""
_COUNTED = f"select outcome, type, case when outcome = 'rejected' then count(*) else count(distinct content) end as n, count(*) as seen from {_FLOW} group by outcome, type"


@query("M1_item_stream", f"select outcome, type, cast(n as bigint) as n from ({_COUNTED}) union all select 'repeated', null, cast(sum(seen - n) as bigint) from ({_COUNTED}) union all select 'in', null, (select count(*) from items) + (select count(*) from items where item_id % 3 = 0)")
def m1(r):
    # what came in is what was merged, appended, rejected or repeated
    src, schema = _stored_items(r)
    out, cp = scratch(r.spark, "items-out"), scratch(r.spark, "cp")
    flow = items.item_stream(items.read_stream(r.spark, src, schema, 4), out, cp)
    flow.awaitTermination()
    seen = items.flow_report(flow)
    ways = r.spark.read.parquet(f"{out}/outcomes").groupBy(F.element_at(F.create_map(*map(F.lit, ("upsert", "upserted", "append", "appended", "reject", "rejected"))), C("way")).alias("outcome"), "type").agg(F.sum("n").alias("n"))
    rest = r.spark.createDataFrame([("repeated", None, seen["repeated"]), ("in", None, seen["rows"])], "outcome string, type string, n long")
    return ways.unionByName(rest)


_KEPT = f"(select distinct type, upper(trim(code)) as code, upper(trim(ec_code)) as ec_code, content, outcome from {_FLOW} where outcome <> 'rejected')"
_KNOWN = f"(select code from {_KEPT} where type = 'ec_standard')"


@query("M1_item_tables", f"select type, code, cast(null as string) as ec_ref, count(distinct code) as n from {_KEPT} where outcome = 'upserted' group by type, code union all select 'course', ec_code, case when ec_code in {_KNOWN} then ec_code end, count(*) from {_KEPT} where outcome = 'appended' group by ec_code")
def m1b(r):
    # all in one batch, so that each course finds its standard
    src, schema = _stored_items(r)
    out, cp = scratch(r.spark, "items-out"), scratch(r.spark, "cp")
    items.item_stream(items.read_stream(r.spark, src, schema), out, cp).awaitTermination()
    merged = None
    for kind in items.UPSERTED:
        one = MergeTable(r.spark, f"{out}/{kind}", "code", [], 16).rows()
        if one is not None:
            one = one.select(F.lit(kind).alias("type"), "code", F.lit(None).cast("string").alias("ec_ref"), F.lit(1).cast("long").alias("n"))
            merged = one if merged is None else merged.unionByName(one)
    courses = r.spark.read.parquet(f"{out}/courses").groupBy(C("ec_code").alias("code"), "ec_ref").agg(F.count("*").alias("n")).withColumn("type", F.lit("course"))
    return courses if merged is None else merged.unionByName(courses)


# as many keys as a third of the ids, so that a table's buckets fill
_KEY = "cast(floor(doc_id / 3) as bigint)"


@query("M2_dedup_ttl", f"select distinct {_KEY} as k, lang from documents")
def m2(r):
    src = scratch(r.spark, "dedup-in")
    df = r.documents.select(F.expr(_KEY).alias("k"), "lang", F.timestamp_seconds(F.lit(1704067200) + C("doc_id") % 3600).alias("extracted_at"))
    df.write.parquet(src)
    out = scratch(r.spark, "dedup-out")
    stream = items.read_stream(r.spark, src, df.schema)
    items.write_all(items.dedup_ttl(stream, "24 hours", keys=("k", "lang")), out, scratch(r.spark, "cp"))
    return r.spark.read.parquet(out).select("k", "lang")


@query("M2_dedup_batch", f"select k, lang, min(item_id) as item_id from (select doc_id as item_id, {_KEY} as k, lang from documents) group by k, lang")
def m2b(r):
    df = r.documents.select(C("doc_id").alias("item_id"), F.expr(_KEY).alias("k"), "lang", F.timestamp_seconds("doc_id").alias("extracted_at"))
    return items.dedup_ttl(df, keys=("k", "lang")).select("k", "lang", "item_id")


@query("M3_stream_upsert", f"select k, lang, last_seen from (select {_KEY} as k, max_by(lang, doc_id) as lang, cast(max(doc_id) as bigint) as last_seen from documents group by 1)")
def m3(r):
    src = scratch(r.spark, "upsert-in")
    df = r.documents.select(F.expr(_KEY).alias("k"), "lang", C("doc_id").alias("extracted_at"))
    out, cp = scratch(r.spark, "upsert-out"), scratch(r.spark, "cp")
    # two batches, of which the later has the larger ids; keys of the middle are in both
    middle = df.agg(F.expr("percentile_approx(extracted_at, 0.5)")).first()[0] or 0
    for half in (C("extracted_at") <= middle, C("extracted_at") > middle):
        df.filter(half).write.mode("append").parquet(src)
        items.stream_upsert(items.read_stream(r.spark, src, df.schema), out, "k", ["lang", "extracted_at"], cp, buckets=16).awaitTermination()
    return MergeTable(r.spark, out, "k", ["lang", "extracted_at"], 16).rows().select("k", "lang", C("extracted_at").alias("last_seen"))


@query("M4_late_items", "select event_id, ts < (select max(ts) from events) - interval 24 hours and event_id % 10 <> 0 as late from events")
def m4(r):
    df = r.events.select("event_id", C("ts").cast("timestamp").alias("extracted_at"), F.when(C("event_id") % 10 != 0, F.md5("props")).alias("content_hash"))
    ok, late = items.split_late(df, df.agg(F.max("extracted_at")).first()[0], "24 hours")
    return ok.select("event_id", F.lit(False).alias("late")).unionByName(late.select("event_id", F.lit(True).alias("late")))


# Spark's watermark has milliseconds, and a row on it is late
_MARK = "(select date_trunc('milliseconds', max(ts)) from events where event_id % 3 <> 0 and event_id % 10 <> 0) - interval 24 hours"


@query("M4_late_items_stream", f"select event_id, event_id % 3 = 0 and event_id % 10 <> 0 and ts <= {_MARK} as late, true as reconciled from events")
def m4b(r):
    src, out, cp = (scratch(r.spark, n) for n in ("late-in", "late-out", "cp"))
    df = r.events.select("event_id", C("ts").cast("timestamp").alias("extracted_at"), F.when(C("event_id") % 10 != 0, F.md5("props")).alias("content_hash"))
    dropped = 0
    # a third of the rows comes after the others
    for part in ("event_id % 3 <> 0", "event_id % 3 = 0"):
        df.filter(part).write.mode("append").parquet(src)
        dropped += items.dropped_late(items.write_all(items.in_time_stream(items.read_stream(r.spark, src, df.schema), "event_id"), out, cp))
    in_time = r.spark.read.parquet(out)
    late = items.late_rows(df, in_time, "event_id")
    both = in_time.select("event_id", F.lit(False).alias("late")).unionByName(late.select("event_id", F.lit(True).alias("late")))
    # what the side table has is what Spark has counted as dropped
    return both.crossJoin(F.broadcast(late.agg((F.count("*") == dropped).alias("reconciled"))))  # one row


_SPANS = " union all ".join(f"select '1 {u}' as span, strftime(date_trunc('{u}', ts), '%Y-%m-%d %H:%M') as start, user_id, path, case when user_id % 3 = 0 then 'key' else 'public' end as caller, count(*) as n, count(*) > case when user_id % 3 = 0 then {k} else {p} end as over from request_log where date_trunc('{u}', ts) + interval 1 {u} <= (select date_trunc('milliseconds', max(ts)) - interval 10 minutes from request_log) group by 1, 2, 3, 4, 5" for u, p, k in (("minute", 20, 60), ("hour", 100, 1000)))


@query("M5_tumbling_rate", _SPANS)
def m5(r):
    # windows that the watermark has closed; minute and hour are streams of their own
    src, schema = _log(r)
    out = None
    for i, span in enumerate(("1 minute", "1 hour")):
        log = items.read_stream(r.spark, src, schema).withColumn("caller", F.when(C("user_id") % 3 == 0, "key").otherwise("public"))
        path = scratch(r.spark, "rate-out")
        items.write_all(metrics.tumbling_rate(log, span, {k: n[i] for k, n in metrics.CALLER_LIMITS.items()}, ("user_id", "path"), delay="10 minutes"), path, scratch(r.spark, "cp"))
        one = r.spark.read.parquet(path).withColumn("span", F.lit(span))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


@query("M5_caller_rates", _SPANS.replace("where date_trunc('minute', ts) + interval 1 minute <= (select date_trunc('milliseconds', max(ts)) - interval 10 minutes from request_log)", "").replace("where date_trunc('hour', ts) + interval 1 hour <= (select date_trunc('milliseconds', max(ts)) - interval 10 minutes from request_log)", ""))
def m5b(r):
    log = r.request_log.withColumn("ts", C("ts").cast("timestamp")).withColumn("caller", F.when(C("user_id") % 3 == 0, "key").otherwise("public"))
    return metrics.caller_rates(log).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


_CLASS = "case when path like '%/api/%' then 'api' else 'web' end"


@query("M6_sliding_rate", f"select event_id, n, n > case kind when 'api' then 300 else 120 end as over from (select event_id, {_CLASS} as kind, count(*) over (partition by host, {_CLASS} order by ts range between interval 60 seconds preceding and current row) as n from request_log)")
def m6(r):
    return metrics.sliding_rate(r.request_log.withColumn("kind", metrics.host_class(C("path"))), 60, metrics.HOST_LIMITS).select("event_id", "n", "over")


@query("M6_sliding_rate_hour", "select event_id, count(*) over (partition by host order by ts range between interval 3600 seconds preceding and current row) as n from request_log")
def m6c(r):
    # long windows over few slices: most rows have others of their window in the slice before
    return metrics.sliding_rate(r.request_log, 3600, 3, slices=2).select("event_id", "n")


@query("M6_sliding_rate_stream", f"select host, kind, strftime(start, '%Y-%m-%d %H:%M:%S') as start, count(*) as n, count(*) > case kind when 'api' then 2 else 1 end as over from (select host, {_CLASS} as kind, time_bucket(interval 5 seconds, ts) - k * interval 5 seconds as start from request_log cross join range(12) g(k)) where start + interval 60 seconds <= (select max(ts) - interval 60 seconds from request_log) group by 1, 2, 3")
def m6b(r):
    # windows that the watermark has closed
    src, schema = _log(r)
    out = scratch(r.spark, "sliding-out")
    log = items.read_stream(r.spark, src, schema).withColumn("kind", metrics.host_class(C("path")))
    items.write_all(metrics.sliding_rate_stream(log, {"web": 1, "api": 2}), out, scratch(r.spark, "cp"))
    return r.spark.read.parquet(out).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


_RUNS = "(select *, sum(case when status < 400 then 1 else 0 end) over (partition by host, split_part(path, '/', 2), split_part(path, '/', 3), split_part(path, '/', 4) order by ts, event_id rows unbounded preceding) as run, concat_ws('/', host, split_part(path, '/', 2), split_part(path, '/', 3), split_part(path, '/', 4)) as endpoint from request_log)"


@query("M7_failure_streaks", f"select endpoint, count(*) as failures, min(event_id) as first_id from {_RUNS} where status >= 400 group by endpoint, run having count(*) >= 3")
def m7(r):
    log = r.request_log.withColumn("endpoint", metrics.endpoint_group(C("host"), C("path")))
    out = metrics.failure_streaks(log, 3)
    ids = log.groupBy("endpoint", C("ts").alias("first")).agg(F.min("event_id").alias("event_id"))
    return out.join(ids, ["endpoint", "first"]).select("endpoint", "failures", C("event_id").alias("first_id"))


_ENDPOINT = "concat_ws('/', host, split_part(path, '/', 2), split_part(path, '/', 3), split_part(path, '/', 4))"
_CIRCUITS = f"""with recursive mark as (select epoch_us(date_trunc('milliseconds', max(ts))) - 600000000 as mark from request_log),
e as (select {_ENDPOINT} as endpoint, epoch_us(ts) as us, status, row_number() over (partition by {_ENDPOINT} order by ts, event_id) as i from request_log, mark where epoch_us(ts) <= mark),
c(endpoint, i, mode, failures, until, half, changed, state) as (select distinct endpoint, cast(0 as bigint), 'closed', 0, cast(0 as bigint), cast(null as bigint), cast(null as bigint), cast(null as string) from e
    union all select endpoint, i, case when passed = 'open' then 'open' when status < 400 then 'closed' when opens then 'open' else passed end, case when passed = 'open' or status < 400 or opens then 0 else failures + 1 end,
        case when opens then us + 300000000 else until end, case when mode = 'open' and passed = 'half-open' then until end, case when opens or (status < 400 and passed = 'half-open') then us end,
        case when opens then 'open' when status < 400 and passed = 'half-open' then 'closed' end
    from (select *, status >= 400 and passed <> 'open' and (failures + 1 >= 3 or passed = 'half-open') as opens from (
        select e.endpoint, e.i, e.us, e.status, c.mode, c.failures, c.until, case when c.mode = 'open' and e.us >= c.until then 'half-open' else c.mode end as passed from c join e on e.endpoint = c.endpoint and e.i = c.i + 1))),
last as (select endpoint, arg_max(mode, i) as mode, arg_max(until, i) as until from c group by endpoint)
select endpoint, us, state from (select endpoint, half as us, 'half-open' as state from c where half is not null union all select endpoint, changed, state from c where state is not null
    union all select endpoint, until, 'half-open' from last, mark where mode = 'open' and until <= mark)"""


@query("M7_failure_streaks_stream", _CIRCUITS)
def m7b(r):
    # rows arrive shuffled, in several files and batches of equal spread over time
    src, out = scratch(r.spark, "log-in"), scratch(r.spark, "circuit-out")
    log = r.request_log.select("event_id", C("ts").cast("timestamp").alias("ts"), metrics.endpoint_group(C("host"), C("path")).alias("endpoint"), "status")
    log.repartition(4, F.xxhash64("event_id")).write.parquet(src)
    with metrics.state_store(r.spark):
        items.write_all(metrics.failure_streaks_stream(items.read_stream(r.spark, src, log.schema), 3), out, scratch(r.spark, "cp"))
    return r.spark.read.parquet(out).select("endpoint", F.unix_micros("at").alias("us"), "state")


@query("M8_counter_rate", "select component, strftime(s, '%Y-%m-%d %H:%M') as start, round(count(*) / cast(300 as double), 6) as rate from (select component, unnest(range(date_trunc('minute', ts) - interval 4 minutes, date_trunc('minute', ts) + interval 30 seconds, interval 1 minute)) as s from request_log) group by 1, 2")
def m8(r):
    return metrics.counter_rate(r.request_log.withColumn("ts", C("ts").cast("timestamp"))).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm"))


_EDGES = (0.5, 1.0, 5.0, 10.0, 50.0, 100.0, 500.0)


def _read(edges):
    """The 95th percentile of a histogram le0 ... with n rows, in SQL."""
    aim, out = "cast(n as double) * 0.95", ""
    for i, e in enumerate(edges):
        low, under = (edges[i - 1], f"le{i - 1}") if i else (0.0, "0")
        out += f" when le{i} >= {aim} then {low} + {e - low} * coalesce(({aim} - {under}) / nullif(le{i} - {under}, 0), 0)"
    return f"case{out} else {edges[-1]} end"


_DAY = "select date_trunc('day', ts) as s, count(*) as n, count(*) filter (status >= 400) as bad, " + ", ".join(f"count(*) filter (duration <= {e}) as le{i}" for i, e in enumerate(_EDGES)) + " from request_log group by 1"
_MEASURES = f"""(select coalesce(a.s, b.s) as s, bad / cast(n as double) as error_ratio, cast({_read(_EDGES)} as double) as p95_seconds, cast(bad as double) as failures, b.duration from ({_DAY}) a
    full join (select date_trunc('day', start_time) as s, max((epoch_us(end_time) - epoch_us(start_time)) / cast(1e6 as double)) as duration from runs group by 1) b on a.s = b.s)"""


@query("M9_alert_rules", f"select strftime(s, '%Y-%m-%d') as start, alert, round(value, 4) as value from (" + " union all ".join(f"select s, '{n}' as alert, {n} as value from {_MEASURES} where {n} > {b}" for n, b in metrics.ALERTS) + ")")
def m9(r):
    log = r.request_log.withColumn("ts", C("ts").cast("timestamp"))
    return metrics.alert_rules(log, r.runs, length="1 day", bounds=_EDGES).select(F.date_format("start", "yyyy-MM-dd").alias("start"), "alert", F.round("value", 4).alias("value"))


@query("M10_metrics_history", "select strftime(g, '%Y-%m-%d %H:%M') as start, count(event_id) as n from (select unnest(range(timestamp '2024-01-19 00:00:00', timestamp '2024-01-20 00:00:00', interval 5 minutes)) as g) left join events on ts >= g and ts < g + interval 5 minutes group by g")
def m10(r):
    return metrics.metrics_history(r.request_log, "2024-01-20").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n")


@query("M11_slow_requests", "select event_id, duration from request_log where duration > 100")
def m11(r):
    src, schema = _log(r)
    out = scratch(r.spark, "slow-out")
    items.write_all(metrics.slow_requests(items.read_stream(r.spark, src, schema), 100.0), out, scratch(r.spark, "cp"))
    return r.spark.read.parquet(out).select("event_id", "duration")


_GAPS = "(select *, sum(case when ts - prev < interval 2 hours then 0 else 1 end) over (partition by user_id order by ts rows unbounded preceding) as s from (select *, lag(ts) over (partition by user_id order by ts) as prev from request_log))"


@query("M12_crawl_sessions", f"select user_id, count(*) as requests, count(*) filter (status >= 400) as errors, count(distinct path) as urls, cast(floor(epoch(max(ts))) as bigint) - cast(floor(epoch(min(ts))) as bigint) as seconds from {_GAPS} group by user_id, s")
def m12(r):
    return metrics.crawl_sessions(r.request_log.withColumn("ts", C("ts").cast("timestamp")), "2 hours").drop("start")
