"""M5 to M12: rates, streaks, alerts and sessions over the request log. Batch and stream tables alike
where the docstring does not say otherwise."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor


# Requests allowed a minute and an hour by kind of caller, and in 60 seconds by class of host.
CALLER_LIMITS = {"public": (20, 100), "key": (60, 1000)}
HOST_LIMITS = {"web": 120, "api": 300}


def _limit(limit: int | dict[str, int], kind: str) -> Column:
    """One limit for all, or the limit of the class named in column kind; a class without one has no limit."""
    if isinstance(limit, int):
        return F.lit(limit)
    return F.element_at(F.create_map(*[F.lit(x) for k, n in limit.items() for x in (k, n)]), F.col(kind))


def host_class(path: Column) -> Column:
    return F.when(path.contains("/api/"), "api").otherwise("web")


def tumbling_rate(df: DataFrame, window: str, limit: int | dict[str, int], keys=("user_id",), kind: str = "caller", time: str = "ts", delay: str | None = None) -> DataFrame:
    """Events of each fixed window and key, with a flag where they pass the limit, which may differ by the class in
    column kind (then one of the keys). With a delay, a stream gives each window once, when the watermark has closed it,
    and keeps no more than the open ones."""
    if not isinstance(limit, int):
        keys = (*keys, kind)
    if delay:
        df = df.withWatermark(time, delay)
    out = df.groupBy(F.window(time, window).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", F.coalesce(F.col("n") > _limit(limit, kind), F.lit(False)).alias("over"))


def caller_rates(df: DataFrame, keys=("user_id", "path"), time: str = "ts", delay: str | None = None, limits=CALLER_LIMITS) -> DataFrame:
    """tumbling_rate by minute and by hour, with the caller's limits: (span, start, keys, caller, n, over)."""
    out = None
    for i, span in enumerate(("1 minute", "1 hour")):
        one = tumbling_rate(df, span, {k: n[i] for k, n in limits.items()}, keys, time=time, delay=delay).withColumn("span", F.lit(span))
        out = one if out is None else out.unionByName(one)
    return out


def sliding_rate(df: DataFrame, seconds: int, limit: int | dict[str, int], key: str = "host", kind: str = "kind", time: str = "ts", slices: int = 10) -> DataFrame:
    """Batch: each event with the number of events of its key in the seconds up to it.

    A key's events are dealt to slices of time, each of which also gets copies of the last `seconds` of the slice
    before it, so no task has more of a key than one slice and its tail, however many events the key has. Events without a time
    are of none and count 0.
    """
    span, back = seconds * slices * 1_000_000, seconds * 1_000_000
    keys = [key] if isinstance(limit, int) else [key, kind]
    at = F.unix_micros(F.col(time).cast("timestamp"))
    own = F.floor(F.col("_at") / span).cast("long")
    # events at the very start of the next slice still see those exactly `seconds` before
    near_end = F.col("_at") - own * span >= span - back
    copies = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = df.withColumn("_at", at).withColumn("_own", own).withColumn("_slice", F.explode(F.coalesce(copies, F.array(F.lit(None).cast("long")))))
    w = W.partitionBy(*keys, "_slice").orderBy("_at").rangeBetween(-back, 0)
    counted = dealt.withColumn("n", F.when(F.col("_at").isNull(), F.lit(0)).otherwise(F.count("*").over(w)))
    return counted.filter(F.col("_slice").eqNullSafe(F.col("_own"))).drop("_at", "_own", "_slice").withColumn("over", F.coalesce(F.col("n") > _limit(limit, kind), F.lit(False)))


def sliding_rate_stream(df: DataFrame, limit: int | dict[str, int], key: str = "host", kind: str = "kind", time: str = "ts", length: str = "60 seconds", step: str = "5 seconds") -> DataFrame:
    keys = [key] if isinstance(limit, int) else [key, kind]
    out = df.withWatermark(time, length).groupBy(F.window(time, length, step).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", F.coalesce(F.col("n") > _limit(limit, kind), F.lit(False)).alias("over"))


def endpoint_group(host: Column, path: Column) -> Column:
    """Host and the first three parts of the path."""
    return F.concat_ws("/", host, F.slice(F.filter(F.split(path, "/"), lambda p: p != ""), 1, 3))


def failure_streaks(df: DataFrame, threshold: int = 5, group: str = "endpoint", time: str = "ts", tiebreak: str = "event_id", cooldown: int = 300, slice: int = 86_400) -> DataFrame:
    """Batch: runs of failures in a row of each group with `threshold` or more, the time at which they
    open the circuit and the time until which it cools down; a success closes a run.

    In two levels, so that no task sorts all events of a group: within slices of time (seconds) the events are
    numbered, then the few sums of a group's slices say how many successes, and how many failures of a run
    that goes on, lie before each slice. Rows without a group or a time are left out.
    """
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = df.filter(F.col(time).isNotNull() & F.col(group).isNotNull()).withColumn("_part", F.floor(at / (slice * 1_000_000)).cast("long")).withColumn("_good", (F.col("status") < 400).cast("int"))
    rows = rows.withColumn("_local", F.sum("_good").over(W.partitionBy(group, "_part").orderBy(time, tiebreak)))
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = rows.groupBy(group, "_part").agg(F.sum("_good").alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    bad = rows.filter("_good = 0").join(carried, [group, "_part"]).withColumn("run", F.col("_before") + F.col("_local"))
    bad = bad.withColumn("_nth", F.row_number().over(W.partitionBy(group, "_part", "run").orderBy(time, tiebreak)))
    parts = bad.groupBy(group, "run", "_part").agg(F.count("*").alias("_n"), F.min(time).alias("_first"))
    of_run = W.partitionBy(group, "run").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("_prior", F.coalesce(F.sum("_n").over(of_run), F.lit(0)))
    opening = parts.filter((F.col("_prior") < threshold) & (F.col("_prior") + F.col("_n") >= threshold)).select(group, "run", "_part", (F.lit(threshold) - F.col("_prior")).alias("_nth"))
    opened = bad.filter(F.col("_nth") <= threshold).join(opening, [group, "run", "_part", "_nth"]).select(group, "run", F.col(time).alias("opened"))
    out = parts.groupBy(group, "run").agg(F.sum("_n").alias("failures"), F.min("_first").alias("first")).join(opened, [group, "run"])
    return out.select(group, "failures", "first", "opened", (F.col("opened") + F.expr(f"interval {cooldown} seconds")).alias("until"))


#: So many requests at most in one value of a circuit's state.
REQUESTS_A_VALUE = 100_000


class Circuit(StatefulProcessor):
    """One group's circuit; see failure_streaks_stream(). Times are microseconds, timers milliseconds.

    Requests that wait are kept in bulk, as arrays of four numbers each: time, whether the id is known, id, whether it succeeded."""

    def __init__(self, group: str, threshold: int, cooldown: int):
        self.group, self.threshold, self.cooldown = group, threshold, cooldown * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        self.circuit = handle.getValueState("circuit", "mode string, failures int, until long")
        self.waiting = handle.getListState("waiting", "requests binary")

    def _wake(self, at: int) -> None:
        self.handle.registerTimer(-(-int(at) // 1000))

    @staticmethod
    def _values(requests) -> list[tuple[bytes]]:
        return [(requests[i : i + REQUESTS_A_VALUE].tobytes(),) for i in range(0, len(requests), REQUESTS_A_VALUE)]

    def handleInputRows(self, key, rows, timerValues):
        for batch in rows:
            if len(batch):
                new = batch[["at_us", "known", "id", "good"]].to_numpy("int64")
                self.waiting.appendList(self._values(new))
                # one timer for all that waits: when it goes off, all that is due counts, and the rest gets the next one
                self._wake(new[:, 0].min())
        return iter(())

    def _waiting(self):
        """What waits, in order."""
        import numpy as np

        values = [np.frombuffer(v[0], "int64").reshape(-1, 4) for v in self.waiting.get()] if self.waiting.exists() else []
        held = np.concatenate(values) if values else np.empty((0, 4), "int64")
        return held[np.lexsort((held[:, 2], held[:, 1], held[:, 0]))]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd

        # all that the watermark has passed counts at once; further timers of this batch find nothing left to do
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._waiting()
        due = int((held[:, 0] <= now).sum())
        if due < len(held):
            self._wake(held[due, 0])
        if due:
            self.waiting.clear()
            if due < len(held):
                self.waiting.put(self._values(held[due:]))
        mode, failures, until = self.circuit.get() if self.circuit.exists() else ("closed", 0, 0)
        out = []

        def change(at, state):
            out.append((at, state))
            return state

        for at, good in zip(held[:due, 0].tolist(), held[:due, 3].tolist()):
            if mode == "open" and at >= until:
                mode = change(until, "half-open")
            if mode == "open":
                continue
            if good:
                mode, failures = change(at, "closed") if mode == "half-open" else mode, 0
                continue
            failures += 1
            if failures >= self.threshold or mode == "half-open":
                mode, failures, until = change(at, "open"), 0, at + self.cooldown
        if mode == "open" and until <= now:
            mode = change(until, "half-open")
        if (mode, failures) == ("closed", 0):
            self.circuit.clear()
        else:
            self.circuit.update((mode, failures, until))
        if mode == "open":
            self._wake(until)
        if not out:
            return iter(())
        at, state = zip(*out)
        return iter([pd.DataFrame({self.group: pd.Series([key[0]] * len(out), dtype=object), "at": pd.to_datetime(pd.Series(at, dtype="int64"), unit="us", utc=True), "state": list(state)})])

    def close(self) -> None:
        pass


def failure_streaks_stream(df: DataFrame, threshold: int = 5, cooldown: int = 300, group: str = "endpoint", time: str = "ts", tiebreak: str = "event_id", delay: str = "10 minutes") -> DataFrame:
    """Stream: changes of each group's circuit, (group, at, state) with state open, half-open or closed.

    A group opens at `threshold` failures in a row, and what it is asked during the cool-down does not
    count. At the end of the cool-down it is half-open, whether or not a request comes: the next
    one opens it again if it fails, and closes it else. Requests wait for the watermark, `delay` behind the
    newest time, and then count in order of time and tiebreak, so neither the order of arrival nor the cut into
    batches matters; later ones are dropped as late. A circuit that is closed and without failures keeps no state.
    Needs the state store of state_store(). A null group is one group; rows without a time are left out.
    """
    id = F.col(tiebreak).cast("long")
    numbers = {"at_us": F.unix_micros(time), "known": id.isNotNull(), "id": F.coalesce(id, F.lit(0)), "good": F.coalesce(F.col("status").cast("int") < 400, F.lit(False))}
    rows = df.filter(F.col(time).isNotNull()).withWatermark(time, delay).select(group, F.col(time).alias("_time"), *[v.cast("long").alias(n) for n, v in numbers.items()])
    kind = dict(df.dtypes)[group]
    return rows.groupBy(group).transformWithStateInPandas(Circuit(group, threshold, cooldown), f"{group} {kind}, at timestamp, state string", "Append", "EventTime")


@contextmanager
def state_store(spark: SparkSession):
    """Within it, streams are started with the state store on disk that custom state needs."""
    name, own = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name, None)
    spark.conf.set(name, own)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def counter_rate(df: DataFrame, keys=("component",), time: str = "ts", length: str = "5 minutes", step: str = "1 minute", seconds: int = 300) -> DataFrame:
    """Events a second over sliding windows."""
    out = df.groupBy(F.window(time, length, step).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("start"), *keys, F.round(F.col("n") / seconds, 6).alias("rate"))


#: Size parameter of the quantile sketches: ranks are right to about 1.3 percent.
SKETCH_K = 200
# Upper bounds of the latency histogram in seconds.
BOUNDS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0)


def latency_summaries(df: DataFrame, keys=("host",), length: str = "5 minutes", time: str = "ts", value: str = "duration", bounds=BOUNDS) -> DataFrame:
    """(start, keys, n, bad, total, below, sketch) of each window: all that rates and quantiles of longer windows
    and wider groups need. below has the number of values up to each bound. A task keeps a sketch of bounded size for
    each group, never its values. Batch and stream alike; null values count in n alone, rows without a time nowhere.
    """
    v = F.col(value).cast("double")
    below = F.array(*[F.count_if(v <= b) for b in bounds])
    out = df.groupBy(F.window(time, length).alias("w"), *keys).agg(F.count("*").alias("n"), F.count_if(F.col("status") >= 400).alias("bad"), F.sum(v).alias("total"), below.alias("below"), F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("sketch"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", "bad", "total", "below", "sketch")


def merge_summaries(summaries: DataFrame, keys=(), length: str | None = None, bounds=BOUNDS) -> DataFrame:
    """latency_summaries() merged upward: to windows of `length`, or all of time without one, and to fewer keys."""
    window = [F.window("start", length).alias("w")] if length else []
    below = F.array(*[F.sum(F.get("below", F.lit(i))) for i in range(len(bounds))])
    out = summaries.groupBy(*window, *keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("total").alias("total"), below.alias("below"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))
    return out.select(*[F.col("w.start").alias("start")] * bool(length), *keys, "n", "bad", "total", "below", "sketch")


def sketch_quantile(q: float, sketch: str = "sketch") -> Column:
    """The value at rank q, right to about 1.3 percent of rank."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def exact_quantile(df: DataFrame, q: float, key: str = "host", value: str = "duration") -> DataFrame:
    """Batch: (key, exact), the quantile of each group's values itself, linear between the two ranks around it.

    Values are counted in a few ranges around a sketch's answer, each known by its own smallest and largest value; the counts
    say in which of them the ranks lie, and the values of those alone are sorted. The sketch decides how small the ranges are, never
    what the answer is. Null values do not count.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(value).cast("double").alias("_v")).filter("_v is not null")
    ends = [min(max(q + d, 0.0), 1.0) for d in (-0.05, -0.02, 0.0, 0.02, 0.05)]
    one = rows.groupBy(F.col("_key").alias("_of")).agg(F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("_sketch"))
    one = one.select("_of", F.array(*[F.kll_sketch_get_quantile_double("_sketch", F.lit(e)) for e in ends]).alias("_ends"))
    above = sum(((F.col("_v") > F.col("_ends")[i]).cast("int") for i in range(1, len(ends))), (F.col("_v") > F.col("_ends")[0]).cast("int"))
    same_key = F.col("_key").eqNullSafe(F.col("_of"))
    counts = rows.join(one, same_key).groupBy("_of", above.alias("_range")).agg(F.count("*").alias("_in"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
    of_key = W.partitionBy("_of")
    before = F.coalesce(F.sum("_in").over(of_key.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    aim = (F.sum("_in").over(of_key) - 1) * F.lit(q)
    held = counts.select("_of", "_in", "_from", "_to", before.alias("_before"), F.floor(aim).alias("_low"), F.ceil(aim).alias("_high"), (aim - F.floor(aim)).alias("_part"))
    held = held.filter("_before <= _high and _before + _in > _low").drop("_in")
    rank = F.col("_before") + F.row_number().over(W.partitionBy("_key", "_from").orderBy("_v")) - 1
    met = rows.join(held, same_key & F.col("_v").between(F.col("_from"), F.col("_to"))).withColumn("_rank", rank)
    low, high = F.min("_v"), F.max("_v")
    return met.filter("_rank in (_low, _high)").groupBy(F.col("_key").alias(key)).agg((low + (high - low) * F.max("_part")).alias("exact"))


def bucket_quantile(q: float, bounds=BOUNDS) -> Column:
    """Quantile of a summary read from its histogram: linear within the bucket that holds it; the last bound where it
    lies beyond all of them, as histogram counters have it."""
    aim = F.col("n") * F.lit(q)
    out = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low, under = (float(bounds[i - 1]), F.get("below", F.lit(i - 1))) if i else (0.0, F.lit(0))
        here = F.get("below", F.lit(i))
        out = F.when(here >= aim, F.lit(low) + (bounds[i] - low) * F.coalesce(F.try_divide(aim - under, here - under), F.lit(0.0))).otherwise(out)
    return out


#: Alerts: name, measure, bound.
ALERTS = (("error_ratio", 0.05), ("p95_seconds", 1.0), ("failures", 0), ("duration", 1800.0))


def alert_rules(df: DataFrame, runs: DataFrame | None = None, time: str = "ts", length: str = "1 hour", rules=ALERTS, step: str = "5 minutes", bounds=BOUNDS) -> DataFrame:
    """Alerts raised in each window: (start, alert, value). Requests are summed up by step, merged to the windows;
    the quantile is the histogram's. The duration is that of the longest of runs(start_time, end_time) that began in the window."""
    m = merge_summaries(latency_summaries(df, (), step, time, bounds=bounds), (), length, bounds)
    m = m.select("start", (F.col("bad") / F.col("n")).alias("error_ratio"), bucket_quantile(0.95, bounds).alias("p95_seconds"), F.col("bad").cast("double").alias("failures"))
    if runs is None:
        m = m.withColumn("duration", F.lit(None).cast("double"))
    else:
        seconds = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6
        longest = runs.groupBy(F.window(F.col("start_time").cast("timestamp"), length).alias("w")).agg(F.max(seconds).alias("duration")).select(F.col("w.start").alias("start"), "duration")
        m = m.join(longest, "start", "full")
    long = m.select("start", F.explode(F.array(*[F.when(F.col(n) > b, F.struct(F.lit(n).alias("alert"), F.round(n, 6).alias("value"))) for n, b in rules])).alias("a"))
    return long.filter("a is not null").select("start", "a.*")


def metrics_history(df: DataFrame, end, hours: int = 24, time: str = "ts", minutes: int = 5) -> DataFrame:
    """Events of each bucket of the last hours, empty buckets included."""
    spark = df.sparkSession
    stop = F.lit(end).cast("timestamp")
    start = stop - F.expr(f"interval {hours} hours")
    grid = spark.range(1).select(F.explode(F.sequence(start, stop - F.expr(f"interval {minutes} minutes"), F.expr(f"interval {minutes} minutes"))).alias("start"))
    rows = df.filter((F.col(time) >= start) & (F.col(time) < stop)).groupBy(F.window(F.col(time).cast("timestamp"), f"{minutes} minutes").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")
    return grid.join(rows, "start", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def slow_requests(df: DataFrame, seconds: float = 5.0) -> DataFrame:
    return df.filter(F.col("duration") > seconds)


def crawl_sessions(df: DataFrame, gap: str = "30 minutes", key: str = "user_id", time: str = "ts") -> DataFrame:
    """Sessions of a key: requests less than gap apart."""
    out = df.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("requests"), F.count_if(F.col("status") >= 400).alias("errors"), F.countDistinct("path").alias("urls"), F.max(time).alias("last"))
    return out.select(key, F.col("w.start").alias("start"), "requests", "errors", "urls", (F.unix_timestamp(F.col("last").cast("timestamp")) - F.unix_timestamp(F.col("w.start").cast("timestamp"))).alias("seconds"))
