"""User-metric reports over ``events`` (user_id, ts, event_type, value).

These re-aim the analytics projects that are only described next to the
exercises (a daily report with a week of history, an A/B comparison of two
user groups, anomaly alerts on a metric, per-dimension daily metrics).  The
rules are ours where the description gives none; they are stated in each
docstring.

Numbers are computed so that every engine gets the same bits: values are
read as decimal(18,2) (they carry two decimals), sums are exact decimals or
integers, and ratios are one IEEE division of exact operands.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.operators.distinct import id_bitmaps, merged_counts
from fathom.operators.ranks import rank_sum_z, rank_sums, sample_variance, welch
from fathom.plans.registry import query

WEEK_DAYS = 7
ALERT_HISTORY = 4
ALERT_SIGMAS = 3


def _events(v):
    e = v.table("events")
    return e.select(
        F.to_date("ts").alias("day"),
        "ts",
        "user_id",
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


def _count_type(t: str):
    return F.count(F.when(F.col("event_type") == t, F.lit(1)))


@query(
    "m_daily_report",
    sql=f"""
    WITH ev AS (SELECT CAST(ts AS DATE) AS day, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value FROM events),
    wk AS (SELECT * FROM ev WHERE day BETWEEN (SELECT max(day) FROM ev) - {WEEK_DAYS - 1} AND (SELECT max(day) FROM ev))
    SELECT day,
           count(DISTINCT user_id) AS dau,
           count(*) AS events,
           count(CASE WHEN event_type = 'view' THEN 1 END) AS views,
           count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
           count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN value END) AS DECIMAL(38,2)) AS revenue,
           CAST(count(CASE WHEN event_type = 'click' THEN 1 END) AS DOUBLE)
             / NULLIF(count(CASE WHEN event_type = 'view' THEN 1 END), 0) AS ctr
    FROM wk GROUP BY day""",
)
def m_daily_report(v):
    """Main user metrics per day for the last week of data (the newest day
    is "yesterday"): active users, events, views, clicks, purchases, revenue
    and click-through rate."""
    ev = _events(v)
    # The week's first moment as one scalar over ts, a condition that the scan can use.
    first = ev.agg(F.date_sub(F.max("ts").cast("date"), WEEK_DAYS - 1).cast("timestamp_ntz")).scalar()
    week = ev.filter(F.col("ts") >= first)
    daily = week.groupBy("day").agg(
        F.count_distinct("user_id").alias("dau"),
        F.count(F.lit(1)).alias("events"),
        _count_type("view").alias("views"),
        _count_type("click").alias("clicks"),
        _count_type("purchase").alias("purchases"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).cast("decimal(38,2)").alias("revenue"),
    )
    return daily.withColumn("ctr", F.try_divide(F.col("clicks").cast("double"), F.col("views")))


@query(
    "m_ab_test",
    sql="""
    WITH ev AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS grp, user_id, event_type,
                       CAST(value AS DECIMAL(18,2)) AS value FROM events),
    g AS (SELECT grp,
                 count(DISTINCT user_id) AS users,
                 count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers,
                 count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
                 CAST(sum(CASE WHEN event_type = 'purchase' THEN value END) AS DECIMAL(38,2)) AS revenue,
                 CAST(sum(CASE WHEN event_type = 'purchase' THEN value * value END) AS DECIMAL(38,4)) AS sumsq,
                 count(CASE WHEN event_type = 'purchase' THEN value END) AS valued
          FROM ev GROUP BY grp)
    SELECT grp, users, buyers, purchases, revenue,
           CAST(buyers AS DOUBLE) / NULLIF(users, 0) AS conversion,
           CAST(revenue AS DOUBLE) / NULLIF(valued, 0) AS mean_value,
           (CAST(sumsq AS DOUBLE) - CAST(revenue AS DOUBLE) * CAST(revenue AS DOUBLE) / NULLIF(valued, 0))
             / NULLIF(valued - 1, 0) AS var_value
    FROM g""",
)
def m_ab_test(v):
    """Two user groups (even / odd user id: our split rule) compared on
    conversion to purchase and on purchase value: users, buyers, purchases,
    revenue, conversion, mean and sample variance of the purchase value
    over purchases with a known value (from exact sums, so the statistic is
    reproducible)."""
    ev = _events(v).withColumn("grp", F.when(F.col("user_id") % 2 == 0, F.lit("A")).otherwise(F.lit("B")))
    is_buy = F.col("event_type") == "purchase"
    # Both distinct counts from one table of bitmaps, without a copy of the rows for each.
    ids = id_bitmaps(ev, ["grp", is_buy.alias("buy")], F.col("user_id"))
    counts = ev.groupBy("grp").agg(
        F.count(F.when(is_buy, F.lit(1))).alias("purchases"),
        F.sum(F.when(is_buy, F.col("value"))).cast("decimal(38,2)").alias("revenue"),
        F.sum(F.when(is_buy, F.col("value") * F.col("value"))).cast("decimal(38,4)").alias("sumsq"),
        F.count(F.when(is_buy, F.col("value"))).alias("valued"),
    )
    users, buyers = merged_counts(ids, ["grp"], "users"), merged_counts(ids.filter("buy"), ["grp"], "buyers")
    g = counts.join(users, "grp", "left").join(buyers, "grp", "left").fillna(0, ["users", "buyers"])
    rev = F.col("revenue").cast("double")
    n = F.col("valued")
    return g.select(
        "grp",
        "users",
        "buyers",
        "purchases",
        "revenue",
        F.try_divide(F.col("buyers").cast("double"), F.col("users")).alias("conversion"),
        F.try_divide(rev, n).alias("mean_value"),
        F.try_divide(F.col("sumsq").cast("double") - F.try_divide(rev * rev, n), n - 1).alias("var_value"),
    )


@query(
    "m_ab_statistics",
    sql="""
    WITH p AS (SELECT coalesce(user_id % 2 = 0, FALSE) AS a, CAST(value AS DECIMAL(18,2)) AS v
               FROM events WHERE event_type = 'purchase' AND value IS NOT NULL),
    r AS (SELECT a, v, 2 * rank() OVER (ORDER BY v) + count(*) OVER (PARTITION BY v) - 1 AS twice_rank FROM p),
    s AS (SELECT count(*) FILTER (a) AS n_a, count(*) FILTER (NOT a) AS n_b,
                 CAST(sum(v) FILTER (a) AS DOUBLE) AS sum_a, CAST(sum(v) FILTER (NOT a) AS DOUBLE) AS sum_b,
                 CAST(sum(v * v) FILTER (a) AS DOUBLE) AS sq_a, CAST(sum(v * v) FILTER (NOT a) AS DOUBLE) AS sq_b,
                 CAST(sum(twice_rank) FILTER (a) AS DOUBLE) AS rank2_a,
                 (SELECT CAST(sum(CAST(t AS HUGEINT) * t * t - t) AS DOUBLE) FROM (SELECT count(*) AS t FROM p GROUP BY v)) AS ties
          FROM r),
    m AS (SELECT *, sum_a / NULLIF(n_a, 0) AS mean_a, sum_b / NULLIF(n_b, 0) AS mean_b,
                 (sq_a - sum_a * sum_a / NULLIF(n_a, 0)) / NULLIF(n_a - 1, 0) AS var_a,
                 (sq_b - sum_b * sum_b / NULLIF(n_b, 0)) / NULLIF(n_b - 1, 0) AS var_b,
                 CAST(n_a AS DOUBLE) AS x, CAST(n_b AS DOUBLE) AS y
          FROM s),
    e AS (SELECT *, var_a / NULLIF(x, 0) AS ea, var_b / NULLIF(y, 0) AS eb,
                 rank2_a / 2 - x * (x + 1) / 2 AS u_a,
                 x * y / 12 * ((x + y + 1) - ties / NULLIF((x + y) * (x + y - 1), 0)) AS spread
          FROM m)
    SELECT n_a, n_b, mean_a, mean_b, var_a, var_b,
           (mean_a - mean_b) / NULLIF(sqrt(ea + eb), 0) AS welch_t,
           (ea + eb) * (ea + eb) / NULLIF(ea * ea / NULLIF(x - 1, 0) + eb * eb / NULLIF(y - 1, 0), 0) AS welch_df,
           rank2_a / 2 AS rank_sum_a, ties,
           (u_a - x * y / 2) / NULLIF(sqrt(spread), 0) AS rank_sum_z
    FROM e WHERE n_a > 0 AND n_b > 0""",
)
def m_ab_statistics(v):
    """The two user groups of ``m_ab_test`` compared by two statistics of the
    purchase value, one row: Welch's t with its degrees of freedom, from exact
    sums, and the rank-sum z with average ranks for ties.  No row where a
    group has no purchase with a known value.

    Ranks come from counts per value, ordered in ranges (``value_ranks``), so
    neither a frequent value nor the whole order is one task's work.
    """
    bought = _events(v).filter((F.col("event_type") == "purchase") & F.col("value").isNotNull())
    bought = bought.select(F.coalesce(F.col("user_id") % 2 == 0, F.lit(False)).alias("a"), "value")
    sums = bought.groupBy("a").agg(
        F.sum("value").cast("double").alias("total"), F.sum(F.col("value") * F.col("value")).cast("double").alias("squares")
    )
    ranks = rank_sums(bought, "value", "a")
    columns = [c for c in (*sums.columns, *ranks.columns) if c != "a"]
    both = sums.join(ranks, "a").agg(
        *[F.max(F.when(F.col("a") == side, F.col(c))).alias(f"{c}_{name}") for side, name in ((True, "a"), (False, "b")) for c in columns]
    )
    c = {x: F.col(x) for x in both.columns}
    mean = {s: F.try_divide(c[f"total_{s}"], c[f"n_{s}"]) for s in "ab"}
    var = {s: sample_variance(c[f"n_{s}"], c[f"total_{s}"], c[f"squares_{s}"]) for s in "ab"}
    t, df = welch(c["n_a"], mean["a"], var["a"], c["n_b"], mean["b"], var["b"])
    return both.filter("n_a IS NOT NULL AND n_b IS NOT NULL").select(
        "n_a", "n_b",
        *[mean[s].alias(f"mean_{s}") for s in "ab"],
        *[var[s].alias(f"var_{s}") for s in "ab"],
        t.alias("welch_t"), df.alias("welch_df"),
        (c["twice_rank_sum_a"].cast("double") / 2).alias("rank_sum_a"),
        c["ties_a"].cast("double").alias("ties"),
        rank_sum_z(c["n_a"], c["n_b"], c["twice_rank_sum_a"], c["ties_a"]).alias("rank_sum_z"),
    )


@query(
    "m_subtotals",
    sql="""
    SELECT CAST(GROUPING(day, event_type) AS BIGINT) AS level, day, event_type,
           count(*) AS events, count(DISTINCT user_id) AS users,
           CAST(sum(value) AS DECIMAL(38,2)) AS total_value
    FROM (SELECT CAST(ts AS DATE) AS day, event_type, user_id, CAST(value AS DECIMAL(18,2)) AS value FROM events) AS ev
    GROUP BY CUBE (day, event_type)""",
)
def m_subtotals(v):
    """Events, users and value by day and event type with all subtotals.
    ``level`` tells a total from a NULL dimension: 0 by day and type, 1 by
    day, 2 by type, 3 all.

    The rows are read into cells of day and type first; the grouping sets run
    over those.  Users can't be added up: bitmaps of the cells are merged.
    """
    ev = _events(v)
    dims = ["day", "event_type"]
    cells = ev.groupBy(*dims).agg(F.count(F.lit(1)).alias("events"), F.sum("value").cast("decimal(38,2)").alias("total_value"))
    added = [F.sum("events").alias("events"), F.sum("total_value").cast("decimal(38,2)").alias("total_value")]
    parts = [[F.col(d) for d in kept] for kept in (dims, ["day"], ["event_type"])]
    sums = cells.groupingSets(parts, *dims).agg(F.grouping_id().alias("level"), *added)
    # The grand total is a row even of no events.
    everything = cells.agg(*added).select(F.lit(3).cast("long").alias("level"), F.coalesce("events", F.lit(0)).alias("events"), "total_value")
    sums = sums.unionByName(everything, allowMissingColumns=True)
    ids = id_bitmaps(ev, dims, F.col("user_id"))
    sets = [[F.col(d) for d in kept] + [F.col("bucket")] for kept in (dims, ["day"], ["event_type"], [])]
    merged = ids.groupingSets(sets, *dims, "bucket").agg(
        F.grouping(F.col("day")).alias("no_day"), F.grouping(F.col("event_type")).alias("no_type"), F.bitmap_or_agg("ids").alias("ids")
    )
    level = (F.col("no_day") * 2 + F.col("no_type")).cast("long")
    users = merged.groupBy(level.alias("_level"), F.col("day").alias("_day"), F.col("event_type").alias("_type")).agg(
        F.sum(F.bitmap_count("ids")).alias("users")
    )
    same = (F.col("level") == F.col("_level")) & F.col("day").eqNullSafe(F.col("_day")) & F.col("event_type").eqNullSafe(F.col("_type"))
    return sums.join(users, same, "left").select(
        "level", *dims, "events", F.coalesce("users", F.lit(0)).alias("users"), "total_value"
    )


@query(
    "m_alerts",
    sql=f"""
    WITH h AS (SELECT event_type, date_trunc('hour', ts) AS slot, count(*) AS n FROM events GROUP BY 1, 2),
    w AS (SELECT event_type, slot, n,
                 count(*) OVER p AS k, sum(n) OVER p AS s, sum(n * n) OVER p AS ss
          FROM h
          WINDOW p AS (PARTITION BY event_type ORDER BY date_diff('hour', TIMESTAMP '1970-01-01', slot)
                       RANGE BETWEEN {ALERT_HISTORY} PRECEDING AND 1 PRECEDING)),
    z AS (SELECT event_type, slot, n, CAST(s AS DOUBLE) / k AS mean_prev,
                 sqrt(CAST(k * ss - s * s AS DOUBLE) / (k * (k - 1))) AS sd_prev, k
          FROM w WHERE k >= 3)
    SELECT event_type, slot, n, mean_prev, sd_prev FROM z
    WHERE abs(n - mean_prev) > {ALERT_SIGMAS} * sd_prev""",
)
def m_alerts(v):
    """Anomaly alerts: hourly event counts per event type compared with the
    previous hours.  Our rule: an hour is flagged when at least three of the
    four preceding hours have events and its count lies more than three
    standard deviations from their mean.

    The window runs over one row per (type, hour) -- already aggregated -- so
    its size is bounded by the time span, not by the number of events.
    """
    e = v.table("events")
    slot = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    hourly = e.groupBy("event_type", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    # Hours since 1970-01-01 computed from the wall-clock fields of the
    # (time-zone free) timestamp, so no session time zone or DST enters.
    hour_no = F.datediff(F.to_date("slot"), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour("slot")
    w = Window.partitionBy("event_type").orderBy(hour_no).rangeBetween(-ALERT_HISTORY, -1)
    stats = hourly.select(
        "event_type",
        "slot",
        "n",
        F.count(F.lit(1)).over(w).alias("k"),
        F.sum("n").over(w).alias("s"),
        F.sum(F.col("n") * F.col("n")).over(w).alias("ss"),
    ).filter(F.col("k") >= 3)
    k, s, ss = F.col("k"), F.col("s"), F.col("ss")
    scored = stats.select(
        "event_type",
        "slot",
        "n",
        (s.cast("double") / k).alias("mean_prev"),
        F.sqrt((k * ss - s * s).cast("double") / (k * (k - 1))).alias("sd_prev"),
    )
    return scored.filter(F.abs(F.col("n") - F.col("mean_prev")) > ALERT_SIGMAS * F.col("sd_prev"))


@query(
    "m_metrics_by_type",
    sql="""
    SELECT CAST(ts AS DATE) AS day, event_type,
           count(*) AS events,
           count(DISTINCT user_id) AS users,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_value,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(count(value), 0) AS avg_value
    FROM events GROUP BY 1, 2""",
)
def m_metrics_by_type(v):
    """Daily metrics per dimension value (event type): events, users, total
    and mean value -- the rows a dashboard or a downstream table reads."""
    ev = _events(v)
    g = ev.groupBy("day", "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("users"),
        F.sum("value").cast("decimal(38,2)").alias("total_value"),
        F.count("value").alias("__n"),
    )
    return g.select(
        "day", "event_type", "events", "users", "total_value",
        F.try_divide(F.col("total_value").cast("double"), F.col("__n")).alias("avg_value"),
    )
