"""Daily sums, rolling windows, peer statistics, travel, normalisation, ranks, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lynxrisk.config import SCORE_FEATURES, Scale
from lynxrisk.functions.expr import after_hours, count_true, on_weekend, week_start
from lynxrisk.operators.clustering import mean_centroids, nearest_centroid, train
from lynxrisk.operators.normalise import winsorize_minmax
from lynxrisk.operators.ordering import running_sum, sliding
from lynxrisk.operators.peers import safe_zscore
from lynxrisk.operators.ranking import percent_rank, percent_rank_tier, percentile_rank_avg, percentile_tier
from lynxrisk.operators.rolling import Frame, rolling_features
from lynxrisk.operators.travel import impossible_travel
from lynxrisk.plans import features as G
from lynxrisk.plans.weekly import top_item
from lynxrisk.queries.feeds import CFG, Feeds, name
from lynxrisk.queries.registry import query
from lynxrisk.queries.written import feature_grid, written
from lynxrisk.sources.session import settle

DIMS = 64


def rounded(df: DataFrame, *cols: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def daily_events(f: Feeds) -> DataFrame:
    ts = F.col("event_timestamp")
    return f.events.groupBy("user_id", F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        count_true(after_hours(ts)).alias("after_hours"),
        count_true(on_weekend(ts)).alias("weekend"),
        F.sum("value").alias("value"),
    )


@query(
    "q14_daily_rollup",
    """SELECT user_id, day, count(*) AS n,
              count(*) FILTER (hour(event_timestamp) < 8 OR hour(event_timestamp) >= 18) AS after_hours,
              count(*) FILTER (dayofweek(event_timestamp) IN (0, 6)) AS weekend, round(sum(value), 9) AS value
       FROM ev GROUP BY 1, 2""",
)
def daily_rollup(f: Feeds) -> DataFrame:
    return rounded(daily_events(f), "value")


@query(
    "q15_rolling_7d",
    """WITH d AS (SELECT user_id, day, count(*) AS n, sum(value) AS value, max(value) AS top FROM ev GROUP BY 1, 2)
       SELECT user_id, window_end_date, CAST(sum(n) AS BIGINT) AS events, round(sum(value), 9) AS value,
              max(top) AS top, CAST(count(*) AS BIGINT) AS active_days
       FROM d JOIN ends ON day BETWEEN window_end_date - 6 AND window_end_date GROUP BY 1, 2""",
)
def rolling(f: Feeds) -> DataFrame:
    daily = f.events.groupBy("user_id", F.to_date("event_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"), F.max("value").alias("top")
    )
    daily = settle(daily)  # the calendar and the windows both read it
    frames = {
        "events": Frame("n"),
        "value": Frame("value"),
        "top": Frame("top", how="max"),
        "active_days": Frame("n", how="count"),
    }
    return rounded(rolling_features(daily, "user_id", "day", frames, f.ends, "n"), "value")


@query(
    "q16_peer_zscore",
    """SELECT employee_id, window_end_date, round(badge_swipes_outlier, 9) + 0 AS badge_swipes_outlier,
              round(after_hours_pacs_score, 9) + 0 AS after_hours_pacs_score FROM f_pacs""",
)
def peer_zscore(f: Feeds) -> DataFrame:
    out = G.agg_pacs(f.feed("pacs").ok, f.hris, f.ends)
    return rounded(out, "badge_swipes_outlier", "after_hours_pacs_score")


@query(
    "q16b_zscore_by_brand",
    """WITH s AS (SELECT p_brand, avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS sd FROM part GROUP BY 1)
       SELECT p_partkey, round(coalesce((p_retailprice - m) / nullif(sd, 0), 0), 9) AS price_z
       FROM part JOIN s USING (p_brand)""",
)
def zscore_by_brand(f: Feeds) -> DataFrame:
    out = safe_zscore(f.table("part"), "p_retailprice", ["p_brand"], "price_z")
    return rounded(out.select("p_partkey", "price_z"), "price_z")


@query(
    "q17_peer_fraction_gap",
    """SELECT employee_id, window_end_date, round(after_hours_network_score, 9) + 0 AS after_hours_network_score,
              round(vpn_anomaly_score, 9) + 0 AS vpn_anomaly_score FROM f_network""",
)
def fraction_gap(f: Feeds) -> DataFrame:
    out = G.agg_network(f.feed("network").ok, f.hris, f.ends)
    return rounded(out, "after_hours_network_score", "vpn_anomaly_score")


@query(
    "q18_multi_zscore",
    """SELECT employee_id, window_end_date, round(usb_exfiltration_score, 9) + 0 AS usb_exfiltration_score,
              round(file_movement_outlier, 9) + 0 AS file_movement_outlier,
              round(cloud_upload_outlier, 9) + 0 AS cloud_upload_outlier FROM f_dlp""",
)
def multi_zscore(f: Feeds) -> DataFrame:
    out = G.agg_dlp(f.feed("dlp").ok, f.hris, f.ends)
    return rounded(out, "usb_exfiltration_score", "file_movement_outlier", "cloud_upload_outlier")


@query(
    "q19_wow_delta",
    "SELECT employee_id, window_end_date, round(comms_volume_delta, 9) + 0 AS comms_volume_delta FROM f_comms",
)
def wow_delta(f: Feeds) -> DataFrame:
    out = G.agg_comms(f.feed("comms").ok, f.ends)
    return rounded(out.drop("external_comms_ratio"), "comms_volume_delta")


@query(
    "q20_ratio",
    "SELECT employee_id, window_end_date, round(external_comms_ratio, 9) + 0 AS external_comms_ratio FROM f_comms",
)
def external_ratio(f: Feeds) -> DataFrame:
    out = G.agg_comms(f.feed("comms").ok, f.ends)
    return rounded(out.drop("comms_volume_delta"), "external_comms_ratio")


@query(
    "q21_trend_baseline",
    "SELECT employee_id, window_end_date, round(sentiment_trend, 9) + 0 AS sentiment_trend FROM f_pai",
)
def trend_baseline(f: Feeds) -> DataFrame:
    return rounded(G.agg_pai(f.feed("pai").ok, f.ends), "sentiment_trend")


@query("q22_impossible_travel", "SELECT employee_id, event_date, impossible FROM geo_days")
def travel_days(f: Feeds) -> DataFrame:
    return impossible_travel(f.feed("geo").ok, "employee_id", "event_date", "latitude", "longitude")


@query("q22b_impossible_travel_window", "SELECT employee_id, window_end_date, impossible_travel_flag FROM f_geo")
def travel_windows(f: Feeds) -> DataFrame:
    return G.agg_geo(f.feed("geo").ok, f.ends)


@query("q23_window_any", "SELECT employee_id, window_end_date, clearance_anomaly_flag FROM f_adjudication")
def window_any(f: Feeds) -> DataFrame:
    return G.agg_adjudication(f.sv_adjudication, f.ends)


_GRID_COLUMNS = ", ".join(f"round({c}, 9) + 0 AS {c}" for c in SCORE_FEATURES)


@query(
    "q24_grid_fill",
    f"""SELECT employee_id, window_end_date, window_start_date, {_GRID_COLUMNS}, impossible_travel_flag,
               clearance_anomaly_flag FROM grid""",
)
def grid_fill(f: Feeds) -> DataFrame:
    return rounded(feature_grid(f).drop("cross_domain_anomaly_count"), *SCORE_FEATURES)


@query("q25_cross_count", "SELECT employee_id, window_end_date, cross_domain_anomaly_count FROM counted")
def cross_count(f: Feeds) -> DataFrame:
    return written(f).grid.select("employee_id", "window_end_date", "cross_domain_anomaly_count")


@query(
    "q26_winsor_minmax",
    """WITH b AS (SELECT quantile_cont(l_extendedprice, 0.01) AS l1, quantile_cont(l_extendedprice, 0.99) AS h1,
                         quantile_cont(l_quantity, 0.01) AS l2, quantile_cont(l_quantity, 0.99) AS h2,
                         quantile_cont(l_tax, 0.01) AS l3, quantile_cont(l_tax, 0.99) AS h3 FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(coalesce((greatest(l1, least(h1, l_extendedprice)) - l1) / nullif(h1 - l1, 0), 0), 9) AS price_unit,
              round(coalesce((greatest(l2, least(h2, l_quantity)) - l2) / nullif(h2 - l2, 0), 0), 9) AS quantity_unit,
              round(coalesce((greatest(l3, least(h3, l_tax)) - l3) / nullif(h3 - l3, 0), 0), 9) AS tax_unit
       FROM lineitem, b""",
)
def winsor(f: Feeds) -> DataFrame:
    lines = f.table("lineitem")
    units = winsorize_minmax(lines, ["l_extendedprice", "l_quantity", "l_tax"])
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(units["l_extendedprice"], 9).alias("price_unit"),
        F.round(units["l_quantity"], 9).alias("quantity_unit"),
        F.round(units["l_tax"], 9).alias("tax_unit"),
    )


def labelled_distance(f: Feeds) -> DataFrame:
    vectors = f.table("embeddings")
    return nearest_centroid(vectors, "embedding", mean_centroids(vectors, "label", "embedding", DIMS))


_NEAREST = """WITH x AS (SELECT label, i, round(CAST(sum(CAST(CAST(embedding[i] AS DOUBLE) AS DECIMAL(28, 12))) AS DOUBLE) / count(*), 9) AS c
                         FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2),
              d AS (SELECT vec_id, x.label AS cluster_id, sqrt(sum(pow(CAST(embedding[i] AS DOUBLE) - c, 2))) AS dist
                    FROM embeddings e JOIN x ON TRUE GROUP BY 1, 2),
              n AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster_id) AS rn FROM d),
              s AS (SELECT vec_id, cluster_id, round(dist, 9) + 0 AS anomaly_score FROM n WHERE rn = 1)"""


@query("q27_nearest_centroid", f"{_NEAREST} SELECT vec_id, cluster_id, anomaly_score FROM s")
def nearest(f: Feeds) -> DataFrame:
    return rounded(labelled_distance(f).select("vec_id", "cluster_id", "anomaly_score"), "anomaly_score")


KMEANS_ROUNDS = 5


def _kmeans_sql(k: int, rounds: int) -> str:
    """k-means++ start with the engine's draws and so many rounds, one materialized step after the other."""
    far = "list_distance({a}, {b})"
    draw = "-ln((CAST('0x' || substr(md5('42|{i}|' || vec_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496)"
    steps = [
        "p AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        f"c0 AS MATERIALIZED (SELECT 0 AS id, v AS c FROM p ORDER BY {draw.format(i=0)} LIMIT 1)",
    ]
    for i in range(1, k):
        d = far.format(a="v", b="c")
        weighed = f"SELECT vec_id, v, round(min(pow({d}, 2)), 9) AS w FROM p, c{i - 1} GROUP BY vec_id, v"
        steps.append(f"c{i} AS MATERIALIZED (SELECT * FROM c{i - 1} UNION ALL (SELECT {i}, v FROM ({weighed}) WHERE w > 0 ORDER BY {draw.format(i=i)} / w LIMIT 1))")
    model = f"c{k - 1}"
    assigned = "SELECT vec_id, v, first(id ORDER BY {d}, id) AS id, min({d}) AS d FROM p, {m} GROUP BY vec_id, v"
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({assigned.format(d=far.format(a='v', b='c'), m=model)})")
        mean = "round(CAST(sum(CAST(v[i] AS DECIMAL(28, 12))) AS DOUBLE) / count(*), 9)"
        steps.append(
            f"m{r} AS MATERIALIZED (SELECT id, list(x ORDER BY i) AS c FROM (SELECT id, i, {mean} AS x FROM a{r}, range(1, {DIMS + 1}) q(i) GROUP BY id, i) GROUP BY id)"
        )
        model = f"m{r}"
    steps.append(f"n AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY c) - 1 AS INTEGER) AS id, c FROM {model})")
    last = assigned.format(d=far.format(a="v", b="c"), m="n")
    return f"WITH {', '.join(steps)} SELECT id AS cluster_id, count(*) AS members, round(avg(d), 4) + 0 AS mean_distance FROM ({last}) GROUP BY id"


@query("q28_kmeans_train", _kmeans_sql(CFG.clusters, KMEANS_ROUNDS))
def kmeans_train(f: Feeds) -> DataFrame:
    """A fixed number of rounds, which SQL can unroll; the engine also stops when few rows move."""
    vectors = f.table("embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    centers = train(vectors, "v", CFG.clusters, KMEANS_ROUNDS, tol=-1.0, key="vec_id").centroids
    return nearest_centroid(vectors, "v", centers).groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("members"), F.round(F.avg("anomaly_score"), 4).alias("mean_distance")
    )


# sizes at which every operator takes its distributed form on the given tables
TINY = Scale(window_rows=100, chunk_rows=150, percentile_rows=100, quantile_rest=16)
_GAPS = """CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 < 2 THEN 0 ELSE value END"""
_ORDERED = f"SELECT event_id, event_type, event_timestamp, {_GAPS} AS v FROM ev"


def _with_gaps(f: Feeds) -> DataFrame:
    """Few keys with many rows, and a value with NULLs and zeros."""
    return f.events.select("event_id", "event_type", "event_timestamp", F.expr(_GAPS).alias("v"))


@query(
    "q52_running_sum_sliced",
    f"""SELECT event_id, event_type, round(sum(v) OVER (PARTITION BY event_type ORDER BY event_timestamp, event_id
               ROWS UNBOUNDED PRECEDING), 6) + 0 AS upto FROM ({_ORDERED})""",
)
def sliced_running_sum(f: Feeds) -> DataFrame:
    summed = running_sum(_with_gaps(f), "v", ["event_type"], ["event_timestamp", "event_id"], "upto", TINY)
    return rounded(summed.select("event_id", "event_type", "upto"), "upto", digits=6)


@query(
    "q53_sliding_chunked",
    f"""SELECT event_id, event_type, round(sum(v) OVER w, 6) + 0 AS frame_sum, count(v) OVER w AS frame_count,
               max(v) OVER w AS frame_most FROM ({_ORDERED})
        WINDOW w AS (PARTITION BY event_type ORDER BY event_timestamp, event_id ROWS 29 PRECEDING)""",
)
def chunked_frames(f: Feeds) -> DataFrame:
    frames = {"frame_sum": F.sum("v"), "frame_count": F.count("v"), "frame_most": F.max("v")}
    out = sliding(_with_gaps(f), frames, ["event_type"], ["event_timestamp", "event_id"], 29, TINY)
    return rounded(out.select("event_id", "event_type", *frames), "frame_sum", digits=6)


@query(
    "q55_quantile_narrowed",
    f"""WITH b AS (SELECT quantile_cont(v, 0.01) AS l, quantile_cont(v, 0.99) AS h FROM ({_ORDERED}))
        SELECT event_id, round((greatest(l, least(h, v)) - l) / nullif(h - l, 0), 9) + 0 AS unit FROM ({_ORDERED}), b""",
)
def narrowed_quantiles(f: Feeds) -> DataFrame:
    events = _with_gaps(f)
    units = winsorize_minmax(events, ["v"], scale=TINY)
    return rounded(events.select("event_id", units["v"].alias("unit")), "unit")


@query(
    "q56_travel_hull",
    """WITH p AS (SELECT building_code, date_trunc('month', event_date) AS m, latitude, longitude, row_number() OVER () AS i FROM sv_geo)
       SELECT a.building_code, CAST(a.m AS DATE) AS month, coalesce(max(2 * 6371 * asin(sqrt(
                  pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude))
                  * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)))) > 408, FALSE) AS impossible
       FROM p a LEFT JOIN p b ON a.building_code IS NOT DISTINCT FROM b.building_code AND a.m = b.m AND a.i < b.i
            AND a.latitude IS NOT NULL AND b.latitude IS NOT NULL
       GROUP BY 1, 2""",
)
def travel_of_large_groups(f: Feeds) -> DataFrame:
    """Few groups with many points and a limit near the farthest ones, so that bounds don't settle them."""
    points = f.feed("geo").ok.withColumn("month", F.trunc("event_date", "month"))
    return impossible_travel(points, "building_code", "month", "latitude", "longitude", 408.0)


_RANK = "round((rank() OVER (ORDER BY {x}) + (count(*) OVER (PARTITION BY {x}) - 1) / CAST(2 AS DOUBLE)) / count(*) OVER () * 100, 9)"
_BINS = "CASE WHEN p > 95 THEN 'HIGH' WHEN p > 75 THEN 'MEDIUM' ELSE 'LOW' END"


@query(
    "q29_percentile_tier",
    f"""{_NEAREST}, r AS (SELECT vec_id, {_RANK.format(x="anomaly_score")} AS p FROM s)
        SELECT vec_id, round(p, 9) + 0 AS percentile, {_BINS} AS tier FROM r""",
)
def tiers(f: Feeds) -> DataFrame:
    scored = rounded(labelled_distance(f).select("vec_id", "anomaly_score"), "anomaly_score")
    ranked = percentile_rank_avg(scored, "anomaly_score", "percentile")
    return rounded(ranked.select("vec_id", "percentile", percentile_tier("percentile").alias("tier")), "percentile")


@query(
    "q29b_percentile_ties",
    f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                          {_RANK.format(x="l_quantity")} AS p FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(p, 9) + 0 AS percentile, {_BINS} AS tier FROM r""",
)
def tied_tiers(f: Feeds) -> DataFrame:
    """50 different values over the whole table: almost every rank is shared."""
    lines = f.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    ranked = percentile_rank_avg(lines, "l_quantity", "percentile").drop("l_quantity")
    return rounded(ranked.withColumn("tier", percentile_tier("percentile")), "percentile")


@query(
    "q30_percent_rank_tier",
    """WITH r AS (SELECT event_id, round(percent_rank() OVER (ORDER BY value), 9) AS p FROM events)
       SELECT event_id, round(p, 9) + 0 AS share,
              CASE WHEN p >= 0.95 THEN 'HIGH' WHEN p >= 0.75 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM r""",
)
def share_tiers(f: Feeds) -> DataFrame:
    ranked = percent_rank(f.table("events").select("event_id", "value"), "value", "share").drop("value")
    return rounded(ranked.withColumn("tier", percent_rank_tier("share")), "share")


@query(
    "q32_top_tag_per_week",
    """WITH n AS (SELECT CAST(date_trunc('week', day) AS DATE) AS week_start_date, 'EMP_' || user_id AS employee_id,
                         event_type, count(*) AS n FROM ev GROUP BY 1, 2, 3),
            t AS (SELECT *, row_number() OVER (PARTITION BY week_start_date, employee_id ORDER BY n DESC, event_type) AS rn
                  FROM n)
       SELECT week_start_date, employee_id, event_type AS top_type FROM t WHERE rn = 1""",
)
def top_tag(f: Feeds) -> DataFrame:
    rows = f.events.select(
        week_start(F.to_date("event_timestamp")).alias("week_start_date"),
        name("EMP_", "user_id").alias("employee_id"),
        F.array("event_type").alias("types"),
    )
    return top_item(rows, ["week_start_date", "employee_id"], "types", "top_type")
