"""Feature store and monitoring."""

from pyspark.sql import functions as F

from tallyloom.operators import models as md
from tallyloom.operators import evaluation as ev
from tallyloom.operators import monitoring as mo
from tallyloom.plans.scratch import run_dir
from tallyloom.queries.evaluation import _BINARY, binary
from tallyloom.queries.registry import query
from tallyloom.sources import files

_SPLIT = "2024-01-16"

VIEW_V1 = mo.FeatureView(
    "area_features_v1", "user_id", "ts",
    {
        "hour_of_day": "cast(hour(ts) AS bigint)",
        "day_of_week": "cast(weekday(ts) AS bigint)",
        "is_weekend": "cast(if(weekday(ts) >= 5, 1, 0) AS bigint)",
        "current_count": "value",
        "last_id": "event_id",
    },
)
SERVICE_V0 = mo.FeatureService("demand_v0", VIEW_V1, ["hour_of_day", "day_of_week", "is_weekend"])
SERVICE_V1 = mo.FeatureService("demand_v1", VIEW_V1, [*SERVICE_V0.features, "current_count", "last_id"])


def _halves(t):
    cut = F.lit(_SPLIT).cast("timestamp_ntz")
    return t.events.filter(F.col("ts") < cut), t.events.filter(F.col("ts") >= cut)


def _forecast(t):
    """Readings with the mean of their user as the prediction."""
    means = t.events.groupBy("user_id").agg(F.avg("value").alias("p"))
    return t.events.join(means, "user_id")


_PRED = "f AS (SELECT e.*, p FROM events e JOIN (SELECT user_id, avg(value) AS p FROM events GROUP BY user_id) m ON m.user_id = e.user_id)"


@query("x1_feature_service", """
    SELECT user_id, ts, hour(ts) AS hour_of_day, isodow(ts) - 1 AS day_of_week,
           CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend FROM events""")
def feature_service(t):
    rows = VIEW_V1.select(t.events)
    return rows.select("user_id", "ts", *SERVICE_V0.features)


@query("x2_historical_retrieval", """
    WITH f AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type <> 'purchase'),
         r AS (SELECT event_id AS request_id, user_id, ts AS req_at FROM events WHERE event_type = 'purchase'),
         m AS (SELECT request_id, r.user_id, f.ts, value, row_number() OVER (PARTITION BY request_id ORDER BY f.ts DESC NULLS LAST) AS k, req_at
               FROM r LEFT JOIN f ON f.user_id = r.user_id AND f.ts <= r.req_at)
    SELECT request_id, user_id, CASE WHEN req_at - ts <= INTERVAL 1 DAY THEN value END AS current_count,
      CAST(CASE WHEN req_at - ts <= INTERVAL 1 DAY THEN hour(ts) END AS DOUBLE) AS hour_of_day FROM m WHERE k = 1""")
def historical_retrieval(t):
    requests = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("request_id"), "user_id", F.col("ts").alias("at")
    )
    source = t.events.filter(F.col("event_type") != "purchase")
    found = SERVICE_V1.historical(requests, source, "at", ttl_seconds=86_400)
    return found.select("request_id", "user_id", "current_count", F.col("hour_of_day").cast("double").alias("hour_of_day"))


@query("x3_materialise_online", """
    SELECT user_id, max(ts) AS ts, hour(max(ts)) AS hour_of_day, isodow(max(ts)) - 1 AS day_of_week,
      CAST(CASE WHEN isodow(max(ts)) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend, arg_max(value, ts) AS current_count,
      arg_max(event_id, ts) AS last_id FROM events GROUP BY user_id""")
def materialise_online(t):
    return SERVICE_V1.materialise(t.events)


@query("x4_online_retrieval", """
    WITH s AS (SELECT user_id, arg_max(value, ts) AS v, hour(max(ts)) AS h FROM events GROUP BY user_id)
    SELECT c_custkey, v AS current_count, CAST(h AS DOUBLE) AS hour_of_day FROM customer LEFT JOIN s ON s.user_id = c_custkey % 200""")
def online_retrieval(t):
    store = SERVICE_V1.materialise(t.events)
    requests = t.customer.select("c_custkey", (F.col("c_custkey") % 200).alias("user_id"))
    found = SERVICE_V1.online(requests, store)
    return found.select("c_custkey", "current_count", F.col("hour_of_day").cast("double").alias("hour_of_day"))


@query("x5_skew_check", """
    WITH a AS (SELECT user_id, arg_max(value, ts) AS v, arg_max(event_id, ts) AS i FROM events GROUP BY user_id),
         b AS (SELECT user_id, arg_max(value, ts) AS v, arg_max(event_id, ts) AS i FROM events WHERE event_type <> 'view' GROUP BY user_id),
         j AS (SELECT a.v AS av, b.v AS bv, a.i AS ai, b.i AS bi FROM a FULL JOIN b ON a.user_id = b.user_id)
    SELECT count(*) AS entities, 'current_count' AS feature, count(*) FILTER (WHERE av IS DISTINCT FROM bv) AS mismatches FROM j
    UNION ALL SELECT count(*), 'last_id', count(*) FILTER (WHERE ai IS DISTINCT FROM bi) FROM j""")
def skew_check(t):
    offline = SERVICE_V1.materialise(t.events)
    online = SERVICE_V1.materialise(t.events.filter(F.col("event_type") != "view"))
    return mo.skew_check(offline, online, "user_id", ["current_count", "last_id"], 1e-9)


@query("x6_feature_freshness", """
    WITH h AS (SELECT ts, CASE WHEN event_id % 6 <> 0 THEN value END AS current_count, CASE WHEN event_id % 9 <> 0 THEN user_id END AS area FROM events)
    SELECT feature, latest, round((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(latest)) / 60000000.0, 4) AS age_minutes, round(r, 6) AS null_rate FROM (
      SELECT 'current_count' AS feature, max(ts) AS latest, avg(CASE WHEN current_count IS NULL THEN 1.0 ELSE 0.0 END) AS r FROM h
      UNION ALL SELECT 'area', max(ts), avg(CASE WHEN area IS NULL THEN 1.0 ELSE 0.0 END) FROM h)""")
def feature_freshness(t):
    rows = t.events.select(
        "ts", F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("current_count"),
        F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("area"),
    )
    found = mo.feature_freshness(rows, "ts", ["current_count", "area"], "2024-02-01")
    return found.withColumns({"age_minutes": F.round("age_minutes", 4), "null_rate": F.round("null_rate", 6)})


@query("x7_numeric_drift", f"""
    WITH a AS (SELECT value FROM events WHERE ts < TIMESTAMP '{_SPLIT}'), b AS (SELECT value FROM events WHERE ts >= TIMESTAMP '{_SPLIT}'),
      q AS (SELECT quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e FROM a),
      h AS (SELECT k, (SELECT count(*) FROM a, q WHERE len(list_filter(e[2:10], lambda x: value > x)) = k) AS r,
                      (SELECT count(*) FROM b, q WHERE len(list_filter(e[2:10], lambda x: value > x)) = k) AS c FROM range(10) g(k)),
      s AS (SELECT k, greatest(r / sum(r) OVER (), 1e-6) AS r, greatest(c / sum(c) OVER (), 1e-6) AS c,
              sum(r) OVER (ORDER BY k) / sum(r) OVER () AS fr, sum(c) OVER (ORDER BY k) / sum(c) OVER () AS fc FROM h)
    SELECT round(sum((c - r) * ln(c / r)), 6) AS psi, round(sum(c * ln(c / r)), 6) AS kl,
      round(sum((c * ln(c / ((c + r) / 2)) + r * ln(r / ((c + r) / 2))) / 2), 6) AS js,
      round(sum(abs(fc - fr) * (e[k + 2] - e[k + 1])), 4) AS wasserstein,
      round(((SELECT avg(value) FROM b) - (SELECT avg(value) FROM a)) / (SELECT stddev_samp(value) FROM a), 6) AS z FROM s, q""")
def numeric_drift(t):
    found = mo.numeric_drift(*_halves(t), "value")
    return found.select(*[F.round(c, 6).alias(c) for c in ("psi", "kl", "js", "z")], F.round("wasserstein", 4).alias("wasserstein"))


@query("x8_category_shift", """
    WITH a AS (SELECT source, count(*) / (SELECT count(*) FROM documents WHERE lang = 'en') AS r FROM documents WHERE lang = 'en' GROUP BY source),
         b AS (SELECT source, count(*) / (SELECT count(*) FROM documents WHERE lang <> 'en') AS c FROM documents WHERE lang <> 'en' GROUP BY source)
    SELECT COALESCE(a.source, b.source) AS source, round(COALESCE(r, 0), 6) AS reference_share, round(COALESCE(c, 0), 6) AS current_share,
      round(COALESCE(c, 0) - COALESCE(r, 0), 6) AS shift, CASE WHEN r IS NULL THEN 'new' WHEN c IS NULL THEN 'gone' ELSE 'kept' END AS status
    FROM a FULL JOIN b ON a.source = b.source""")
def category_shift(t):
    english = F.col("lang") == "en"
    found = mo.category_shift(t.documents.filter(english), t.documents.filter(~english), "source")
    return found.withColumns({c: F.round(c, 6) for c in ("reference_share", "current_share", "shift")})


@query("x9_prediction_drift", """
    SELECT hour(ts) AS hour, count(*) AS n, round(avg(value), 4) AS mean, round(var_samp(value), 4) AS variance,
      round(avg(CASE WHEN value >= 100 THEN 1.0 ELSE 0.0 END), 6) AS high_share FROM events GROUP BY 1""")
def prediction_drift(t):
    found = mo.prediction_drift(t.events, [F.hour("ts").cast("long").alias("hour")], "value", 100.0)
    return found.select(
        "hour", "n", F.round("mean", 4).alias("mean"), F.round("variance", 4).alias("variance"), F.round("high_share", 6).alias("high_share")
    )


@query("x10_performance_slices", f"""
    WITH {_PRED} SELECT event_type, CAST(hour(ts) AS DOUBLE) AS hour, count(*) AS n, round(avg(abs(p - value)), 4) AS mae,
      round(sqrt(avg((p - value) * (p - value))), 4) AS rmse, round(avg(CASE WHEN value <> 0 THEN abs((p - value) / value) END), 4) AS mape,
      round(sum(abs(p - value)) / sum(abs(value)), 6) AS wape, round(avg(p) - avg(value), 4) AS bias,
      round(avg(CASE WHEN p < value THEN 1.0 ELSE 0.0 END), 6) AS under_rate, round(avg(CASE WHEN p > value THEN 1.0 ELSE 0.0 END), 6) AS over_rate
    FROM f GROUP BY GROUPING SETS ((), (event_type), (hour(ts)))""")
def performance_slices(t):
    rows = _forecast(t).withColumn("hour", F.hour("ts").cast("double"))
    found = mo.performance_slices(rows, ["event_type", "hour"], "value", "p")
    digits = {"mae": 4, "rmse": 4, "mape": 4, "wape": 6, "bias": 4, "under_rate": 6, "over_rate": 6}
    return found.withColumns({
        c: F.when(F.round(c, d) == 0, 0.0).otherwise(F.round(c, d)) for c, d in digits.items()
    })


@query("x11_calibration", f"""
    WITH {_BINARY} SELECT CAST(least(floor(score * 10), 9) AS BIGINT) AS band, count(*) AS n, round(avg(score), 6) AS mean_score,
      round(avg(label), 6) AS rate FROM b GROUP BY 1""")
def calibration(t):
    found = mo.calibration_table(binary(t), "score", "label")
    return found.select("band", "n", F.round("mean_score", 6).alias("mean_score"), F.round("rate", 6).alias("rate"))


@query("x11_probability_scores", f"""
    WITH {_BINARY}, c AS (SELECT *, greatest(least(score, 1 - 1e-15), 1e-15) AS q FROM b)
    SELECT round(avg((score - label) * (score - label)), 6) AS brier, round(avg(-(label * ln(q) + (1 - label) * ln(1 - q))), 4) AS log_loss FROM c""")
def probability_scores(t):
    found = mo.probability_scores(binary(t), "score", "label")
    return found.select(F.round("brier", 6).alias("brier"), F.round("log_loss", 4).alias("log_loss"))


@query("x11_ks", f"""
    WITH {_BINARY}, v AS (SELECT score, sum(label) AS p, count(*) - sum(label) AS n FROM b GROUP BY score),
      c AS (SELECT sum(p) OVER (ORDER BY score) / sum(p) OVER () AS fp, sum(n) OVER (ORDER BY score) / sum(n) OVER () AS fn FROM v)
    SELECT round(max(abs(fp - fn)), 6) AS ks FROM c""")
def ks(t):
    return ev.ks_statistic(binary(t), "score", "label").select(F.round("ks", 6).alias("ks"))


@query("x12_fairness", f"""
    WITH {_BINARY}, g AS (SELECT c_mktsegment, label, score >= 0.5 AS ok FROM b JOIN orders o ON o.o_orderkey = b.o_orderkey JOIN customer ON c_custkey = o_custkey),
      r AS (SELECT c_mktsegment, count(*) AS n, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS a,
        avg(CASE WHEN label = 0 THEN CASE WHEN ok THEN 1.0 ELSE 0.0 END END) AS p, avg(CASE WHEN label = 1 THEN CASE WHEN ok THEN 0.0 ELSE 1.0 END END) AS f FROM g GROUP BY 1)
    SELECT c_mktsegment, n, round(a, 6) AS approval_rate, round(p, 6) AS fpr, round(f, 6) AS fnr, round(a / (SELECT max(a) FROM r), 6) AS impact_ratio,
      round(p - (SELECT min(p) FROM r), 6) AS fpr_gap, round(f - (SELECT min(f) FROM r), 6) AS fnr_gap FROM r""")
def fairness(t):
    rows = binary(t).join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey").join(
        t.customer, F.col("o_custkey") == F.col("c_custkey"))
    found = mo.fairness(rows, "c_mktsegment", F.col("score") >= 0.5, "label")
    return found.select("c_mktsegment", "n", *[F.round(c, 6).alias(c) for c in found.columns[2:]])


@query("x13_prediction_log", """
    SELECT event_id AS request_id, 'model-1' AS model_version, 'demand_v1' AS feature_service, value AS prediction,
      user_id AS input_user, CAST(hour(ts) AS BIGINT) AS input_hour FROM events""")
def prediction_log(t):
    path = run_dir(t.spark, "prediction-log")
    entries = t.events.select(
        F.col("event_id").alias("request_id"), F.col("ts").alias("predicted_at"),
        F.struct(F.lit("model-1").alias("version"), F.lit(SERVICE_V1.name).alias("feature_service")).alias("model"),
        F.struct("user_id", F.hour("ts").cast("long").alias("hour")).alias("inputs"), F.col("value").alias("prediction"),
    )
    files.append_json_lines(entries, path)
    log = files.read_json_lines(t.spark, path, entries.schema)
    return log.select(
        "request_id", F.col("model.version").alias("model_version"), F.col("model.feature_service").alias("feature_service"),
        "prediction", F.col("inputs.user_id").alias("input_user"), F.col("inputs.hour").alias("input_hour"),
    )


@query("x14_retrain_trigger", f"""
    WITH {_PRED}, h AS (SELECT date_trunc('hour', ts) AS hour, round(avg(abs(p - value)), 6) AS mae FROM f GROUP BY 1),
      w AS (SELECT hour, avg(mae) OVER (ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) > 38 AS over_limit FROM h),
      g AS (SELECT hour, over_limit, row_number() OVER (ORDER BY hour) - sum(CASE WHEN over_limit THEN 1 ELSE 0 END) OVER (ORDER BY hour) AS run FROM w)
    SELECT CAST(min(hour) AS TIMESTAMP) AS start, CAST(max(hour) AS TIMESTAMP) AS "end", count(*) AS hours FROM g WHERE over_limit GROUP BY run HAVING count(*) >= 3""")
def retrain_trigger(t):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")
    hourly = _forecast(t).groupBy(hour).agg(F.round(F.avg(F.abs(F.col("p") - F.col("value"))), 6).alias("mae"))
    return mo.retrain_runs(hourly, "hour", "mae", 3, 38.0, 3)


@query("x15_champion_candidate", f"""
    WITH {_PRED}, g AS (SELECT avg(value) AS m FROM events)
    SELECT event_type, count(*) AS n, round(avg(abs(p - value)), 6) AS champion, round(avg(abs(m - value)), 6) AS candidate,
      CASE WHEN avg(abs(p - value)) <= avg(abs(m - value)) THEN 'champion' ELSE 'candidate' END AS best FROM f, g GROUP BY event_type""")
def champion_candidate(t):
    overall = t.events.agg(F.avg("value").alias("m")).scalar()
    rows = _forecast(t).withColumn("q", overall)
    found = mo.compare_models(rows, "value", {"champion": "p", "candidate": "q"}, ["event_type"])
    return found.withColumns({c: F.round(c, 6) for c in ("champion", "candidate")})


@query("x15_canary_split", """
    SELECT count(*) AS n, count(DISTINCT user_id) AS users, true AS stable, true AS near_tenth FROM events""")
def canary_split(t):
    """A stable tenth of the users goes to the candidate."""
    arm = mo.canary_split("user_id", 10)
    per_user = t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct(arm).alias("arms"), F.max(arm == "candidate").alias("moved"))
    return per_user.agg(
        F.sum("n").alias("n"), F.count("*").alias("users"), (F.max("arms") == 1).alias("stable"),
        F.avg(F.col("moved").cast("double")).between(0.02, 0.25).alias("near_tenth"))


@query("x16_dataset_versions", """
    WITH r AS (SELECT l_suppkey AS run_id, 'data_' || l_returnflag AS data_version, 'features_' || l_linestatus AS feature_version,
       round(avg(abs(l_quantity - 25)), 6) AS mae FROM lineitem GROUP BY ALL)
    SELECT data_version, feature_version, count(*) AS runs, round(avg(mae), 5) AS mean_metric, min(mae) AS best_metric,
      arg_min(run_id, (mae, run_id)) AS best_run FROM r GROUP BY ALL""")
def dataset_versions(t):
    runs = t.lineitem.groupBy(
        F.col("l_suppkey").alias("run_id"), F.concat(F.lit("data_"), "l_returnflag").alias("data_version"),
        F.concat(F.lit("features_"), "l_linestatus").alias("feature_version"),
    ).agg(F.round(F.avg(F.abs(F.col("l_quantity") - 25)), 6).alias("mae"))
    found = mo.best_runs(runs, ["data_version", "feature_version"], "mae", "run_id")
    return found.withColumn("mean_metric", F.round("mean_metric", 5))


@query("x17_recalibration", f"""
    WITH {_BINARY} SELECT method, (SELECT round(avg((score - label) * (score - label)), 6) FROM b) AS raw_brier, true AS no_worse
    FROM (VALUES ('platt'), ('isotonic')) g(method)""")
def recalibration(t):
    """Both curves, fitted on one half of the orders and judged on the other, in turn, bring the Brier score to or below that of the raw score."""
    rows, half = binary(t), F.col("o_orderkey") % 2

    def judged(k: int):
        fitted = rows.filter(half != k)
        platt = md.platt_scale(fitted, rows.filter(half == k), "score", "label", "platt")
        return md.isotonic_scale(fitted, platt, "score", "label", "isotonic")

    both = judged(0).unionByName(judged(1))
    briers = {m: F.avg((F.col(m) - F.col("label")) ** 2) for m in ("score", "platt", "isotonic")}
    wide = both.agg(*[b.alias(m) for m, b in briers.items()])
    long = wide.unpivot(["score"], ["platt", "isotonic"], "method", "brier")
    return long.select("method", F.round("score", 6).alias("raw_brier"), (F.col("brier") <= F.col("score")).alias("no_worse"))


@query("x18_stale_fallback", """
    WITH m AS (SELECT event_type, avg(value) AS b FROM events GROUP BY event_type),
      r AS (SELECT event_id, event_type, CASE WHEN event_id % 10 <> 0 THEN value END AS pred, CAST(user_id AS DOUBLE) AS age FROM events)
    SELECT event_id, round(CASE WHEN pred IS NULL OR age > 100 THEN b ELSE pred END, 4) AS served, pred IS NULL OR age > 100 AS degraded
    FROM r JOIN m ON m.event_type = r.event_type""")
def stale_fallback(t):
    baseline = t.events.groupBy("event_type").agg(F.avg("value").alias("b"))
    rows = t.events.join(baseline, "event_type").withColumn("pred", F.when(F.col("event_id") % 10 != 0, F.col("value")))
    found = mo.stale_fallback(rows, "pred", F.col("user_id").cast("double"), 100.0, "b")
    return found.select("event_id", F.round("served", 4).alias("served"), "degraded")
