"""Model evaluation and decisions on scores made from the orders."""

from pyspark.sql import functions as F

from tallyloom.operators import evaluation as ev
from tallyloom.plans.ordering import exact_quantiles
from tallyloom.queries.registry import query

_SCORED = """
    r AS (SELECT o_orderkey, o_totalprice, o_custkey,
      CASE WHEN o_totalprice <= 150000 THEN 'Low' WHEN o_totalprice <= 350000 THEN 'Medium' ELSE 'High' END AS truth,
      1.0::DOUBLE + (o_custkey % 10) / 3.0 AS a, 1.0::DOUBLE + (o_orderkey % 7) / 2.0 AS b, 1.0::DOUBLE + o_totalprice / 200000.0 AS c FROM orders),
    p AS (SELECT *, a / (a + b + c) AS p_low, b / (a + b + c) AS p_medium, c / (a + b + c) AS p_high FROM r),
    s AS (SELECT *, CASE WHEN p_low >= p_medium AND p_low >= p_high THEN 'Low' WHEN p_medium >= p_high THEN 'Medium' ELSE 'High' END AS predicted,
      greatest(p_low, p_medium, p_high) AS confidence FROM p)"""
_BINARY = """b AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
      ((o_custkey * 37 + o_orderkey * 11) % 1000) / 1000.0 AS score FROM orders)"""
_CLASSES = ["Low", "Medium", "High"]
_THRESHOLDS = [round(0.15 + 0.01 * i, 2) for i in range(60)]
_GRID = "th AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES " + ", ".join(f"({v})" for v in _THRESHOLDS) + ") g(t))"
_SWEEP = f"""{_BINARY}, {_GRID},
    sw AS (SELECT threshold, count(*) FILTER (WHERE score >= threshold) AS flagged,
      CAST(COALESCE(sum(label) FILTER (WHERE score >= threshold), 0) AS BIGINT) AS hits,
      COALESCE(sum(label) FILTER (WHERE score >= threshold), 0) / (SELECT sum(label) FROM b) AS recall FROM th, b GROUP BY threshold)"""


def scored(t):
    price = F.col("o_totalprice")
    rows = t.orders.select(
        "o_orderkey", "o_totalprice", "o_custkey",
        F.when(price <= 150000, "Low").when(price <= 350000, "Medium").otherwise("High").alias("truth"),
        (1.0 + (F.col("o_custkey") % 10) / 3.0).alias("a"),
        (1.0 + (F.col("o_orderkey") % 7) / 2.0).alias("b"),
        (1.0 + price / 200000.0).alias("c"),
    )
    total = F.col("a") + F.col("b") + F.col("c")
    rows = rows.withColumns({"p_low": F.col("a") / total, "p_medium": F.col("b") / total, "p_high": F.col("c") / total})
    low, mid, high = (F.col(f"p_{c.lower()}") for c in _CLASSES)
    predicted = F.when((low >= mid) & (low >= high), "Low").when(mid >= high, "Medium").otherwise("High")
    return rows.withColumns({"predicted": predicted, "confidence": F.greatest(low, mid, high)}).drop("a", "b", "c")


def binary(t):
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        (((F.col("o_custkey") * 37 + F.col("o_orderkey") * 11) % 1000) / 1000.0).alias("score"),
    )


@query("e1_confusion_matrix", f"""
    WITH {_SCORED}, k(c) AS (VALUES ('Low'), ('Medium'), ('High'))
    SELECT x.c AS truth, y.c AS predicted, count(s.truth) AS n FROM k x CROSS JOIN k y
    LEFT JOIN s ON s.truth = x.c AND s.predicted = y.c GROUP BY ALL""")
def confusion_matrix(t):
    return ev.confusion_matrix(scored(t), "truth", "predicted", _CLASSES)


_REPORT = f"""{_SCORED}, k(class) AS (VALUES ('Low'), ('Medium'), ('High')),
    m AS (SELECT class, count(*) FILTER (WHERE truth = class) AS support, count(*) FILTER (WHERE predicted = class) AS predicted,
      count(*) FILTER (WHERE truth = class AND predicted = class) AS tp FROM k, s GROUP BY class),
    q AS (SELECT class, support, predicted, COALESCE(tp / nullif(predicted, 0), 0) AS precision, COALESCE(tp / nullif(support, 0), 0) AS recall FROM m),
    rep AS (SELECT *, COALESCE(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM q)"""


@query("e2_overall_metrics", f"""
    WITH {_REPORT} SELECT round((SELECT avg(CASE WHEN truth = predicted THEN 1.0 ELSE 0.0 END) FROM s), 6) AS accuracy,
      round(avg(recall), 6) AS balanced_accuracy, round(avg(precision), 6) AS macro_precision, round(avg(f1), 6) AS macro_f1 FROM rep""")
def overall_metrics(t):
    found = ev.overall_metrics(scored(t), "truth", "predicted")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query("e3_classification_report", f"""
    WITH {_REPORT} SELECT class, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM rep""")
def classification_report(t):
    found = ev.classification_report(scored(t), "truth", "predicted")
    return found.select("class", "support", "predicted", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("e4_roc_auc", f"""
    WITH {_BINARY}, v AS (SELECT score, count(*) AS n, sum(label) AS pos FROM b GROUP BY score),
      k AS (SELECT *, sum(n) OVER (ORDER BY score) - (n - 1) / 2.0 AS rk FROM v)
    SELECT round((sum(rk * pos) - sum(pos) * (sum(pos) + 1) / 2.0) / (sum(pos) * sum(n - pos)), 6) AS auc FROM k""")
def roc_auc(t):
    return ev.roc_auc(binary(t), "score", "label").select(F.round("auc", 6).alias("auc"))


@query("e5_regression_metrics", """
    WITH m AS (SELECT l_suppkey, avg(l_quantity) AS p FROM lineitem GROUP BY l_suppkey),
         e AS (SELECT l_returnflag, l_quantity AS y, p FROM lineitem JOIN m ON m.l_suppkey = lineitem.l_suppkey)
    SELECT l_returnflag, count(*) AS n, round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse,
      round(1 - avg((p - y) * (p - y)) / var_pop(y), 6) AS r2, round(avg(p - y), 6) AS bias FROM e GROUP BY l_returnflag""")
def regression_metrics(t):
    means = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("p"))
    rows = t.lineitem.join(means, "l_suppkey")
    found = ev.regression_metrics(rows, "l_quantity", "p", ["l_returnflag"])
    return found.select("l_returnflag", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2", "bias")])


@query("e6_adjusted_rand", f"""
    WITH {_SCORED}, c AS (SELECT truth, predicted, count(*)::DOUBLE AS n FROM s GROUP BY ALL),
      x AS (SELECT sum(n * (n - 1) / 2) AS bo, sum(n) * (sum(n) - 1) / 2 AS al FROM c),
      y AS (SELECT sum(n * (n - 1) / 2) AS r FROM (SELECT sum(n) AS n FROM c GROUP BY truth)),
      z AS (SELECT sum(n * (n - 1) / 2) AS k FROM (SELECT sum(n) AS n FROM c GROUP BY predicted))
    SELECT round((bo - r * k / al) / ((r + k) / 2 - r * k / al), 6) AS ari FROM x, y, z""")
def adjusted_rand(t):
    return ev.adjusted_rand_index(scored(t), "truth", "predicted").select(F.round("ari", 6).alias("ari"))


@query("e7_threshold_sweep", f"""
    WITH {_SWEEP} SELECT threshold, flagged, hits, round(recall, 6) AS recall, round(COALESCE(hits / nullif(flagged, 0), 0), 6) AS precision FROM sw""")
def threshold_sweep(t):
    found = ev.threshold_sweep(binary(t), "score", "label", _THRESHOLDS)
    return found.select("threshold", "flagged", "hits", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@query("e7_chosen_threshold", f"""
    WITH {_SWEEP} SELECT 0.8::DOUBLE AS target, COALESCE((SELECT max(threshold) FROM sw WHERE recall >= 0.8),
        (SELECT threshold FROM sw ORDER BY recall DESC, threshold LIMIT 1)) AS threshold
    UNION ALL SELECT 0.99, COALESCE((SELECT max(threshold) FROM sw WHERE recall >= 0.99),
        (SELECT threshold FROM sw ORDER BY recall DESC, threshold LIMIT 1))""")
def chosen_threshold(t):
    sweep = ev.threshold_sweep(binary(t), "score", "label", _THRESHOLDS)
    rows = [ev.choose_threshold(sweep, v).select(F.lit(v).alias("target"), "threshold") for v in (0.8, 0.99)]
    return rows[0].unionByName(rows[1])


@query("e8_precision_recall_table", f"""
    WITH {_BINARY}, v AS (SELECT score, count(*) AS n, sum(label) AS pos FROM b GROUP BY score),
      c AS (SELECT score, sum(n) OVER w AS flagged, sum(pos) OVER w AS hits, sum(pos) OVER () AS al FROM v WINDOW w AS (ORDER BY score DESC))
    SELECT score, CAST(flagged AS BIGINT) AS flagged, CAST(hits AS BIGINT) AS hits, round(hits / flagged, 6) AS precision, round(hits / al, 6) AS recall FROM c""")
def precision_recall_table(t):
    found = ev.precision_recall_curve(binary(t), "score", "label")
    return found.select("score", "flagged", "hits", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("e9_decision_policy", f"""
    WITH {_SCORED} SELECT CASE WHEN p_low >= 0.4 THEN 'Flag Low for Review' WHEN p_high >= 0.45 THEN 'Premium' ELSE 'Standard' END AS decision,
      truth, count(*) AS n FROM s GROUP BY ALL""")
def decision_policy(t):
    choice = ev.decide(F.col("p_low"), F.col("p_high"), 0.4, 0.45)
    return scored(t).groupBy(choice.alias("decision"), "truth").agg(F.count("*").alias("n"))


@query("e9_policy_counts", f"""
    WITH {_SCORED} SELECT count(*) FILTER (WHERE p_high >= 0.45 AND truth = 'High') AS caught,
      count(*) FILTER (WHERE NOT p_high >= 0.45 AND truth = 'High') AS missed, count(*) FILTER (WHERE p_high >= 0.45 AND truth <> 'High') AS false_alarms,
      count(*) FILTER (WHERE p_high >= 0.45) AS flagged,
      round(count(*) FILTER (WHERE p_high >= 0.45 AND truth = 'High') / count(*) FILTER (WHERE p_high >= 0.45), 6) AS precision,
      round(count(*) FILTER (WHERE p_high >= 0.45 AND truth = 'High') / count(*) FILTER (WHERE truth = 'High'), 6) AS recall FROM s""")
def policy_counts(t):
    found = ev.policy_counts(scored(t), F.col("p_high") >= 0.45, F.col("truth") == "High")
    return found.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query("e10_failure_table", f"""
    WITH {_SCORED} SELECT o_orderkey, truth, predicted, confidence, CASE WHEN truth = predicted THEN 'Correct'
      WHEN truth = 'Medium' THEN truth || ' -> ' || predicted || ' (FP)' ELSE truth || ' -> ' || predicted || ' (FN)' END AS error_category FROM s""")
def failure_table(t):
    category = ev.error_category(F.col("truth"), F.col("predicted"), "Low", _CLASSES)
    return scored(t).select("o_orderkey", "truth", "predicted", "confidence", category.alias("error_category"))


@query("e11_error_by_confidence", f"""
    WITH {_SCORED}, x AS (SELECT truth = predicted AS ok, CASE WHEN confidence > 0 AND confidence <= 0.3 THEN '0-30%' WHEN confidence <= 0.5 THEN '30-50%'
      WHEN confidence <= 0.7 THEN '50-70%' WHEN confidence <= 0.8 THEN '70-80%' WHEN confidence <= 0.9 THEN '80-90%' ELSE '90-100%' END AS band FROM s)
    SELECT band, count(*) AS n, round(100 * (1 - avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END)), 6) AS error_rate FROM x GROUP BY band""")
def error_by_confidence(t):
    band = ev.band(
        F.col("confidence"), [0.0, 0.3, 0.5, 0.7, 0.8, 0.9, 1.0], ["0-30%", "30-50%", "50-70%", "70-80%", "80-90%", "90-100%"]
    )
    ok = F.when(F.col("truth") == F.col("predicted"), 1.0).otherwise(0.0)
    return scored(t).groupBy(band.alias("band")).agg(
        F.count("*").alias("n"), F.round(100 * (1 - F.avg(ok)), 6).alias("error_rate")
    )


@query("e11_confident_errors", f"""
    WITH {_SCORED} SELECT o_orderkey, truth, predicted, confidence FROM s WHERE truth <> predicted AND confidence > 0.45""")
def confident_errors(t):
    return scored(t).filter((F.col("truth") != F.col("predicted")) & (F.col("confidence") > 0.45)).select(
        "o_orderkey", "truth", "predicted", "confidence"
    )


@query("e14_model_comparison", """
    WITH f AS (SELECT o_orderpriority AS model, o_orderkey % 5 AS fold, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS score FROM orders GROUP BY ALL),
         m AS (SELECT model, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS sd FROM f GROUP BY model)
    SELECT model, mean, sd, rank() OVER (ORDER BY mean DESC) AS place, mean = (SELECT max(mean) FROM m) AS champion FROM m""")
def model_comparison(t):
    hit = F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)
    folds = t.orders.groupBy(F.col("o_orderpriority").alias("model"), (F.col("o_orderkey") % 5).alias("fold")).agg(F.avg(hit).alias("score"))
    return ev.rank_models(folds, "model", "score")


@query("e15_ablation_verdict", """
    WITH m AS (SELECT event_type AS name, round(avg(value), 4) AS f1, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 4) AS bal FROM events GROUP BY 1),
         d AS (SELECT name, f1 - (SELECT f1 FROM m WHERE name = 'view') AS d_f1, bal - (SELECT bal FROM m WHERE name = 'view') AS d_bal FROM m)
    SELECT name, CASE WHEN name = 'view' THEN 'Reference' WHEN d_f1 >= 0.5 AND d_bal >= -0.01 THEN 'Strong candidate'
       WHEN d_f1 > 0 AND d_f1 < 0.5 THEN 'Marginal gain only' ELSE 'Rejected' END AS verdict FROM d""")
def ablation_verdict(t):
    share = F.when(F.col("value") > 50, 1.0).otherwise(0.0)
    runs = t.events.groupBy(F.col("event_type").alias("name")).agg(
        F.round(F.avg("value"), 4).alias("f1"), F.round(F.avg(share), 4).alias("bal")
    )
    reference = runs.filter(F.col("name") == "view").select(F.struct("f1", "bal").alias("r")).scalar()
    deltas = runs.select("name", (F.col("f1") - reference["f1"]).alias("d_f1"), (F.col("bal") - reference["bal"]).alias("d_bal"))
    return ev.ablation_verdict(deltas, "name", "view", "d_f1", "d_bal", 0.5, -0.01).select("name", "verdict")


@query("e16_residual_range", """
    WITH m AS (SELECT user_id, avg(value) AS p FROM events GROUP BY user_id),
         r AS (SELECT event_id, event_type, p, value - p AS res FROM events JOIN m ON m.user_id = events.user_id),
         q AS (SELECT event_type, quantile_cont(res, 0.1) AS lo, quantile_cont(res, 0.9) AS hi FROM r GROUP BY event_type)
    SELECT event_id, round(p + lo, 4) AS range_low, round(p + hi, 4) AS range_high FROM r JOIN q ON q.event_type = r.event_type""")
def residual_range(t):
    means = t.events.groupBy("user_id").agg(F.avg("value").alias("p"))
    rows = t.events.join(means, "user_id")
    found = ev.residual_range(rows, ["event_type"], "value", "p")
    return found.select("event_id", F.round("range_low", 4).alias("range_low"), F.round("range_high", 4).alias("range_high"))


@query("e17_worst_errors", """
    SELECT event_id, value, abs(value - 50) AS error FROM events ORDER BY error DESC, event_id LIMIT 20""")
def worst_errors(t):
    rows = t.events.select("event_id", "value", F.abs(F.col("value") - 50).alias("error"))
    return rows.orderBy(F.col("error").desc(), "event_id").limit(20)


@query("e17_safety_margin", """
    WITH b AS (SELECT quantile_cont(abs(value - 50), 0.95) AS margin FROM events)
    SELECT event_id, round(value + margin, 4) AS safe_high, round(value - margin, 4) AS safe_low FROM events, b""")
def safety_margin(t):
    errors = t.events.select(F.abs(F.col("value") - 50).alias("error"))
    margin = exact_quantiles(errors, "error", {"margin": 0.95}).scalar()
    return t.events.select(
        "event_id", F.round(F.col("value") + margin, 4).alias("safe_high"), F.round(F.col("value") - margin, 4).alias("safe_low")
    )


@query("e18_success_criteria", f"""
    WITH {_REPORT} SELECT class, 'recall' AS measure, 0.7::DOUBLE AS target, round(recall, 6) AS value, recall > 0.7 AS passed FROM rep WHERE class = 'Low'
    UNION ALL SELECT class, 'precision', 0.3, round(precision, 6), precision > 0.3 FROM rep WHERE class = 'High'""")
def success_criteria(t):
    report = ev.classification_report(scored(t), "truth", "predicted")
    found = ev.check_targets(report, {("Low", "recall"): 0.7, ("High", "precision"): 0.3})
    return found.withColumn("value", F.round("value", 6))


@query("e19_error_explanation", f"""
    WITH {_SCORED}, m AS (SELECT truth AS class, avg(o_totalprice) AS price, avg(o_custkey) AS cust FROM s GROUP BY truth),
      w AS (SELECT s.*, x.price AS tp, x.cust AS tc, y.price AS pp, y.cust AS pc FROM s JOIN m x ON x.class = truth JOIN m y ON y.class = predicted WHERE truth <> predicted)
    SELECT o_orderkey, truth, predicted, 'o_totalprice' AS feature, o_totalprice AS value, abs(o_totalprice - pp) < abs(o_totalprice - tp) AS misleading FROM w
    UNION ALL SELECT o_orderkey, truth, predicted, 'o_custkey', o_custkey, abs(o_custkey - pc) < abs(o_custkey - tc) FROM w""")
def error_explanation(t):
    return ev.explain_errors(scored(t), "o_orderkey", "truth", "predicted", ["o_totalprice", "o_custkey"])


@query("e20_nearest_threshold", f"""
    WITH {_SWEEP} SELECT threshold, flagged, hits, round(recall, 6) AS recall FROM sw ORDER BY abs(threshold - 0.4142), threshold LIMIT 1""")
def nearest_threshold(t):
    sweep = ev.threshold_sweep(binary(t), "score", "label", _THRESHOLDS)
    return ev.nearest_threshold(sweep, "threshold", 0.4142).select("threshold", "flagged", "hits", F.round("recall", 6).alias("recall"))
