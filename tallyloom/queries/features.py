"""Feature preparation."""

from pyspark.sql import functions as F

from tallyloom.operators import aggregates as ag
from tallyloom.operators import features as ft
from tallyloom.operators import neighbours as nb
from tallyloom.operators.estimators import GroupMedianImputer
from tallyloom.plans import timejoin
from tallyloom.queries.quality import _HOLES, with_holes
from tallyloom.queries.registry import query

_ORDER = "(o_orderkey * 7919) % 10007"


def _order():
    return ((F.col("o_orderkey") * 7919) % 10007).cast("double")


@query("m1_stratified_split", f"""
    WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_ORDER}, o_orderkey) AS rn,
      count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderkey, CASE WHEN rn <= floor(0.7::DOUBLE * n + 1e-9) THEN 'train'
      WHEN rn <= floor((0.7::DOUBLE + 0.15::DOUBLE) * n + 1e-9) THEN 'valid' ELSE 'test' END AS part FROM r""")
def stratified_split(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return ft.stratified_split(
        rows, "o_orderstatus", _order(), "o_orderkey", {"train": 0.7, "valid": 0.15, "test": 0.15}
    ).select("o_orderkey", "part")


def _train(rows):
    return rows.filter(F.col("o_orderpriority") != "5-LOW")


@query("m2_imputer_fit_on_train", f"""
    WITH h AS ({_HOLES}), tr AS (SELECT * FROM h WHERE o_orderpriority <> '5-LOW'),
      md AS (SELECT status FROM tr WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)
    SELECT o_orderkey, round(COALESCE(price, (SELECT median(price) FROM tr)), 4) AS price, COALESCE(status, (SELECT status FROM md)) AS status FROM h""")
def imputer_fit_on_train(t):
    rows = with_holes(t)
    fitted = ft.fit_imputer(_train(rows), ["price"], ["status"])
    return ft.apply_imputer(rows, fitted).select("o_orderkey", F.round("price", 4).alias("price"), "status")


@query("m3_scaling", """
    WITH tr AS (SELECT l_extendedprice AS x FROM lineitem WHERE l_returnflag <> 'N'),
      s AS (SELECT avg(x) AS m, stddev_pop(x) AS sd, min(x) AS lo, max(x) AS hi, median(x) AS md,
              quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM tr)
    SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / sd, 5) AS standard, round((l_extendedprice - lo) / (hi - lo), 5) AS minmax,
      round((l_extendedprice - md) / iqr, 5) AS robust FROM lineitem, s""")
def scaling(t):
    train = t.lineitem.filter(F.col("l_returnflag") != "N")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        *[F.round(ft.scale(t.lineitem, train, "l_extendedprice", m), 5).alias(m) for m in ("standard", "minmax", "robust")],
    )


@query("m4_one_hot", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS "o_orderpriority_1-URGENT",
      CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS "o_orderpriority_2-HIGH",
      CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS "o_orderpriority_3-MEDIUM",
      CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS "o_orderpriority_4-NOT SPECIFIED" FROM orders""")
def one_hot(t):
    """5-LOW is unknown to the training rows."""
    known = ft.fit_categories(_train(t.orders), "o_orderpriority")
    return ft.one_hot(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", known).drop("o_orderpriority")


@query("m5_label_encoding", """
    SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS brand_code,
      CAST(CASE p_type WHEN 'SMALL' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LARGE' THEN 2 END AS DOUBLE) AS size_code FROM part""")
def label_encoding(t):
    rows = t.part.withColumn("size_code", ft.ordinal(F.col("p_type"), ["SMALL", "MEDIUM", "LARGE"]))
    return ft.label_codes(rows, "p_brand", "brand_code").select("p_partkey", "brand_code", "size_code")


@query("m6_target_binning", """
    SELECT p_partkey, CASE WHEN p_size <= 4 THEN 'Low' WHEN p_size <= 36 THEN 'Medium' ELSE 'High' END AS class FROM part""")
def target_binning(t):
    return t.part.select("p_partkey", ft.bin_class(F.col("p_size"), [4, 36], ["Low", "Medium", "High"]).alias("class"))


@query("m7_constructed_features", """
    SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber + 1 AS family, CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS is_alone,
      round(sqrt(l_discount * l_discount + l_tax * l_tax), 6) AS distance, round(l_quantity * l_discount, 6) AS interaction FROM lineitem""")
def constructed_features(t):
    d, x = F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") + F.col("l_linenumber") + 1).alias("family"),
        F.when(F.col("l_linenumber") == 1, 1).otherwise(0).alias("is_alone"),
        F.round(F.sqrt(d * d + x * x), 6).alias("distance"), F.round(F.col("l_quantity") * d, 6).alias("interaction"),
    )


_CHI_FEATURES = {
    "urgent": "o_orderpriority = '1-URGENT'", "high": "o_orderpriority = '2-HIGH'", "low": "o_orderpriority = '5-LOW'",
    "cheap": "o_totalprice < 100000", "dear": "o_totalprice > 400000", "early": "o_custkey % 3 = 0",
}
_CHI = "WITH f AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, " + ", ".join(
    f"CAST(CASE WHEN {e} THEN 1 ELSE 0 END AS DOUBLE) AS {n}" for n, e in _CHI_FEATURES.items()) + """ FROM orders),
    l AS (UNPIVOT f ON """ + ", ".join(_CHI_FEATURES) + """ INTO NAME feature VALUE v),
    o AS (SELECT feature, y, sum(v) AS obs, count(*) AS n FROM l GROUP BY ALL),
    e AS (SELECT feature, obs, sum(obs) OVER (PARTITION BY feature) * n / sum(n) OVER (PARTITION BY feature) AS ex FROM o),
    c AS (SELECT feature, sum((obs - ex) * (obs - ex) / ex) AS chi2 FROM e GROUP BY feature)"""


def _chi_rows(t):
    label = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y")
    return t.orders.select(label, *[F.expr(f"CASE WHEN {e} THEN 1 ELSE 0 END").alias(n) for n, e in _CHI_FEATURES.items()])


@query("m8_chi_square", _CHI + " SELECT feature, round(chi2, 5) AS chi2 FROM c")
def chi_square(t):
    return ft.chi_square_scores(_chi_rows(t), "y", list(_CHI_FEATURES)).select("feature", F.round("chi2", 5).alias("chi2"))


@query("m8_select_top_percent", _CHI + " SELECT feature, round(chi2, 5) AS chi2 FROM c ORDER BY chi2 DESC, feature LIMIT 3")
def select_top_percent(t):
    scores = ft.chi_square_scores(_chi_rows(t), "y", list(_CHI_FEATURES))
    return ft.select_top_percent(scores, 50).select("feature", F.round("chi2", 5).alias("chi2"))


@query("m9_smote", """
    WITH c AS (SELECT count(*) FILTER (WHERE quality = 0) AS m, count(*) FILTER (WHERE quality = 1) AS o FROM labels JOIN documents USING (doc_id))
    SELECT 0 AS quality, o - m AS n, true AS between_parents FROM c""")
def smote(t):
    """Size of the synthetic set; each value lies between its parents."""
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("chars"), F.length(F.trim("text")).cast("double").alias("length"))
    made = nb.smote(rows, "doc_id", "quality", 0, ["chars", "length"], 5, 42)
    a = rows.select(F.col("doc_id").alias("base_id"), F.col("chars").alias("c0"))
    b = rows.select(F.col("doc_id").alias("neighbour"), F.col("chars").alias("c1"))
    low, high = F.least("c0", "c1"), F.greatest("c0", "c1")
    return made.join(a, "base_id").join(b, "neighbour").groupBy("quality").agg(
        F.count("*").alias("n"), F.bool_and(F.col("chars").between(low - 1e-9, high + 1e-9)).alias("between_parents"))


@query("m12_redundant_features", """
    WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS a, abs(corr(l_quantity, l_quantity * 2 + l_discount)) AS b,
       abs(corr(l_extendedprice, l_quantity * 2 + l_discount)) AS c FROM lineitem),
      p AS (SELECT 'l_extendedprice' AS feature, a AS r FROM r UNION ALL SELECT 'twice', b FROM r UNION ALL SELECT 'twice', c FROM r)
    SELECT feature, round(max(r), 6) AS strongest FROM p WHERE r > 0.95 GROUP BY feature""")
def redundant_features(t):
    rows = t.lineitem.select("l_quantity", "l_extendedprice", (F.col("l_quantity") * 2 + F.col("l_discount")).alias("twice"))
    pairs = ag.correlations(rows, ["l_quantity", "l_extendedprice", "twice"])
    return ft.redundant_features(pairs, 0.95).withColumn("strongest", F.round("strongest", 6))


@query("m13_winsorize", """
    SELECT event_id, round(least(value, (SELECT quantile_cont(value, 0.95) FROM events)), 4) AS capped FROM events""")
def winsorize(t):
    return ft.winsorize(t.events, "value", 0.95, "capped").select("event_id", F.round("capped", 4).alias("capped"))


@query("m14_noise_injection", "SELECT level::DOUBLE AS level, (SELECT count(*) FROM orders) AS n, true AS as_strong_as_asked FROM (VALUES (0.04), (0.12)) g(level)")
def noise_injection(t):
    """Deviation of the added noise against the level, within a twentieth."""
    rows = t.orders.select("o_orderkey", "o_totalprice")
    out = None
    for level in (0.04, 0.12):
        noisy = ft.add_noise(rows, ["o_totalprice"], level, 7, "o_orderkey").withColumnRenamed("o_totalprice", "noisy")
        row = noisy.join(rows, "o_orderkey").agg(
            F.count("*").alias("n"), F.stddev_pop(F.col("noisy") - F.col("o_totalprice")).alias("noise"), F.stddev_pop("o_totalprice").alias("sd"))
        near = F.abs(F.col("noise") / F.col("sd") / level - 1) < 0.05
        row = row.select(F.lit(level).alias("level"), "n", near.alias("as_strong_as_asked"))
        out = row if out is None else out.unionByName(row)
    return out


@query("m15_class_weights", """
    WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
    SELECT doc_id, l.quality, (SELECT sum(n) / count(*) FROM c) / c.n AS weight FROM labels l JOIN c ON c.quality = l.quality""")
def class_weights(t):
    return ft.class_weights(t.labels.select("doc_id", "quality"), "quality").select("doc_id", "quality", "weight")


@query("m16_dev_sample", f"""
    WITH r AS (SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_ORDER}, o_orderkey) AS rn,
      count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderstatus, count(*) AS kept FROM r WHERE rn <= floor(0.2::DOUBLE * n + 1e-9) GROUP BY o_orderstatus""")
def dev_sample(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    split = ft.stratified_split(rows, "o_orderstatus", _order(), "o_orderkey", {"dev": 0.2, "rest": 0.8})
    return split.filter(F.col("part") == "dev").groupBy("o_orderstatus").agg(F.count("*").alias("kept"))


@query("m17_time_decay_weight", """
    SELECT event_id, round(exp(-ln(2.0::DOUBLE) * ((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 86400000000.0) / 7.0), 8) AS weight FROM events""")
def time_decay_weight(t):
    now = timejoin.micros(F.lit("2024-01-31").cast("timestamp_ntz"))
    age = (now - timejoin.micros("ts")) / F.lit(86_400e6)
    return t.events.select("event_id", F.round(ft.decay_weight(age, 7.0), 8).alias("weight"))


@query("m18_target_encoding", """
    WITH r AS (SELECT event_id, event_type, event_id % 5 AS fold, value FROM events),
      c AS (SELECT event_type, fold, sum(value) AS s, count(*) AS n FROM r GROUP BY ALL),
      g AS (SELECT c.event_type, c.fold, sum(o.s) AS s, sum(o.n) AS n FROM c JOIN c o ON o.event_type = c.event_type AND o.fold <> c.fold GROUP BY ALL),
      p AS (SELECT f.fold, sum(o.s) / sum(o.n) AS prior FROM (SELECT DISTINCT fold FROM c) f JOIN c o ON o.fold <> f.fold GROUP BY f.fold)
    SELECT event_id, round((g.s + 10 * prior) / (g.n + 10), 4) AS encoded FROM r JOIN g ON g.event_type = r.event_type AND g.fold = r.fold JOIN p ON p.fold = r.fold""")
def target_encoding(t):
    rows = t.events.select("event_id", "event_type", (F.col("event_id") % 5).alias("fold"), "value")
    found = ft.target_encode(rows, "event_type", "value", "fold", 10.0, "encoded")
    return found.select("event_id", F.round("encoded", 4).alias("encoded"))


@query("k5_fit_transform", f"""
    WITH h AS ({_HOLES}), tr AS (SELECT * FROM h WHERE o_orderpriority <> '5-LOW'),
      g AS (SELECT o_orderpriority, median(price) AS m FROM tr GROUP BY o_orderpriority)
    SELECT o_orderkey, round(COALESCE(price, m, (SELECT median(price) FROM tr)), 4) AS filled
    FROM h LEFT JOIN g ON g.o_orderpriority = h.o_orderpriority""")
def fit_transform(t):
    rows = with_holes(t)
    model = GroupMedianImputer(["o_orderpriority"], "price", "filled").fit(_train(rows))
    return model.transform(rows).select("o_orderkey", F.round("filled", 4).alias("filled"))
