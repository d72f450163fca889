"""Models, clustering and neighbours."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyloom.functions import vectors
from tallyloom.operators import clustering as cl
from tallyloom.operators import density
from tallyloom.operators import evaluation as ev
from tallyloom.operators import features as ft
from tallyloom.operators import kernels
from tallyloom.operators import models as md
from tallyloom.operators import monitoring as mo
from tallyloom.operators import neighbours as nb
from tallyloom.plans import timejoin
from tallyloom.queries.registry import query

_NUMERIC = ["price", "activity"]
_CATEGORICAL = ["o_orderpriority", "o_orderstatus"]


def training_rows(t):
    """Orders with a class that follows from price and activity, plus noise."""
    price, activity = F.col("o_totalprice") / 100000.0, (F.col("o_custkey") % 100) / 50.0
    noise = (F.col("o_orderkey") * 7919 % 1009) / 1009.0
    return t.orders.select(
        "o_orderkey", price.alias("price"), activity.alias("activity"), *_CATEGORICAL,
        F.when(price + activity + noise > 4.2, 1.0).otherwise(0.0).alias("label"),
        (F.col("o_orderkey") * 7919 % 5).cast("int").alias("fold"),
    )


_TRAIN = """tr AS (SELECT o_orderkey, o_totalprice / 100000.0 AS price, o_orderpriority, o_orderstatus, CASE WHEN o_totalprice / 100000.0 + (o_custkey % 100) / 50.0
      + (o_orderkey * 7919 % 1009) / 1009.0 > 4.2 THEN 1.0 ELSE 0.0 END AS label, (o_orderkey * 7919) % 5 AS fold FROM orders),
    held AS (SELECT round(greatest(avg(label), 1 - avg(label)), 6) AS majority FROM tr WHERE fold = 0),
    every AS (SELECT round(greatest(avg(label), 1 - avg(label)), 6) AS majority FROM tr)"""


def _majority(rows):
    """Accuracy of always saying the larger class: the floor for a model."""
    one = F.avg("label")
    return rows.agg(F.round(F.greatest(one, 1 - one), 6).alias("majority")).scalar()


def _stages():
    return md.preprocessing(_NUMERIC, _CATEGORICAL)


def _numeric_rows(t):
    return VectorAssembler(inputCols=_NUMERIC, outputCol="features").transform(training_rows(t))


def _with_stages(estimator):
    return Pipeline(stages=[*_stages(), estimator])


@query("m10_preprocessing_pipeline", f"""
    WITH {_TRAIN}, st AS (SELECT avg(price) AS m, stddev_samp(price) AS sd FROM tr WHERE fold <> 0)
    SELECT fold = 0 AS held_out, count(*) AS n, CAST(2 + (SELECT count(DISTINCT o_orderpriority) + count(DISTINCT o_orderstatus) FROM orders) AS INTEGER) AS size,
      round(avg((price - m) / sd), 3) + 0.0 AS mean FROM tr, st GROUP BY 1""")
def preprocessing_pipeline(t):
    """Vector length and mean of the scaled price, fitted on the training folds."""
    rows = training_rows(t)
    model = Pipeline(stages=_stages()).fit(rows.filter("fold <> 0"))
    out = model.transform(rows).select("fold", F.size(vector_to_array("features")).alias("size"), vector_to_array("features")[0].alias("x"))
    return out.groupBy((F.col("fold") == 0).alias("held_out")).agg(
        F.count("*").alias("n"), F.max("size").alias("size"), (F.round(F.avg("x"), 3) + 0.0).alias("mean"))


@query("m11_pca", """
    SELECT CAST(c AS INTEGER) AS component, (SELECT CAST(max(len(embedding)) AS BIGINT) FROM embeddings) AS dimensions, 1.0::DOUBLE AS norm, true AS explains FROM range(2) g(c)""")
def pca(t):
    """Unit-length loadings, and a share of the variance above an even one."""
    rows = t.embeddings.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    found = md.pca_loadings(md.pca(rows, "v", 2), t.spark)
    return found.groupBy("component").agg(
        F.count("*").alias("dimensions"), F.round(F.sum(F.col("loading") ** 2), 6).alias("norm"),
        ((F.max("explained") > 1.0 / F.count("*")) & (F.max("explained") < 1)).alias("explains"))


@query("m20_impurity_table", """
    WITH f AS (SELECT o_orderstatus AS y, o_orderpriority AS priority, CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS price FROM orders),
      c AS (SELECT 'priority' AS feature, priority AS value, y, count(*) AS c FROM f GROUP BY ALL UNION ALL SELECT 'price', price, y, count(*) FROM f GROUP BY ALL),
      n AS (SELECT feature, value, sum(c) AS n, 1 - sum((c / t) * (c / t)) AS gini, -sum((c / t) * log2(c / t)) AS entropy FROM
            (SELECT *, sum(c) OVER (PARTITION BY feature, value) AS t FROM c) GROUP BY feature, value)
    SELECT feature, value, CAST(n AS BIGINT) AS n, round(gini, 6) AS gini, round(entropy, 6) AS entropy,
      round(sum(n * gini) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature), 6) AS weighted_gini,
      round(sum(n * entropy) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature), 6) AS weighted_entropy FROM n""")
def impurity_table(t):
    rows = t.orders.select(
        F.col("o_orderstatus").alias("y"), F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_totalprice") > 250000, "high").otherwise("low").alias("price"))
    found = md.impurity_table(rows, ["priority", "price"], "y")
    return found.withColumns({c: F.round(c, 6) for c in ("gini", "entropy", "weighted_gini", "weighted_entropy")})


@query("m21_decision_tree_depths", f"""
    WITH {_TRAIN} SELECT CAST(d AS INTEGER) AS depth, majority, d > 1 AS beats_majority, true AS fits_no_worse FROM held, (VALUES (1), (3), (5)) g(d)""")
def decision_tree_depths(t):
    """One cut is a weak rule; deeper trees beat the majority and fit better."""
    rows = _numeric_rows(t)
    held = rows.filter("fold = 0")
    swept = md.depth_sweep(rows.filter("fold <> 0"), held, "label", [1, 3, 5])
    first = swept.filter("depth = 1").select("train_accuracy").scalar()
    better = F.when(F.col("depth") > 1, F.col("test_accuracy") > _majority(held)).otherwise(F.lit(False))
    return swept.select("depth", _majority(held).alias("majority"), better.alias("beats_majority"), (F.col("train_accuracy") >= first).alias("fits_no_worse"))


@query("m22_random_forest", f"""
    WITH {_TRAIN} SELECT 10 AS trees, 1.0::DOUBLE AS importance, majority, true AS beats_majority FROM held""")
def random_forest(t):
    rows = _numeric_rows(t)
    held = rows.filter("fold = 0")
    model = md.random_forest(10, 5, 1).fit(rows.filter("fold <> 0"))
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return model.transform(held).agg(hit.alias("accuracy")).select(
        F.lit(len(model.trees)).alias("trees"), F.lit(round(float(sum(model.featureImportances.toArray())), 6)).alias("importance"),
        _majority(held).alias("majority"), (F.col("accuracy") > _majority(held)).alias("beats_majority"))


def _test_scores(t, estimator):
    """Held-out accuracy against the majority floor, and the ranking quality."""
    rows = training_rows(t)
    held = rows.filter("fold = 0")
    found = md.fit_predict(_with_stages(estimator), rows.filter("fold <> 0"), held, ["o_orderkey", "label"])
    scores = ev.overall_metrics(found, "label", "prediction").withColumn("auc", ev.roc_auc(found, "score", "label").scalar())
    return scores.select(
        _majority(held).alias("majority"), (F.col("accuracy") > _majority(held)).alias("beats_majority"), (F.col("auc") > 0.85).alias("ranks_well"))


_FLOOR = f"WITH {_TRAIN} SELECT majority, true AS beats_majority, true AS ranks_well"


@query("m23_boosted_trees", _FLOOR + " FROM held")
def boosted_trees(t):
    return _test_scores(t, md.boosted_trees(5, 3, 0.3, 1))


@query("m24_logistic_regression", _FLOOR + ", penalty FROM held, (VALUES ('l1'), ('l2')) g(penalty)")
def logistic_regression(t):
    n = t.orders.count()
    l2 = _test_scores(t, md.logistic(n, 1.0, "l2", maxIter=20)).withColumn("penalty", F.lit("l2"))
    return l2.unionByName(_test_scores(t, md.logistic(n, 0.1, "l1", maxIter=20)).withColumn("penalty", F.lit("l1")))


@query("m25_simple_regression", """
    SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
      round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY l_returnflag""")
def simple_regression(t):
    found = md.simple_regression(t.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return found.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"), F.round("r2", 6).alias("r2"))


@query("m25_gradient_step", """
    WITH e AS (SELECT 0.5 + 0.2 * l_discount + 0.1 * l_tax - l_quantity AS e, l_discount AS d, l_tax AS x FROM lineitem)
    SELECT round(avg(e * e) / 2, 5) AS loss, round(0.5 - 0.01 * avg(e), 6) AS bias, round(0.2 - 0.01 * avg(e * d), 6) AS l_discount, round(0.1 - 0.01 * avg(e * x), 6) AS l_tax FROM e""")
def gradient_step(t):
    found = md.gradient_step(t.lineitem, ["l_discount", "l_tax"], "l_quantity", {"l_discount": 0.2, "l_tax": 0.1}, 0.5, 0.01)
    return found.select(F.round("loss", 5).alias("loss"), *[F.round(c, 6).alias(c) for c in ("bias", "l_discount", "l_tax")])


@query("m25_linear_regression", """
    WITH c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
    SELECT count(*) AS n, round(avg(abs(a + b * l_quantity - l_extendedprice)), 3) AS mae FROM lineitem, c""")
def linear_regression(t):
    model = md.linear_regression(t.lineitem, ["l_quantity"], "l_extendedprice")
    error = F.abs(F.col("prediction") - F.col("l_extendedprice"))
    return model.transform(t.lineitem).agg(F.count("*").alias("n"), F.round(F.avg(error), 3).alias("mae"))


_CENTERS = "c AS (SELECT label AS cluster, list_transform(arg_min(embedding, vec_id), lambda x: x::DOUBLE) AS center FROM embeddings GROUP BY label)"
_PLACED = f"""{_CENTERS}, a AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v, cluster,
      list_sum(list_transform(list_zip(embedding, center), lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2]))) AS d FROM embeddings, c),
    p AS (SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d, any_value(v) AS v FROM a GROUP BY vec_id)"""


def _centers(t):
    return t.embeddings.groupBy(F.col("label").alias("cluster")).agg(F.min_by("embedding", "vec_id").cast("array<double>").alias("center"))


def _placed(t):
    return cl.assign_to_centers(t.embeddings, "embedding", _centers(t), "cluster", "center")


@query("m26_lloyd_assign", f"WITH {_PLACED} SELECT vec_id, cluster, round(d, 5) AS squared_distance FROM p")
def lloyd_assign(t):
    return _placed(t).select("vec_id", "cluster", F.round("squared_distance", 5).alias("squared_distance"))


@query("m26_lloyd_update", f"""
    WITH {_PLACED}, u AS (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM p)
    SELECT cluster, CAST(i - 1 AS INTEGER) AS dimension, round(avg(x), 5) AS value FROM u GROUP BY cluster, i""")
def lloyd_update(t):
    means = cl.cluster_means(_placed(t), "embedding", "cluster")
    return means.select("cluster", F.posexplode("center").alias("dimension", "value")).withColumn("value", F.round("value", 5))


@query("m26_elbow", """
    WITH u AS (SELECT unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
      w AS (SELECT sum(v) AS inertia FROM (SELECT var_pop(x) * count(*) AS v FROM u GROUP BY i))
    SELECT CAST(k AS INTEGER) AS k, round(inertia, 4) AS whole, k > 1 AS below_whole FROM w, range(1, 9) g(k)""")
def elbow(t):
    """Inertia of one cluster is the whole spread; more clusters lie below it."""
    found = cl.elbow(t.embeddings, "embedding", range(1, 9), 3)
    whole = found.filter("k = 1").select("inertia").scalar()
    return found.select("k", F.round(whole, 4).alias("whole"), (F.col("inertia") < whole).alias("below_whole"))


_EPS, _MIN = 0.03, 5


def _db(eps):
    return f"""p AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
    nb AS (SELECT a.id AS i, b.id AS j FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {eps}::DOUBLE * {eps}::DOUBLE),
    core AS (SELECT i FROM nb GROUP BY i HAVING count(*) >= {_MIN}),
    ce AS (SELECT nb.i, nb.j FROM nb JOIN core a ON a.i = nb.i JOIN core b ON b.i = nb.j),
    reach AS (SELECT i AS root, i AS node FROM core UNION SELECT reach.root, ce.j FROM reach JOIN ce ON ce.i = reach.node),
    named AS (SELECT node AS id, min(root) AS cluster FROM reach GROUP BY node),
    border AS (SELECT nb.i AS id, min(named.cluster) AS cluster FROM nb JOIN named ON named.id = nb.j WHERE nb.i NOT IN (SELECT i FROM core) GROUP BY nb.i),
    db AS (SELECT p.id AS vec_id, COALESCE(n.cluster, b.cluster, -1) AS cluster,
      CASE WHEN n.cluster IS NOT NULL THEN 'core' WHEN b.cluster IS NOT NULL THEN 'border' ELSE 'noise' END AS kind
      FROM p LEFT JOIN named n ON n.id = p.id LEFT JOIN border b ON b.id = p.id)"""


def _plane(t):
    e = F.col("embedding").cast("array<double>")
    return t.embeddings.select("vec_id", e[0].alias("x"), e[1].alias("y"))


@query("m27_dbscan", f"WITH RECURSIVE {_db(_EPS)} SELECT vec_id, cluster, kind FROM db")
def dbscan(t):
    return cl.dbscan(_plane(t), "vec_id", "x", "y", _EPS, _MIN)


@query("m27_eps_sweep", " UNION ALL ".join(f"""(WITH RECURSIVE {_db(e)} SELECT {e}::DOUBLE AS eps, count(DISTINCT cluster) FILTER (WHERE cluster >= 0) AS clusters,
      count(*) FILTER (WHERE kind = 'core') AS core, count(*) FILTER (WHERE kind = 'border') AS border, count(*) FILTER (WHERE kind = 'noise') AS noise FROM db)"""
    for e in (0.02, 0.04)))
def eps_sweep(t):
    return cl.eps_sweep(_plane(t), "vec_id", "x", "y", [0.02, 0.04], _MIN)


#: The radius of whole vectors, and the SQL of the same clusters over all components.
_REACH = 1.14


def _db_whole(eps):
    plane = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"
    points = "p AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings)"
    return points + _db(eps)[_db(eps).index(",\n    nb AS"):].replace(plane, "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))")


@query("m27_dbscan_vectors", f"WITH RECURSIVE {_db_whole(_REACH)} SELECT vec_id, cluster, kind FROM db")
def dbscan_vectors(t):
    return density.dbscan_vectors(t.embeddings, "vec_id", "embedding", _REACH, _MIN)


@query("m27_eps_sweep_vectors", " UNION ALL ".join(f"""(WITH RECURSIVE {_db_whole(e)} SELECT {e}::DOUBLE AS eps, count(DISTINCT cluster) FILTER (WHERE cluster >= 0) AS clusters,
      count(*) FILTER (WHERE kind = 'core') AS core, count(*) FILTER (WHERE kind = 'border') AS border, count(*) FILTER (WHERE kind = 'noise') AS noise FROM db)"""
    for e in (1.1, 1.16)))
def eps_sweep_vectors(t):
    return density.eps_sweep_vectors(t.embeddings, "vec_id", "embedding", [1.1, 1.16], _MIN)


_REFERENCE = "r AS (SELECT label, list_transform(arg_min(embedding, vec_id), lambda x: x::DOUBLE) AS w FROM embeddings GROUP BY label)"


@query("m28_distances", f"""
    WITH {_REFERENCE}, d AS (SELECT vec_id, list_transform(list_zip(embedding, w), lambda z: abs(z[1]::DOUBLE - z[2])) AS d FROM embeddings e JOIN r ON r.label = e.label)
    SELECT vec_id, round(list_sum(d), 6) AS l1, round(sqrt(list_sum(list_transform(d, lambda x: x * x))), 6) AS l2, round(list_max(d), 6) AS linf FROM d""")
def distances(t):
    reference = t.embeddings.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("w"))
    v, w = F.col("embedding"), F.col("w")
    return t.embeddings.join(reference, "label").select(
        "vec_id", F.round(vectors.l1(v, w), 6).alias("l1"), F.round(vectors.l2(v, w), 6).alias("l2"), F.round(vectors.linf(v, w), 6).alias("linf"))


_NEAR = """n AS (SELECT a.vec_id, b.vec_id AS neighbour, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS d, b.label
      FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, neighbour) AS rank FROM n QUALIFY rank <= 5)"""


@query("m29_nearest_neighbours", f"WITH {_NEAR} SELECT vec_id, neighbour, rank, round(d, 5) AS distance FROM k")
def nearest_neighbours(t):
    found = nb.knn_join(t.embeddings, t.embeddings, "vec_id", "vec_id", "embedding", 5, exclude_self=True)
    return found.withColumn("distance", F.round("distance", 5))


@query("m29_knn_vote", f"""
    WITH {_NEAR}, v AS (SELECT vec_id, label, count(*) AS n FROM k GROUP BY ALL)
    SELECT vec_id, CAST(arg_min(label, (-n, label)) AS BIGINT) AS predicted FROM v GROUP BY vec_id""")
def knn_vote(t):
    found = nb.knn_join(t.embeddings, t.embeddings, "vec_id", "vec_id", "embedding", 5, exclude_self=True)
    votes = nb.knn_vote(found, t.embeddings, "vec_id", "vec_id", "label")
    return votes.withColumn("predicted", F.col("predicted").cast("long"))


@query("m30_stacking", f"WITH {_TRAIN} SELECT (SELECT count(*) FROM orders) AS n, majority, true AS beats_majority FROM every")
def stacking(t):
    rows = _numeric_rows(t)
    n = t.orders.count()
    bases = {"tree": md.decision_tree(4), "logit": md.logistic(n, 1.0, maxIter=10)}
    table, model = md.stack(bases, md.logistic(n, 1.0, maxIter=10), rows.withColumn("fold", F.col("fold") % 3), "o_orderkey", "label", "fold", 3)
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return model.transform(table).agg(F.count("*").alias("n"), hit.alias("accuracy")).select(
        "n", _majority(rows).alias("majority"), (F.col("accuracy") > _majority(rows)).alias("beats_majority"))


@query("m31_bagging", f"""
    WITH {_TRAIN} SELECT CAST(k AS INTEGER) AS tree, majority, true AS beats_majority, true AS third_left_out FROM every, range(5) g(k)""")
def bagging(t):
    """About 36.8 percent of the rows are out of bag for each tree."""
    rows = _numeric_rows(t)
    _, report = md.bagging(lambda tree: md.decision_tree(4, seed=tree), rows, "o_orderkey", "label", 5, 11)
    return report.select(
        "tree", _majority(rows).alias("majority"), (F.col("oob_accuracy") > _majority(rows)).alias("beats_majority"),
        (F.abs(F.col("oob_share") - 0.368) < 0.04).alias("third_left_out"))


_FOLDS = """r AS (SELECT o_orderkey, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY (o_orderkey * 7919) % 10007, o_orderkey) - 1) % 5 AS fold, o_orderstatus FROM orders)"""


@query("m32_fold_ids", f"WITH {_FOLDS} SELECT o_orderkey, CAST(fold AS BIGINT) AS fold FROM r")
def fold_ids(t):
    order = ((F.col("o_orderkey") * 7919) % 10007).cast("double")
    found = ft.fold_ids(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", order, "o_orderkey", 5)
    return found.select("o_orderkey", F.col("fold").cast("long").alias("fold"))


@query("m32_cross_validation", f"""
    WITH {_TRAIN} SELECT model, fold, round(greatest(avg(label), 1 - avg(label)), 6) AS majority, true AS beats_majority, true AS ranks_well
    FROM (SELECT label, CAST(fold AS INTEGER) AS fold FROM tr), (VALUES ('tree'), ('forest')) g(model) GROUP BY model, fold""")
def cross_validation(t):
    models = {"tree": md.decision_tree(4), "forest": md.random_forest(5, 4, 1)}
    rows = _numeric_rows(t)
    one = F.avg("label")
    floors = rows.groupBy("fold").agg(F.round(F.greatest(one, 1 - one), 6).alias("majority"))
    folds = md.cross_validate(models, rows, "label", "fold", 5).join(floors, "fold")
    return folds.select("model", "fold", "majority", (F.col("accuracy") > F.col("majority")).alias("beats_majority"), (F.col("auc") > 0.8).alias("ranks_well"))


@query("m33_grid_search", f"WITH {_TRAIN} SELECT 4 AS configs, majority, true AS beats_majority, true AS deeper_wins FROM every")
def grid_search(t):
    configs = md.grid(depth=[2, 4], leaf=[1, 20])
    rows = _numeric_rows(t)
    best, model, table = md.grid_search(lambda **c: md.decision_tree(**c), configs, rows, "label", "fold", 5)
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return model.transform(rows).agg(hit.alias("accuracy")).select(
        table.select(F.count("*").cast("int")).scalar().alias("configs"), _majority(rows).alias("majority"),
        (F.col("accuracy") > _majority(rows)).alias("beats_majority"), F.lit(best["depth"] == 4).alias("deeper_wins"))


@query("m34_out_of_fold", "SELECT o_orderkey, 1 AS predictions FROM orders")
def out_of_fold(t):
    """Each row gets exactly one prediction."""
    found = md.out_of_fold(md.decision_tree(3), _numeric_rows(t), "fold", 5, ["o_orderkey"])
    return found.groupBy("o_orderkey").agg(F.count("prediction").cast("int").alias("predictions"))


@query("m35_ablation", """
    SELECT model, verdict, (SELECT count(*) FROM orders) AS rows FROM (VALUES ('reference', 'Reference'), ('price only', 'Rejected')) g(model, verdict)""")
def ablation(t):
    rows = training_rows(t)
    variants = {
        "reference": Pipeline(stages=[VectorAssembler(inputCols=_NUMERIC, outputCol="features"), md.decision_tree(4)]),
        "price only": Pipeline(stages=[VectorAssembler(inputCols=["price"], outputCol="features"), md.decision_tree(4)]),
    }
    found = md.ablation(variants, "reference", rows, "label", "fold", 5, 0.005, -0.005)
    return found.select("model", "verdict", rows.select(F.count("*")).scalar().alias("rows"))


@query("m36_seed_stability", f"WITH {_TRAIN} SELECT CAST(5 AS BIGINT) AS seeds, majority, true AS beats_majority, true AS stable FROM held")
def seed_stability(t):
    rows = _numeric_rows(t)
    held = rows.filter("fold = 0")
    found = md.seed_stability(lambda s: md.random_forest(5, 4, s), rows.filter("fold <> 0"), held, "label", [1, 2, 3, 4, 5])
    return found.select(
        "seeds", _majority(held).alias("majority"), (F.col("low") > _majority(held)).alias("beats_majority"), (F.col("range") < 0.1).alias("stable"))


@query("m37_group_baseline", """
    WITH h AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'), n AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
      a AS (SELECT user_id, hour(ts) AS hr, isodow(ts) AS wd, avg(value) AS m FROM h GROUP BY ALL),
      b AS (SELECT user_id, hour(ts) AS hr, avg(value) AS m FROM h GROUP BY ALL), c AS (SELECT user_id, avg(value) AS m FROM h GROUP BY ALL)
    SELECT event_id, round(COALESCE(a.m, b.m, c.m, (SELECT avg(value) FROM h)), 8) AS baseline FROM n
    LEFT JOIN a ON a.user_id = n.user_id AND a.hr = hour(n.ts) AND a.wd = isodow(n.ts)
    LEFT JOIN b ON b.user_id = n.user_id AND b.hr = hour(n.ts) LEFT JOIN c ON c.user_id = n.user_id""")
def group_baseline(t):
    rows = t.events.withColumns({"hr": F.hour("ts"), "wd": F.weekday("ts")})
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    found = mo.group_baseline(
        rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut), [["user_id", "hr", "wd"], ["user_id", "hr"], ["user_id"]], "value", "baseline")
    return found.select("event_id", F.round("baseline", 8).alias("baseline"))


def _silhouette_sql(distance):
    return f"""
    WITH d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS s, count(*) FILTER (WHERE a.vec_id <> b.vec_id) AS n
      FROM embeddings a CROSS JOIN embeddings b GROUP BY ALL),
      m AS (SELECT vec_id, own, max(CASE WHEN own = other THEN s / nullif(n, 0) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM d GROUP BY ALL)
    SELECT vec_id, own AS label, round(COALESCE((b - a) / greatest(a, b), 0), 5) AS silhouette FROM m"""


_L2 = "list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@query("m38_silhouette_squared", _silhouette_sql(f"{_L2} * {_L2}"))
def silhouette_squared(t):
    found = cl.silhouette_squared(t.embeddings, "vec_id", "embedding", "label")
    return found.withColumn("silhouette", F.round("silhouette", 5))


@query("m38_silhouette_euclidean", _silhouette_sql(_L2))
def silhouette_euclidean(t):
    found = cl.silhouette_euclidean(t.embeddings, "vec_id", "embedding", "label")
    return found.select("vec_id", F.col("label").cast("int").alias("label"), F.round("silhouette", 5).alias("silhouette"))


@query("m39_rolling_origin", """
    WITH p AS (SELECT event_id, value, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 604800000000 AS period FROM events),
      m AS (SELECT f.k AS fold, avg(value) AS mean, count(*) AS train_rows FROM (SELECT DISTINCT period AS k FROM p) f JOIN p ON p.period < f.k GROUP BY f.k)
    SELECT fold, train_rows, count(*) AS test_rows, round(avg(abs(value - mean)), 5) AS mae FROM m JOIN p ON p.period = m.fold GROUP BY ALL""")
def rolling_origin(t):
    start = timejoin.micros(F.lit("2024-01-01").cast("timestamp_ntz"))
    period = F.floor((timejoin.micros("ts") - start) / F.lit(604_800_000_000)).cast("long")
    rows = t.events.select("value", period.alias("period"))
    return md.rolling_origin_mean(rows, "period", "value").withColumn("mae", F.round("mae", 5))


@query("m40_linear_svm", _FLOOR + " FROM held")
def linear_svm(t):
    return _test_scores(t, md.linear_svm(1.0, t.orders.count(), maxIter=10))


_RING = """p AS (SELECT o_orderkey, (o_custkey % 100) / 50.0 - 1 AS x, (o_orderkey * 7919 % 1009) / 504.5 - 1 AS y, (o_orderkey * 7919) % 5 AS fold FROM orders),
    held AS (SELECT round(greatest(avg(label), 1 - avg(label)), 6) AS majority, count(*) AS rows FROM (SELECT CASE WHEN x * x + y * y < 0.6 THEN 1.0 ELSE 0.0 END AS label FROM p WHERE fold = 0))"""


def _ring(t):
    """Points of a square; the class is being inside a circle, the height the squared distance from its middle."""
    x, y = (F.col("o_custkey") % 100) / 50.0 - 1, (F.col("o_orderkey") * 7919 % 1009) / 504.5 - 1
    points = t.orders.select("o_orderkey", x.alias("x"), y.alias("y"), (F.col("o_orderkey") * 7919 % 5).alias("fold"))
    height = F.col("x") * F.col("x") + F.col("y") * F.col("y")
    return points.withColumn("height", height).withColumn("label", F.when(height < 0.6, 1.0).otherwise(0.0))


@query("m40_rbf_svm", f"WITH {_RING} SELECT majority, true AS beats_majority, true AS beats_linear FROM held")
def rbf_svm(t):
    """A circle has no straight border: the radial kernel finds it, the linear one does not."""
    rows = _ring(t)
    train, held = rows.filter("fold <> 0"), rows.filter("fold = 0")
    n = train.count()
    linear = Pipeline(stages=[VectorAssembler(inputCols=["x", "y"], outputCol="features"), md.linear_svm(10.0, n, maxIter=30)])
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")
    straight, bent = (model.fit(train).transform(held).agg(hit) for model in (linear, kernels.rbf_svm(["x", "y"], 2.0, 10.0, n, maxIter=30)))
    return bent.select(
        _majority(held).alias("majority"), (F.col("accuracy") > _majority(held) + 0.2).alias("beats_majority"),
        (F.col("accuracy") > straight.scalar() + 0.2).alias("beats_linear"))


@query("m41_perceptron_regression", f"WITH {_RING} SELECT rows, true AS beats_linear, true AS explains_most FROM held")
def perceptron_regression(t):
    """The height of a bowl, from its two plane coordinates."""
    rows = _ring(t)
    train, held = rows.filter("fold <> 0"), rows.filter("fold = 0")
    model = kernels.PerceptronRegressor(["x", "y"], "height", out="prediction").fit(train)
    square = F.avg((F.col("prediction") - F.col("height")) ** 2).alias("error")
    line = md.linear_regression(train, ["x", "y"], "height")
    found = model.transform(held).agg(F.count("*").alias("rows"), square, F.var_pop("height").alias("spread"))
    return found.select(
        "rows", (F.col("error") < 0.5 * line.transform(held).agg(square).scalar()).alias("beats_linear"), (F.col("error") < 0.2 * F.col("spread")).alias("explains_most"))


@query("e12_permutation_importance", """
    SELECT feature, true AS matters, (SELECT count(*) FROM orders WHERE (o_orderkey * 7919) % 5 = 0) AS rows FROM (VALUES ('price'), ('activity')) g(feature)""")
def permutation_importance(t):
    rows = training_rows(t)
    held = rows.filter("fold = 0")
    stages = [VectorAssembler(inputCols=_NUMERIC, outputCol="features"), md.decision_tree(5)]
    model = Pipeline(stages=stages).fit(rows.filter("fold <> 0"))
    found = md.permutation_importance(model, held, "o_orderkey", "label", _NUMERIC, 3)
    return found.select("feature", (F.col("mean_drop") > 0.01).alias("matters"), held.select(F.count("*")).scalar().alias("rows"))


@query("e13_leaf_support", "SELECT count(*) AS rows, true AS several_leaves, true AS marks_right FROM orders WHERE (o_orderkey * 7919) % 5 <> 0")
def leaf_support(t):
    rows = _numeric_rows(t).filter("fold <> 0")
    found = md.leaf_support(md.decision_tree(6).fit(rows), rows, 5)
    return found.agg(
        F.sum("rows").alias("rows"), (F.count("*") > 2).alias("several_leaves"), F.bool_and(F.col("small") == (F.col("rows") < 5)).alias("marks_right"))