"""Training and comparing MLlib models. Loops run over folds, seeds and
configurations, whose number is fixed; rows stay on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from itertools import product

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators import evaluation as ev
from tallyloom.plans.literals import literal_table
from tallyloom.plans.ordering import row_numbers
from tallyloom.plans.scratch import materialised


def preprocessing(numeric: Sequence[str], categorical: Sequence[str], out: str = "features") -> list:
    """Stages: median fill and scaling for numbers, one-hot for categories.

    An unknown category gets the last index and the encoder drops the last
    slot, so it becomes all zero. Other columns do not enter the vector.
    """
    stages: list = []
    parts: list[str] = []
    if numeric:
        filled = [f"{c}__f" for c in numeric]
        stages += [
            Imputer(inputCols=list(numeric), outputCols=filled, strategy="median"),
            VectorAssembler(inputCols=filled, outputCol="__num"),
            StandardScaler(inputCol="__num", outputCol="__scaled", withMean=True, withStd=True),
        ]
        parts.append("__scaled")
    if categorical:
        codes, hot = [f"{c}__i" for c in categorical], [f"{c}__h" for c in categorical]
        stages += [
            StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True),
        ]
        parts += hot
    return [*stages, VectorAssembler(inputCols=parts, outputCol=out)]


def logistic(rows: int, c: float = 1.0, penalty: str = "l2", **params) -> LogisticRegression:
    """Logistic regression with the inverse strength ``c`` of penalties that
    are summed over rows: MLlib averages the loss, so regParam is 1 / (n c)."""
    return LogisticRegression(regParam=1.0 / (rows * c), elasticNetParam=1.0 if penalty == "l1" else 0.0, **params)


def decision_tree(depth: int, leaf: int = 1, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=leaf, **params)


def random_forest(trees: int, depth: int, seed: int, **params) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **params)


def boosted_trees(rounds: int, depth: int, rate: float, seed: int, classes: int = 2, **params):
    """Gradient boosting; more than two classes are learned one against rest."""
    binary = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, **params)
    return binary if classes == 2 else OneVsRest(classifier=binary)


def linear_svm(c: float, rows: int, classes: int = 2, **params):
    binary = LinearSVC(regParam=1.0 / (rows * c), **params)
    return binary if classes == 2 else OneVsRest(classifier=binary)


def positive(probability: str = "probability") -> Column:
    return vector_to_array(probability)[1]


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Predictions for the test rows: kept columns, predicted class and, where
    the model has one, the positive probability."""
    scored = estimator.fit(train).transform(test)
    score = positive().alias("score") if "probability" in scored.columns else (
        vector_to_array("rawPrediction")[1].alias("score") if "rawPrediction" in scored.columns else F.col("prediction").alias("score")
    )
    return scored.select(*kept, F.col("prediction"), score)


def out_of_fold(estimator: Estimator, df: DataFrame, fold: str, folds: int, kept: Sequence[str]) -> DataFrame:
    """One prediction per row, from a model that has not seen its fold."""
    out = None
    for i in range(folds):
        part = fit_predict(estimator, df.filter(F.col(fold) != i), df.filter(F.col(fold) == i), [*kept, fold])
        out = part if out is None else out.unionByName(part)
    return out


def cross_validate(models: Mapping[str, Estimator], df: DataFrame, label: str, fold: str, folds: int) -> DataFrame:
    """AUC, accuracy, recall and macro F1 per model and fold.

    Every row is scored once per model; the predictions are written, and each
    metric is one grouped aggregate over them.
    """
    out = None
    for name, estimator in models.items():
        part = out_of_fold(estimator, df, fold, folds, [label]).select(
            F.lit(name).alias("model"), F.col(fold).cast("int").alias("fold"), label, "prediction", "score")
        out = part if out is None else out.unionByName(part)
    predicted, by = materialised(out, "fold-predictions"), ["model", "fold"]
    overall = ev.overall_metrics(predicted, label, "prediction", by).select(*by, "accuracy", "macro_f1")
    recall = ev.classification_report(predicted, label, "prediction", by).filter(F.col("class") == 1.0).select(*by, "recall")
    return overall.join(recall, by, "left").join(ev.roc_auc(predicted, "score", label, by), by, "left")


def summarise_folds(folds: DataFrame, metric: str) -> DataFrame:
    """Mean and population deviation per model, ranked; the first is champion."""
    return ev.rank_models(folds, "model", metric)


def grid(**options: Iterable) -> list[dict]:
    """All combinations of the options."""
    return [dict(zip(options, values)) for values in product(*options.values())]


def grid_search(
    make: Callable[..., Estimator], configs: Sequence[dict], df: DataFrame, label: str, fold: str, folds: int,
    stages: Sequence = (),
) -> tuple[dict, Model, DataFrame]:
    """Best configuration by mean AUC over the folds, refitted on all rows.

    At most twelve configurations, so a search stays bounded.
    """
    if len(configs) > 12:
        raise ValueError("at most 12 configurations")
    names = {f"c{i:02d}": Pipeline(stages=[*stages, make(**c)]) for i, c in enumerate(configs)}
    table = summarise_folds(cross_validate(names, df, label, fold, folds), "auc")
    ranked = literal_table(df.sparkSession, [tuple(r) for r in table.collect()],  # one row per configuration
                           "model string, mean double, sd double, place bigint, champion boolean")
    best = configs[int(ranked.orderBy("place", "model").first()["model"][1:])]
    return best, Pipeline(stages=[*stages, make(**best)]).fit(df), ranked


def stack(bases: Mapping[str, Estimator], meta: Estimator, df: DataFrame, row_id: str, label: str, fold: str, folds: int,
          passthrough: Sequence[str] = ()) -> tuple[DataFrame, Model]:
    """Meta model on out-of-fold base probabilities, joined by row id."""
    table = df.select(row_id, label, fold, *passthrough)
    for name, estimator in bases.items():
        scores = out_of_fold(estimator, df, fold, folds, [row_id]).select(row_id, F.col("score").alias(name))
        table = table.join(scores, row_id)
    inputs = VectorAssembler(inputCols=[*bases, *passthrough], outputCol="features")
    return table, Pipeline(stages=[inputs, meta]).fit(table.drop("features") if "features" in table.columns else table)


def bootstrap_weight(row_id: str, tree: int, seed: int) -> Column:
    """Poisson(1) number of draws of a row for one tree, from its hash."""
    u = F.pmod(F.xxhash64(F.col(row_id), F.lit(tree), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    mass = 0.36787944117144233  # exp(-1)
    total, term, out = 0.0, mass, None
    for n in range(12):
        total += term
        out = F.when(u < total, float(n)) if out is None else out.when(u < total, float(n))
        term /= n + 1
    return out.otherwise(12.0)


def bagging(make: Callable[[int], Estimator], df: DataFrame, row_id: str, label: str, trees: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Votes per row and tree with an out-of-bag mark, and a diagnosis per tree."""
    votes = None
    for tree in range(trees):
        weighted = df.withColumn("__w", bootstrap_weight(row_id, tree, seed))
        model = make(tree).setWeightCol("__w").fit(weighted.filter(F.col("__w") > 0))
        part = model.transform(weighted).select(
            row_id, label, F.lit(tree).alias("tree"), F.col("prediction").alias("vote"), (F.col("__w") == 0).alias("out_of_bag")
        )
        votes = part if votes is None else votes.unionByName(part)
    hit = (F.col("vote") == F.col(label)).cast("double")
    report = votes.groupBy("tree").agg(
        F.avg(F.col("out_of_bag").cast("double")).alias("oob_share"), F.avg(F.when(F.col("out_of_bag"), hit)).alias("oob_accuracy")
    )
    return votes, report


def majority_vote(votes: DataFrame, row_id: str) -> DataFrame:
    """Share of votes for class 1 and the majority class, 0 on a tie."""
    share = F.avg(F.col("vote"))
    return votes.groupBy(row_id).agg(share.alias("vote_share"), F.when(share > 0.5, 1.0).otherwise(0.0).alias("vote"))


def leaf_support(model, df: DataFrame, least: int) -> DataFrame:
    """Rows per leaf of a fitted tree, small leaves marked."""
    model = model.copy().setLeafCol("leaf")
    counts = model.transform(df).groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("small", F.col("rows") < F.lit(least))


def permuted(df: DataFrame, row_id: str, column: str, seed: int) -> DataFrame:
    """The column shuffled over the rows: each row takes the value of the row
    one place further in a hashed order, so every value is used once."""
    order = F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(1 << 52)).cast("double")
    placed = row_numbers(df.withColumn("__o", order), "__o", row_id, out="__rn", with_total="__n").drop("__o")
    values = placed.select((F.col("__rn") % F.col("__n") + 1).alias("__rn"), F.col(column).alias("__value"))
    return placed.join(values, "__rn").withColumn(column, F.col("__value")).drop("__value", "__rn", "__n")


def permutation_importance(model: Model, df: DataFrame, row_id: str, label: str, features: Sequence[str], repeats: int) -> DataFrame:
    """Mean and deviation of the accuracy drop per shuffled feature."""

    def accuracy(rows: DataFrame) -> DataFrame:
        return model.transform(rows).agg(F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))

    base, out = accuracy(df).scalar(), None
    for name in features:
        for i in range(repeats):
            row = accuracy(permuted(df, row_id, name, i)).select(F.lit(name).alias("feature"), (base - F.col("accuracy")).alias("drop"))
            out = row if out is None else out.unionByName(row)
    return out.groupBy("feature").agg(F.avg("drop").alias("mean_drop"), F.stddev_pop("drop").alias("sd_drop"))


def seed_stability(make: Callable[[int], Estimator], train: DataFrame, test: DataFrame, label: str, seeds: Sequence[int]) -> DataFrame:
    """Accuracy per seed, its mean and range."""
    out = None
    for seed in seeds:
        row = ev.overall_metrics(fit_predict(make(seed), train, test, [label]), label, "prediction")
        row = row.select(F.lit(seed).alias("seed"), "accuracy")
        out = row if out is None else out.unionByName(row)
    return out.agg(
        F.count(F.lit(1)).alias("seeds"), F.avg("accuracy").alias("mean"),
        F.min("accuracy").alias("low"), F.max("accuracy").alias("high"), (F.max("accuracy") - F.min("accuracy")).alias("range"),
    )


def ablation(variants: Mapping[str, Estimator], reference: str, df: DataFrame, label: str, fold: str, folds: int,
             gain: float, drop: float) -> DataFrame:
    """Mean scores per variant, change against the reference, verdict."""
    means = cross_validate(variants, df, label, fold, folds).groupBy("model").agg(
        F.avg("macro_f1").alias("f1"), F.avg("accuracy").alias("accuracy")
    )
    ref = means.filter(F.col("model") == reference).select(F.struct("f1", "accuracy").alias("r")).scalar()
    deltas = means.withColumns({"d_f1": F.col("f1") - ref["f1"], "d_accuracy": F.col("accuracy") - ref["accuracy"]})
    return ev.ablation_verdict(deltas, "model", reference, "d_f1", "d_accuracy", gain, drop)


def depth_sweep(train: DataFrame, test: DataFrame, label: str, depths: Sequence[int], stages: Sequence = ()) -> DataFrame:
    """Train and test accuracy per tree depth."""
    out = None
    for depth in depths:
        model = Pipeline(stages=[*stages, decision_tree(depth, labelCol=label)]).fit(train)
        hit = F.avg((F.col("prediction") == F.col(label)).cast("double"))
        on_test = model.transform(test).agg(hit).scalar()
        row = model.transform(train).agg(hit.alias("train_accuracy")).select(
            F.lit(depth).alias("depth"), "train_accuracy", on_test.alias("test_accuracy"))
        out = row if out is None else out.unionByName(row)
    return out


def impurity_table(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Gini and entropy per feature value, and weighted over each feature.

    One count per (feature, value, class); the rest runs on those counts.
    """
    cells = (
        df.select(label, *[F.col(f).cast("string").alias(f) for f in features])
        .unpivot([label], list(features), "feature", "value")
        .groupBy("feature", "value", label).agg(F.count(F.lit(1)).alias("c"))
    )
    sizes = cells.groupBy("feature", "value").agg(F.sum("c").alias("n"))
    share = F.col("c") / F.col("n")
    nodes = cells.join(sizes, ["feature", "value"]).groupBy("feature", "value").agg(
        F.max("n").alias("n"), (1 - F.sum(share * share)).alias("gini"), (-F.sum(share * F.log2(share))).alias("entropy")
    )
    splits = nodes.groupBy("feature").agg(
        F.sum("n").alias("total"),
        (F.sum(F.col("n") * F.col("gini")) / F.sum("n")).alias("weighted_gini"),
        (F.sum(F.col("n") * F.col("entropy")) / F.sum("n")).alias("weighted_entropy"),
    )
    return nodes.join(splits.drop("total"), "feature")


def simple_regression(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Closed-form line per group."""
    return df.groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
    )


def gradient_step(df: DataFrame, features: Sequence[str], y: str, weights: Mapping[str, float], bias: float, rate: float) -> DataFrame:
    """One update of a linear model under half the mean squared error."""
    error = F.lit(bias) - F.col(y)
    for name in features:
        error = error + F.lit(weights[name]) * F.col(name)
    return df.agg(
        (F.avg(error * error) / 2).alias("loss"), (F.lit(bias) - F.lit(rate) * F.avg(error)).alias("bias"),
        *[(F.lit(weights[f]) - F.lit(rate) * F.avg(error * F.col(f))).alias(f) for f in features],
    )


def linear_regression(df: DataFrame, features: Sequence[str], y: str) -> Model:
    stages = [VectorAssembler(inputCols=list(features), outputCol="features"), LinearRegression(labelCol=y, solver="normal")]
    return Pipeline(stages=stages).fit(df)


def pca(df: DataFrame, vector: str, k: int) -> Model:
    """Principal components of centred, scaled vectors."""
    return Pipeline(stages=[
        StandardScaler(inputCol=vector, outputCol="__scaled", withMean=True, withStd=True),
        PCA(k=k, inputCol="__scaled", outputCol="components"),
    ]).fit(df)


def pca_loadings(model: Model, spark) -> DataFrame:
    """Explained share and loading per component and dimension (k x d rows)."""
    fitted = model.stages[-1]
    matrix, shares = fitted.pc.toArray(), fitted.explainedVariance.toArray()
    rows = [(c, d, float(shares[c]), float(matrix[d, c])) for c in range(matrix.shape[1]) for d in range(matrix.shape[0])]
    return literal_table(spark, rows, "component int, dimension int, explained double, loading double")


def platt_scale(held_out: DataFrame, df: DataFrame, score: str, label: str, out: str) -> DataFrame:
    """Logistic curve of the score, fitted on held-out rows."""
    as_vector = array_to_vector(F.array(F.col(score)))
    model = LogisticRegression(featuresCol="__v", labelCol="__y").fit(
        held_out.select(as_vector.alias("__v"), F.col(label).cast("double").alias("__y")))
    scored = model.setProbabilityCol("__p").setRawPredictionCol("__raw").setPredictionCol("__pred").transform(df.withColumn("__v", as_vector))
    return scored.withColumn(out, positive("__p")).drop("__v", "__p", "__raw", "__pred")


def isotonic_scale(held_out: DataFrame, df: DataFrame, score: str, label: str, out: str, bands: int = 1_000) -> DataFrame:
    """Rising step curve of the score, fitted on held-out rows.

    The fit ends on the driver, so scores are first drawn together into bands:
    the fit sees at most ``bands`` weighted points, whatever the table's size.
    """
    band = F.floor(F.col(score) * bands)
    points = held_out.groupBy(band.alias("__b")).agg(
        F.avg(score).alias("__s"), F.avg(F.col(label).cast("double")).alias("__y"), F.count(F.lit(1)).cast("double").alias("__w"))
    model = IsotonicRegression(featuresCol="__s", labelCol="__y", weightCol="__w").fit(points)
    return model.setPredictionCol(out).transform(df.withColumn("__s", F.col(score))).drop("__s")


def rolling_origin_mean(df: DataFrame, period: str, target: str, folds: Iterable[int] | None = None) -> DataFrame:
    """Backtest of the historical mean: trained on all earlier periods, tested
    on the next. Sums per period carry over, so rows are read twice only.

    Without ``folds`` every period that has an earlier one is a fold. A null
    period or target belongs to no fold.
    """
    df = df.filter(F.col(period).isNotNull() & F.col(target).isNotNull())
    sums = df.groupBy(period).agg(F.sum(target).alias("__s"), F.count(F.lit(1)).alias("__n"))
    if folds is None:
        grid_rows = sums.select(F.col(period).cast("bigint").alias("fold"))
    else:
        grid_rows = literal_table(df.sparkSession, [(int(f),) for f in folds], "fold bigint")
    # one row a period on either side
    history = grid_rows.join(sums, F.col(period) < F.col("fold")).groupBy("fold").agg(
        (F.sum("__s") / F.sum("__n")).alias("__mean"), F.sum("__n").alias("train_rows"))
    tested = df.join(history, F.col(period) == F.col("fold"))
    return tested.groupBy("fold", "train_rows").agg(
        F.count(F.lit(1)).alias("test_rows"), F.avg(F.abs(F.col(target) - F.col("__mean"))).alias("mae"))


def rolling_origin(df: DataFrame, period: str, folds: Iterable[int], make: Callable[[], Estimator], label: str) -> DataFrame:
    """Backtest of any estimator: fit on earlier periods, test on the next."""
    out = None
    for fold in folds:
        scored = make().fit(df.filter(F.col(period) < fold)).transform(df.filter(F.col(period) == fold))
        row = ev.regression_metrics(scored, label, "prediction").select(F.lit(fold).alias("fold"), "n", "mae", "rmse")
        out = row if out is None else out.unionByName(row)
    return out
