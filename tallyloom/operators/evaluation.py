"""Model quality measures and decision rules as DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans.literals import literal_table
from tallyloom.plans.ordering import average_ranks, exact_quantiles, running_sums


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, label, predicted).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: Sequence) -> DataFrame:
    """Counts for every pair of the given classes, zeros included."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pairs = literal_table(
        df.sparkSession, [(a, b) for a in classes for b in classes],
        f"`{label}` {kinds[label]}, `{predicted}` {kinds[predicted]}",
    )
    counts = confusion_counts(df, label, predicted)
    return pairs.join(counts, [label, predicted], "left").na.fill(0, ["n"])


def classification_report(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Per class (and group): support, precision, recall, F1. One shuffle of k x k counts."""
    counts = confusion_counts(df, label, predicted, by)
    hit = F.when(F.col(label) == F.col(predicted), F.col("n")).otherwise(0)
    sides = counts.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col(label).alias("class"), F.col("n").alias("a"), F.lit(0).cast("long").alias("p"), hit.cast("long").alias("tp")),
                F.struct(F.col(predicted).alias("class"), F.lit(0).cast("long").alias("a"), F.col("n").alias("p"), F.lit(0).cast("long").alias("tp")),
            )
        )
    )
    totals = sides.groupBy(*by, "class").agg(
        F.sum("a").alias("support"), F.sum("p").alias("predicted"), F.sum("tp").alias("tp")
    )
    rates = totals.withColumn("precision", _ratio(F.col("tp"), F.col("predicted"))).withColumn(
        "recall", _ratio(F.col("tp"), F.col("support"))
    )
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rates.withColumn("f1", f1).drop("tp")


def overall_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy (classes present in the labels), macro F1."""
    report = classification_report(df, label, predicted, by)
    return report.groupBy(*by).agg(
        _ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("f1").alias("macro_f1"),
    )


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve by average ranks, ties included."""
    values = average_ranks(df, score, {"pos": F.sum(F.col(label).cast("long"))}, by)
    sums = values.groupBy(*by).agg(
        F.sum(F.col("avg_rank") * F.col("pos")).alias("r"),
        F.sum("pos").cast("double").alias("n1"),
        (F.sum("n") - F.sum("pos")).cast("double").alias("n0"),
    )
    area = F.try_divide(F.col("r") - F.col("n1") * (F.col("n1") + 1) / 2, F.col("n1") * F.col("n0"))
    return sums.select(*by, area.alias("auc"))


def precision_recall_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Flagged, hits, precision and recall at every distinct score."""
    per_score = df.groupBy(score).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(F.col(label).cast("long")).alias("__pos")
    )
    stepped = running_sums(
        per_score.withColumn("__down", -F.col(score)), "__down",
        {"flagged": "__n", "hits": "__pos"}, totals=True,
    )
    return stepped.select(
        score, "flagged", "hits",
        _ratio(F.col("hits"), F.col("flagged")).alias("precision"),
        _ratio(F.col("hits"), F.col("total_hits")).alias("recall"),
    )


def ks_statistic(df: DataFrame, score: str, label: str) -> DataFrame:
    """Largest distance between the score distributions of both classes."""
    per_score = df.groupBy(score).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(F.col(label).cast("long")).alias("__pos")
    )
    stepped = running_sums(per_score, score, {"upto": "__n", "pos": "__pos"}, totals=True)
    gap = F.abs(
        _ratio(F.col("pos"), F.col("total_pos"))
        - _ratio(F.col("upto") - F.col("pos"), F.col("total_upto") - F.col("total_pos"))
    )
    return stepped.agg(F.max(gap).alias("ks"))


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and bias in one aggregation."""
    error = F.col(predicted) - F.col(actual)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(actual))).alias("r2"),
        F.avg(error).alias("bias"),
    )


def adjusted_rand_index(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two partitions, corrected for chance."""

    def pairs(n: Column) -> Column:
        return n.cast("double") * (n.cast("double") - 1) / 2

    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("rows"))
    columns = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("columns"))
    inner = cells.agg(F.sum(pairs(F.col("n"))).alias("both"), pairs(F.sum("n")).alias("all"))
    sums = inner.select("both", "all", rows.scalar().alias("rows"), columns.scalar().alias("columns"))
    expected = F.col("rows") * F.col("columns") / F.col("all")
    limit = (F.col("rows") + F.col("columns")) / 2
    return sums.select(F.try_divide(F.col("both") - expected, limit - expected).alias("ari"))


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Flagged, hits, recall and precision when score >= threshold.

    Rows are counted by the threshold range they fall into; the running sum
    then has one row per threshold, whatever the size of the table.
    """
    steps = sorted(thresholds)
    ranged = Bucketizer(
        splits=[-float("inf"), *steps, float("inf")], inputCol=score, outputCol="__step"
    ).transform(df.filter(F.col(score).isNotNull()))
    counts = ranged.groupBy(F.col("__step").cast("int").alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")
    )
    positives = counts.select(F.coalesce(F.sum("pos"), F.lit(0))).scalar()
    grid = literal_table(
        df.sparkSession, [(i + 1, float(v)) for i, v in enumerate(steps)], "step int, threshold double"
    )
    above = Window.orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = grid.join(counts, "step", "left").na.fill(0, ["n", "pos"])
    swept = swept.select(
        "threshold", F.sum("n").over(above).alias("flagged"), F.sum("pos").over(above).alias("hits")
    )
    return swept.select(
        "*",
        _ratio(F.col("hits"), positives).alias("recall"),
        _ratio(F.col("hits"), F.col("flagged")).alias("precision"),
    )


def choose_threshold(sweep: DataFrame, target_recall: float) -> DataFrame:
    """Highest threshold that keeps the recall; else the one of best recall."""
    good = F.when(F.col("recall") >= F.lit(target_recall), F.col("threshold"))
    best = F.max_by("threshold", F.struct("recall", -F.col("threshold")))
    return sweep.agg(F.coalesce(F.max(good), best).alias("threshold"))


def nearest_threshold(curve: DataFrame, threshold: str, wanted: float) -> DataFrame:
    """The row of a curve whose threshold is closest to ``wanted``."""
    row = F.min_by(F.struct("*"), F.struct(F.abs(F.col(threshold) - F.lit(wanted)), F.col(threshold)))
    return curve.agg(row.alias("__r")).select("__r.*")


def decide(p_low: Column, p_high: Column, low_at: float, high_at: float) -> Column:
    """Review flag first, then the premium label, else standard."""
    return (
        F.when(p_low >= F.lit(low_at), "Flag Low for Review")
        .when(p_high >= F.lit(high_at), "Premium")
        .otherwise("Standard")
    )


def policy_counts(df: DataFrame, flag: Column, truth: Column) -> DataFrame:
    """Caught, missed, false alarms, precision and recall of one flag."""
    caught, flagged, wanted = F.count_if(flag & truth), F.count_if(flag), F.count_if(truth)
    return df.agg(
        caught.alias("caught"), F.count_if(~flag & truth).alias("missed"),
        F.count_if(flag & ~truth).alias("false_alarms"), flagged.alias("flagged"),
        F.try_divide(caught, flagged).alias("precision"), F.try_divide(caught, wanted).alias("recall"),
    )


def error_category(truth: Column, predicted: Column, low: str, worse_first: Sequence[str]) -> Column:
    """``truth -> predicted`` text; an upward move from a lower class is a
    missed low (FN), a downward move from the middle is a false alarm (FP)."""
    rank = {name: i for i, name in enumerate(worse_first)}
    kind = F.when(truth == low, "FN").when(truth == worse_first[-1], "FN")
    middle = [n for n in rank if n not in (low, worse_first[-1])]
    kind = kind.when(truth.isin(middle), "FP").otherwise("FN")
    return F.when(truth == predicted, "Correct").otherwise(
        F.concat(truth, F.lit(" -> "), predicted, F.lit(" ("), kind, F.lit(")"))
    )


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (a, b] that holds the value, else null."""
    out = F.lit(None).cast("string")
    for low, high, name in reversed(list(zip(edges, edges[1:], labels))):
        out = F.when((value > F.lit(low)) & (value <= F.lit(high)), F.lit(name)).otherwise(out)
    return out


def ablation_verdict(df: DataFrame, name: str, reference: str, d_f1: str, d_balanced: str,
                     gain: float, drop: float) -> DataFrame:
    """Strong, marginal or rejected, from the change against the reference."""
    f1, balanced = F.col(d_f1), F.col(d_balanced)
    verdict = (
        F.when(F.col(name) == reference, "Reference")
        .when((f1 >= F.lit(gain)) & (balanced >= F.lit(drop)), "Strong candidate")
        .when((f1 > 0) & (f1 < F.lit(gain)), "Marginal gain only")
        .otherwise("Rejected")
    )
    return df.withColumn("verdict", verdict)


def residual_range(df: DataFrame, keys: Sequence[str], actual: str, predicted: str,
                   low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Range around the forecast from exact residual quantiles per slice."""
    residuals = df.withColumn("__res", F.col(actual) - F.col(predicted))
    spread = exact_quantiles(residuals, "__res", {"__lo": low, "__hi": high}, keys)
    return df.join(spread, list(keys), "left").withColumns(
        {"range_low": F.col(predicted) + F.col("__lo"), "range_high": F.col(predicted) + F.col("__hi")}
    ).drop("__lo", "__hi")


def check_targets(report: DataFrame, targets: Mapping[tuple[str, str], float]) -> DataFrame:
    """Compare class measures with their targets; pass means greater."""
    rows = [(c, m, float(v)) for (c, m), v in targets.items()]
    wanted = literal_table(report.sparkSession, rows, "class string, measure string, target double")
    long = report.unpivot(["class"], ["precision", "recall", "f1"], "measure", "value")
    return wanted.join(long, ["class", "measure"], "left").withColumn(
        "passed", F.coalesce(F.col("value") > F.col("target"), F.lit(False))
    )


def explain_errors(df: DataFrame, row_id: str, label: str, predicted: str, features: Sequence[str]) -> DataFrame:
    """Per wrong row and feature: is the value nearer to the mean of the
    predicted class than to the mean of the true class."""
    means = df.groupBy(label).agg(*[F.avg(f).alias(f"__m_{f}") for f in features])
    true_means = means.select(label, *[F.col(f"__m_{f}").alias(f"__t_{f}") for f in features])
    pred_means = means.select(F.col(label).alias(predicted), *[F.col(f"__m_{f}").alias(f"__p_{f}") for f in features])
    wrong = df.filter(F.col(label) != F.col(predicted)).join(true_means, label).join(pred_means, predicted)
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                (F.abs(F.col(f) - F.col(f"__p_{f}")) < F.abs(F.col(f) - F.col(f"__t_{f}"))).alias("misleading"),
            )
            for f in features
        ]
    )
    return wrong.select(row_id, label, predicted, F.inline(entries))


def rank_models(folds: DataFrame, model: str, score: str, digits: int = 6) -> DataFrame:
    """Mean and population deviation per model over its folds, rank, champion.

    One row per model, so a plain window ranks them.
    """
    means = folds.groupBy(model).agg(
        F.round(F.avg(score), digits).alias("mean"), F.round(F.stddev_pop(score), digits).alias("sd")
    )
    order = Window.orderBy(F.col("mean").desc())
    place = F.rank().over(order).cast("long")
    return means.withColumn("place", place).withColumn("champion", F.col("place") == 1)
