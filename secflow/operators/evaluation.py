"""Classification and anomaly metrics, curves and threshold searches.

Counts are taken once per distinct score; curves come from running totals. A threshold search
never pairs rows with thresholds: every score is placed once between the sorted thresholds and
the confusion counts follow from suffix sums over at most a few hundred places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow.functions.columns import ratio_or_zero
from secflow.operators.ranking import exact_quantiles, quantile_array, running_totals

METRICS = ("f1", "precision", "recall", "accuracy")


def f1_of(precision: Column, recall: Column) -> Column:
    return ratio_or_zero(2 * precision * recall, precision + recall)


def rates(counts: DataFrame) -> DataFrame:
    """Append accuracy, precision, recall, f1, fpr and tnr to a table of tp, fp, tn, fn."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    with_base = counts.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, tp + fp + tn + fn),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "fpr": ratio_or_zero(fp, fp + tn),
            "tnr": ratio_or_zero(tn, fp + tn),
        }
    )
    return with_base.withColumn("f1", f1_of(F.col("precision"), F.col("recall")))


def confusion_counts(df: DataFrame, label: str, flag: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    truth, hit = F.col(label) == 1, F.col(flag) == 1
    return df.groupBy(*by).agg(
        F.count_if(truth & hit).alias("tp"),
        F.count_if(~truth & hit).alias("fp"),
        F.count_if(~truth & ~hit).alias("tn"),
        F.count_if(truth & ~hit).alias("fn"),
    )


def anomaly_metrics(df: DataFrame, label: str, flag: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One row (per group) of counts and rates for a 0/1 flag against a 0/1 label."""
    return rates(confusion_counts(df, label, flag, by))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, normalize: bool = False) -> DataFrame:
    """(actual, predicted, value) for all pairs of classes seen on either side; empty pairs are 0.

    The pairing runs over the class names of the counted cells, never over rows.
    """
    cells = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    names = cells.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
    every = names.agg(F.array_sort(F.collect_set("c")).alias("all"))
    grid = names.withColumn("all", every.scalar()).select(
        F.col("c").alias("actual"), F.explode("all").alias("predicted")
    )
    full = grid.join(cells, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if not normalize:
        return full.withColumnRenamed("n", "value")
    row = Window.partitionBy("actual")
    return full.select("actual", "predicted", ratio_or_zero(F.col("n"), F.sum("n").over(row)).alias("value"))


def class_report(df: DataFrame, actual: str, predicted: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(by..., class, precision, recall, f1, support) for every class on either side.

    Only class counts are joined.
    """
    by = list(by)
    cells = df.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )
    truth = cells.groupBy(*by, F.col("actual").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits")
    )
    guessed = cells.groupBy(*by, F.col("predicted").alias("class")).agg(F.sum("n").alias("guesses"))
    both = truth.join(guessed, [*by, "class"], "full").na.fill(0, ["support", "hits", "guesses"])
    shares = both.withColumns(
        {
            "precision": ratio_or_zero(F.col("hits"), F.col("guesses")),
            "recall": ratio_or_zero(F.col("hits"), F.col("support")),
        }
    )
    return shares.select(
        *by, "class", "precision", "recall", f1_of(F.col("precision"), F.col("recall")).alias("f1"), "support"
    )


def average_report(report: DataFrame, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Macro and support-weighted averages of a class report."""
    weight = F.col("support")
    out = []
    for c in ("precision", "recall", "f1"):
        out.append(F.avg(c).alias(f"macro_{c}"))
        out.append(ratio_or_zero(F.sum(F.col(c) * weight), F.sum(weight)).alias(f"weighted_{c}"))
    return report.groupBy(*by).agg(*out, F.sum("support").alias("support"), F.count("*").alias("classes"))


def classification_metrics(
    df: DataFrame, actual: str, predicted: str, by: list[str] | tuple[str, ...] = (), positive=None
) -> DataFrame:
    """accuracy, precision, recall, f1, classes: for one positive class, or support-weighted."""
    by = list(by)
    cells = df.groupBy(*by, actual, predicted).agg(F.count("*").alias("n"))
    right = F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0)
    accuracy = cells.groupBy(*by).agg(ratio_or_zero(F.sum(right), F.sum("n")).alias("accuracy"))
    report = class_report(df, actual, predicted, by)
    if positive is not None:
        chosen = report.filter(F.col("class") == positive).select(*by, "precision", "recall", "f1")
    else:
        chosen = average_report(report, by).select(
            *by, *[F.col(f"weighted_{c}").alias(c) for c in ("precision", "recall", "f1")]
        )
    classes = df.groupBy(*by).agg(F.count_distinct(actual).alias("classes"))
    zeros = {c: 0.0 for c in ("precision", "recall", "f1")}  # a positive class on neither side
    if by:
        return accuracy.join(chosen, by, "left").fillna(zeros).join(classes, by)
    one = F.lit(1)
    joined = accuracy.withColumn("_k", one).join(chosen.withColumn("_k", one), "_k", "left").fillna(zeros).join(classes.withColumn("_k", one), "_k")
    return joined.drop("_k")


def score_counts(df: DataFrame, score: str, label: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Distinct scores from the highest down with positives and negatives at and above each."""
    truth = F.col(label) == 1
    return running_totals(
        df, score, {"pos": F.count_if(truth), "neg": F.count_if(~truth)}, by, descending=True
    )


def roc_curve(df: DataFrame, score: str, label: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(by..., threshold, tpr, fpr) per distinct score; flagged means score >= threshold."""
    return score_counts(df, score, label, by).select(
        *by,
        F.col(score).alias("threshold"),
        ratio_or_zero(F.col("pos_upto"), F.col("pos_all")).alias("tpr"),
        ratio_or_zero(F.col("neg_upto"), F.col("neg_all")).alias("fpr"),
    )


def roc_auc(df: DataFrame, score: str, label: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Area under the ROC curve with ties grouped.

    Each tie group adds a trapezoid: its negatives times the positives above plus half its own,
    so no ordered pass over neighbours is needed.
    """
    area = F.sum(F.col("neg") * (F.col("pos_upto") - F.col("pos") / 2))
    return score_counts(df, score, label, by).groupBy(*by).agg(
        F.try_divide(area, (F.max("pos_all") * F.max("neg_all")).cast("double")).alias("auc"),
        F.max("pos_all").alias("positives"),
    )


def pr_curve(df: DataFrame, score: str, label: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    return score_counts(df, score, label, by).select(
        *by,
        F.col(score).alias("threshold"),
        ratio_or_zero(F.col("pos_upto"), F.col("pos_upto") + F.col("neg_upto")).alias("precision"),
        ratio_or_zero(F.col("pos_upto"), F.col("pos_all")).alias("recall"),
    )


def average_precision(df: DataFrame, score: str, label: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    step = ratio_or_zero(F.col("pos"), F.col("pos_all"))
    precision = ratio_or_zero(F.col("pos_upto"), F.col("pos_upto") + F.col("neg_upto"))
    return score_counts(df, score, label, by).groupBy(*by).agg(F.sum(step * precision).alias("average_precision"))


def multiclass_auc(long_scores: DataFrame, actual: str, cls: str, score: str) -> DataFrame:
    """One-vs-rest AUC weighted by class support, from one (row, class, score) row per class."""
    flagged = long_scores.withColumn("_is", (F.col(actual) == F.col(cls)).cast("int"))
    per_class = roc_auc(flagged, score, "_is", [cls])
    return per_class.agg(
        (F.sum(F.col("auc") * F.col("positives")) / F.sum("positives")).alias("auc"), F.count("*").alias("classes")
    )


def youden_point(df: DataFrame, score: str, label: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The threshold with the largest tpr - fpr, the highest one on ties."""
    curve = roc_curve(df, score, label, by).withColumn("j", F.col("tpr") - F.col("fpr"))
    best = F.max(F.struct("j", "threshold", "tpr", "fpr")).alias("b")
    return curve.groupBy(*by).agg(best).select(*by, "b.threshold", "b.tpr", "b.fpr", "b.j")


def sweep(df: DataFrame, score: str, label: str, grid: DataFrame, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Counts and rates at every threshold (flagged means score > threshold).

    ``grid`` has one row per group with a sorted array column ``thresholds``. A score's place is
    the number of thresholds strictly below it; threshold i flags exactly the places above i.
    """
    by = list(by)
    truth = F.col(label) == 1
    cells = df.groupBy(*by, score).agg(F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg"))
    if by:
        joined = cells.join(grid, by)
    else:
        joined = cells.withColumn("thresholds", grid.select("thresholds").scalar())
    place = F.size(F.filter("thresholds", lambda t: t < F.col(score)))
    places = joined.withColumn("place", place).groupBy(*by, "place").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    steps = grid.select(*by, F.posexplode("thresholds").alias("step", "threshold"))
    marks = steps.select(
        *by, F.col("step").alias("place"), F.lit(0).alias("pos"), F.lit(0).alias("neg"), "step", "threshold"
    )
    both = places.select(*by, "place", "pos", "neg", F.lit(None).cast("int").alias("step"),
                         F.lit(None).cast("double").alias("threshold")).unionByName(marks)
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = group.orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = both.select(
        *by, "step", "threshold",
        F.sum("pos").over(upto).alias("fn"), F.sum("neg").over(upto).alias("tn"),
        F.sum("pos").over(group).alias("_p"), F.sum("neg").over(group).alias("_n"),
    ).filter(F.col("step").isNotNull())
    return rates(
        counted.select(
            *by, "step", "threshold", (F.col("_p") - F.col("fn")).alias("tp"), (F.col("_n") - F.col("tn")).alias("fp"),
            "tn", "fn",
        )
    )


def percentile_grid(df: DataFrame, score: str, count: int = 100, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``count`` score percentiles evenly spread over 0..100."""
    totals = running_totals(df, score, {"n": F.count("*")}, by)
    found = quantile_array(totals, score, [i / (count - 1) for i in range(count)], by)
    return found.withColumnRenamed("quantiles", "thresholds")


def linear_grid(df: DataFrame, score: str, low: float, high: float, count: int, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``count`` evenly spaced thresholds between two score quantiles."""
    ends = exact_quantiles(df, score, {"_lo": low, "_hi": high}, by)
    step = (F.col("_hi") - F.col("_lo")) / (count - 1)
    spaced = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.col("_lo") + i * step)
    return ends.select(*by, spaced.alias("thresholds"))


def two_sided(swept: DataFrame) -> DataFrame:
    """Keep thresholds that leave rows on both sides."""
    return swept.filter((F.col("tp") + F.col("fp") > 0) & (F.col("tn") + F.col("fn") > 0))


def best_step(swept: DataFrame, metric: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The first threshold with the largest metric."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    fields = ["threshold", "accuracy", "precision", "recall", "f1"]
    best = F.max(F.struct(F.col(metric).alias("_m"), (-F.col("step")).alias("_first"), *fields)).alias("b")
    return swept.groupBy(*by).agg(best).filter("b IS NOT NULL").select(*by, *[F.col(f"b.{c}").alias(c) for c in fields])


def best_percentile_threshold(df: DataFrame, score: str, label: str, metric: str = "f1", by=()) -> DataFrame:
    return best_step(sweep(df, score, label, percentile_grid(df, score, 100, by), by), metric, by)


def best_linear_threshold(
    df: DataFrame, score: str, label: str, metric: str = "f1", low: float = 0.9, high: float = 1.0, by=()
) -> DataFrame:
    """Best of 100 even steps between two quantiles; the mean score with zero metrics if none splits the rows."""
    by = list(by)
    swept = two_sided(sweep(df, score, label, linear_grid(df, score, low, high, 100, by), by))
    best = best_step(swept, metric, by)
    fallback = df.groupBy(*by).agg(F.avg(score).alias("_mean"))
    keys = by or ["_k"]
    if not by:
        best, fallback = best.withColumn("_k", F.lit(1)), fallback.withColumn("_k", F.lit(1))
    zero = F.lit(0.0)
    return fallback.join(best, keys, "left").select(
        *by, F.coalesce("threshold", "_mean").alias("threshold"),
        *[F.coalesce(c, zero).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
    )


def threshold_table(df: DataFrame, score: str, label: str, count: int = 200, by=()) -> DataFrame:
    """All metrics at even steps between the 1st and 99th percentile."""
    return two_sided(sweep(df, score, label, linear_grid(df, score, 0.01, 0.99, count, by), by))


def threshold_placement(df: DataFrame, score: str, label: str, best: DataFrame, low: float = 0.9, high: float = 1.0) -> DataFrame:
    """Where a chosen threshold lies in its search range and how far it is from the class medians."""
    ends = exact_quantiles(df, score, {"lo": low, "hi": high})
    medians = exact_quantiles(df, score, {"median": 0.5}, [label])
    middle = medians.groupBy().agg(
        F.max(F.when(F.col(label) == 0, F.col("median"))).alias("median_normal"),
        F.max(F.when(F.col(label) == 1, F.col("median"))).alias("median_anomaly"),
    )
    one = best.select("threshold", F.lit(1).alias("_k"))
    joined = one.join(ends.withColumn("_k", F.lit(1)), "_k").join(middle.withColumn("_k", F.lit(1)), "_k")
    t = F.col("threshold")
    return joined.select(
        "threshold",
        (100 * F.try_divide(t - F.col("lo"), F.col("hi") - F.col("lo"))).alias("position_pct"),
        F.abs(t - F.col("median_normal")).alias("gap_to_normal"),
        F.abs(t - F.col("median_anomaly")).alias("gap_to_anomaly"),
    )


def compare_models(metrics: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row per model from metric tables with equal columns."""
    parts = [df.select(F.lit(name).alias("model"), *df.columns) for name, df in metrics]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evaluation_report(scored: DataFrame, models: list[str], label: str) -> DataFrame:
    """Metrics of several flag columns ``<model>_flag`` against one label, from one pass."""
    long = scored.unpivot([label], [f"{m}_flag" for m in models], "_name", "_flag")
    named = long.withColumn("model", F.regexp_replace("_name", "_flag$", ""))
    return anomaly_metrics(named, label, "_flag", ["model"])


def metrics_by_target(scored: DataFrame, models: list[str], targets: list[str]) -> DataFrame:
    """Metrics per (model, target): both sides are unpivoted in one scan."""
    pairs = [
        F.struct(F.lit(m).alias("model"), F.lit(t).alias("target"), F.col(t).alias("truth"), F.col(f"{m}_flag").alias("flag"))
        for m in models for t in targets
    ]
    long = scored.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    return anomaly_metrics(long, "truth", "flag", ["model", "target"])
