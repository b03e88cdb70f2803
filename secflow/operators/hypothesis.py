"""Statistical tests: Spark aggregates give the statistic, a closed form gives the p-value."""

from __future__ import annotations

from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.functions import special
from secflow.functions.columns import long_form
from secflow.operators.ranking import average_ranks, cuts_below, exact_quantiles, running_totals
from secflow.session import cut_lineage


def ks_normality(df: DataFrame, column: str) -> DataFrame:
    """Kolmogorov-Smirnov distance to the normal with the column's mean and sample deviation."""
    data = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    m, s = data.agg(F.avg("x"), F.stddev_samp("x")).head()
    found = KolmogorovSmirnovTest.test(data, "x", "norm", m, s)
    return found.select(F.lit(column).alias("column"), F.col("statistic"), F.col("pValue").alias("p_value"))


def k2_normality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Omnibus normality test per column from population skewness and kurtosis.

    K2 adds the squared transformed skewness and kurtosis scores; its tail with two degrees of
    freedom is exp(-K2 / 2), so no distribution function is needed.
    """
    m = long_form(df, columns).filter("value IS NOT NULL").groupBy("column").agg(
        F.count("*").cast("double").alias("n"), F.skewness("value").alias("skew"), F.kurtosis("value").alias("excess")
    )
    n = F.col("n")
    y = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    delta, alpha = 1 / F.sqrt(F.log(w2) / 2), F.sqrt(2 / (w2 - 1))
    z_skew = delta * F.asinh(y / alpha)

    mean_b2 = 3 * (n - 1) / (n + 1)
    var_b2 = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("excess") + 3 - mean_b2) / F.sqrt(var_b2)
    root_b1 = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root_b1 * (2 / root_b1 + F.sqrt(1 + 4 / (root_b1 * root_b1)))
    inner = F.cbrt((1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4))))
    z_kurt = (1 - 2 / (9 * a) - inner) / F.sqrt(2 / (9 * a))
    k2 = z_skew * z_skew + z_kurt * z_kurt
    return m.select("column", "skew", "excess", k2.alias("statistic"), F.exp(-k2 / 2).alias("p_value"))


def mann_whitney(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Two-sided rank test of class 0 against class 1 per column, with an effect size.

    Ranks come from counts of distinct values; ties share their average rank and enter the
    variance correction. Effect: gap of the medians over the deviation of class 0.
    """
    long = long_form(df, columns, [label]).filter("value IS NOT NULL")
    first = F.col(label) == 0
    ranked = average_ranks(long, "value", ["column"], {"n0": F.count_if(first)})
    sums = ranked.groupBy("column").agg(
        F.sum(F.col("n0") * F.col("rank")).alias("rank_sum"),
        F.sum("n0").cast("double").alias("n0"),
        F.sum("n").cast("double").alias("n"),
        F.sum(F.pow("n", F.lit(3)) - F.col("n")).alias("ties"),
    )
    n0, n = F.col("n0"), F.col("n")
    n1 = n - n0
    u = F.col("rank_sum") - n0 * (n0 + 1) / 2
    spread = F.sqrt(n0 * n1 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = (F.greatest(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5) / spread
    medians = exact_quantiles(long, "value", {"median": 0.5}, ["column", label])
    middle = medians.groupBy("column").agg(
        F.max(F.when(first, F.col("median"))).alias("m0"), F.max(F.when(~first, F.col("median"))).alias("m1")
    )
    spread0 = long.filter(first).groupBy("column").agg(F.stddev_samp("value").alias("s0"))
    joined = sums.join(middle, "column").join(spread0, "column")
    return joined.select(
        "column", u.alias("u"), F.try_divide(F.abs(F.col("m0") - F.col("m1")), F.col("s0")).alias("effect"),
        special.normal_p(z).alias("p_value"),
    )


def uniform_chi_square(df: DataFrame, label: str) -> DataFrame:
    """Goodness of fit of the class counts to equal classes."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = F.sum("n")
    # Sum of (n - e)^2 / e with e = total / k reduces to k * sum(n^2) / total - total.
    stat = F.count("*") * F.sum(F.col("n") * F.col("n")) / total - total
    return counts.agg(stat.alias("statistic"), F.count("*").alias("classes")).select(
        "classes", "statistic", special.chi2_p("statistic", F.col("classes") - 1).alias("p_value")
    )


def three_way_chi_square(df: DataFrame) -> DataFrame:
    """Goodness of fit of normal, suspicious and evil counts to a third of the rows each."""
    sus, evil = F.col("sus") == 1, F.col("evil") == 1
    c = df.agg(
        F.count("*").alias("n"), F.count_if(~sus & ~evil).alias("a"), F.count_if(sus).alias("b"), F.count_if(evil).alias("c")
    )
    third = F.col("n") / 3
    stat = sum((F.pow(F.col(k) - third, F.lit(2)) / third for k in ("a", "b", "c")), F.lit(0.0))
    return c.select(stat.alias("statistic")).select("statistic", special.chi2_p("statistic", F.lit(2)).alias("p_value"))


def spearman(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Rank correlation of each column with the target, its p-value and a strength band."""
    long = long_form(df.withColumn("_t", F.col(target).cast("double")), columns, ["_t"])
    long = long.filter("value IS NOT NULL AND _t IS NOT NULL")
    # Stored, so that the rows are read and collapsed once; both ranks follow from the counts.
    cells = cut_lineage(long.groupBy("column", "value", "_t").agg(F.count("*").alias("w")))
    size = {"n": F.sum("w")}
    x = average_ranks(cells, "value", ["column"], size).select("column", "value", F.col("rank").alias("rx"))
    y = average_ranks(cells, "_t", ["column"], size).select("column", "_t", F.col("rank").alias("ry"), F.col("n_all").alias("rows"))
    ranked = cells.join(x, ["column", "value"]).join(y, ["column", "_t"])
    middle = (F.col("rows") + 1) / 2
    dx, dy, w = F.col("rx") - middle, F.col("ry") - middle, F.col("w")
    found = ranked.groupBy("column").agg(
        (F.sum(w * dx * dy) / F.sqrt(F.sum(w * dx * dx) * F.sum(w * dy * dy))).alias("rho"), F.max("rows").alias("n")
    )
    rho, size = F.col("rho"), F.abs(F.col("rho"))
    t = rho * F.sqrt((F.col("n") - 2) / (1 - rho * rho))
    strength = F.when(size > 0.5, "Strong").when(size > 0.3, "Moderate").otherwise("Weak")
    return found.select("column", "rho", strength.alias("strength"), special.student_p(t, F.col("n") - 2).alias("p_value"))


def class_moments(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(column, label, n, mean, var): the only pass over the rows that the F-test needs."""
    return long_form(df, columns, [label]).filter("value IS NOT NULL").groupBy("column", label).agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("var")
    )


def anova(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """One-way F statistic per column from class sizes, means and variances."""
    groups = class_moments(df, columns, label)
    overall = groups.groupBy("column").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"))
    n, k = F.sum("n"), F.count("*")
    between = F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), F.lit(2)))
    within = F.sum(F.col("n") * F.col("var"))
    found = groups.join(overall, "column").groupBy("column").agg(
        F.try_divide(between / (k - 1), within / (n - k)).alias("score"), (k - 1).alias("_d1"), (n - k).alias("_d2")
    )
    return found.select("column", "score", special.f_p("score", "_d1", "_d2").alias("p_value"))


def chi2_scores(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Chi-square of per-class feature sums (values shifted to start at 0) against class shares."""
    groups = long_form(df, columns, [label]).filter("value IS NOT NULL").groupBy("column", label).agg(
        F.count("*").alias("n"), F.sum("value").alias("total"), F.min("value").alias("low")
    )
    whole = groups.groupBy("column").agg(F.min("low").alias("_low"), F.sum("n").alias("_n"), F.sum("total").alias("_total"))
    joined = groups.join(whole, "column")
    observed = F.col("total") - F.col("n") * F.col("_low")
    expected = F.col("n") / F.col("_n") * (F.col("_total") - F.col("_n") * F.col("_low"))
    term = F.try_divide(F.pow(observed - expected, F.lit(2)), expected)
    found = joined.groupBy("column").agg(F.sum(term).alias("score"), (F.count("*") - 1).alias("_d"))
    return found.select("column", "score", special.chi2_p("score", "_d").alias("p_value"))


def binned_mutual_information(df: DataFrame, columns: list[str], label: str, bins: int = 20) -> DataFrame:
    """Mutual information (nats) of each column with the label, the column cut into bins of about equal counts.

    The rows below a value give its bin, so equal values share one and far values widen no other. The rows are read
    and collapsed once; a value finds its bin among the highest values of the bins, a few numbers per column.
    """
    long = long_form(df, columns, [label]).filter("value IS NOT NULL")
    counts = cut_lineage(long.groupBy("column", "value", label).agg(F.count("*").alias("c")))
    below = running_totals(counts, "value", {"n": F.sum("c")}, ["column"])
    spot = F.floor((F.col("n_upto") - F.col("n")) * bins / F.col("n_all"))
    ends = below.groupBy("column", spot.alias("_bin")).agg(F.max("value").alias("_end"), F.max("n_all").alias("_n"))
    ends = ends.groupBy("column").agg(F.array_sort(F.collect_list("_end")).alias("_ends"), F.max("_n").alias("_n"))
    placed = counts.join(F.broadcast(ends), "column").withColumn("_bin", cuts_below(F.col("_ends"), F.col("value"), bins))
    cells = placed.groupBy("column", "_n", "_bin", label).agg(F.sum("c").alias("c"))
    by_bin = cells.groupBy("column", "_bin").agg(F.sum("c").alias("b"))
    by_label = cells.groupBy("column", label).agg(F.sum("c").alias("l"))
    joined = cells.join(by_bin, ["column", "_bin"]).join(by_label, ["column", label])
    share = F.col("c") / F.col("_n")
    gain = share * F.log(F.col("c") * F.col("_n") / (F.col("b") * F.col("l")))
    return joined.groupBy("column").agg(F.sum(gain).alias("score"))
