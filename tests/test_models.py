"""Classifiers, searches, selection and metrics on small fixtures with a planted signal."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from secflow.operators import evaluation, hypothesis, selection, supervised, tuning, two_stage
from secflow.sources import readers, schemas, sinks


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        x, y, noise = rng.normal(size=3)
        label = int(x + 0.5 * y > 0)
        kind = "Normal" if not label else ("Dos" if x > 0.7 else "Scan")
        rows.append((i, float(x), float(y), float(noise), "ab"[label] if rng.random() < 0.7 else "c", label, kind))
    df = spark.createDataFrame(rows, "row_id long, x double, y double, noise double, proto string, label int, attack_cat string")
    return df.cache()


COLS = {"numeric": ["x", "y", "noise"], "text": ["proto"]}


@pytest.mark.parametrize("model", [
    supervised.LogisticClassifier(**COLS, most_rounds=30),
    supervised.ForestClassifier(**COLS, trees=10, depth=5),
    supervised.BoostedClassifier(**COLS, trees=5, depth=3),
])
def test_classifier_beats_chance(spark, planted, model):
    got = supervised.compare_classifiers({"m": model.fit(planted)}, planted).head()
    assert got["accuracy"] > 0.85 and got["f1"] > 0.8
    unseen = planted.limit(5).withColumn("proto", F.lit("never seen"))
    assert model.predict(unseen).count() == 5


def test_boosting_importances_and_multiclass(spark, planted):
    model = supervised.BoostedClassifier(**COLS, trees=5, depth=3, early_stop=True).fit(planted, planted)
    for kind in ("gain", "weight", "cover"):
        rows = model.importances(spark, kind).collect()
        assert len(rows) == 4 and max(rows, key=lambda r: r["importance"])["importance"] > 0
    many = supervised.BoostedClassifier(**COLS, label="attack_cat", trees=3, depth=3).fit(planted)
    scored = many.predict(planted)
    assert scored.filter(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, b: a + b) - 1) > 1e-6).count() == 0
    assert scored.filter("prediction = attack_cat").count() > 200


def test_two_stage_run(planted):
    train, test = planted.filter("row_id % 2 = 0"), planted.filter("row_id % 2 = 1")
    final = two_stage.run_two_stage(
        train, test, supervised.BoostedClassifier(**COLS, trees=5, depth=3),
        supervised.ForestClassifier(**COLS, label="attack_cat", trees=10, depth=5))
    counts = two_stage.outcome_counts(final, "attack_cat").head()
    assert counts["rows"] == 150 and counts["accuracy"] > 0.75
    assert sum(counts[c] for c in ("true_normal", "false_alarm", "missed", "right_type", "wrong_type")) == 150


def test_two_stage_run_with_new_rows(planted):
    train, test = planted.filter("row_id % 2 = 0"), planted.filter("row_id % 2 = 1")
    attacks = two_stage.attacks_only(train)
    balanced = two_stage.balanced_attacks(attacks, "attack_cat", COLS["numeric"], COLS["text"])
    sizes = {r["attack_cat"]: r["count"] for r in balanced.groupBy("attack_cat").count().collect()}
    assert len(set(sizes.values())) == 1 and set(balanced.columns) == {"row_id", "attack_cat", "x", "y", "noise", "proto"}
    for c in COLS["numeric"]:  # between rows of the class, so inside its range
        of = [d.groupBy("attack_cat").agg(F.min(c).alias("lo"), F.max(c).alias("hi")).orderBy("attack_cat").collect() for d in (attacks, balanced)]
        assert all(a["lo"] <= b["lo"] + 1e-9 and b["hi"] <= a["hi"] + 1e-9 for a, b in zip(*of))
    final = two_stage.run_two_stage(train, test, supervised.BoostedClassifier(**COLS, trees=5, depth=3),
                                    supervised.ForestClassifier(**COLS, label="attack_cat", trees=10, depth=5), "oversample")
    assert two_stage.outcome_counts(final, "attack_cat").head()["accuracy"] > 0.75


def test_predictions_of_all_models_in_one_scan(planted):
    models = {m.name: m.fit(planted) for m in (supervised.LogisticClassifier(**COLS, most_rounds=10), supervised.BoostedClassifier(**COLS, trees=3, depth=2))}
    table = supervised.prediction_table(models, planted)
    assert table.columns == ["row_id", "true_label", "logistic_regression_pred", "logistic_regression_proba", "boosted_trees_pred", "boosted_trees_proba"]
    alone = models["logistic_regression"].predict(planted).select("row_id", F.col("probability")[1].alias("p"))
    assert table.join(alone, "row_id").filter(F.abs(F.col("p") - F.col("logistic_regression_proba")) < 1e-12).count() == 300
    assert "Join" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_searches(planted):
    found = tuning.tune_logistic(planted, {"C": [0.001, 1.0], "penalty": ["l2"]}, 2, **COLS, most_rounds=10).collect()
    assert [r["rank"] for r in found] == [1, 2] and found[0]["mean"] >= found[1]["mean"] > 0.5
    one = tuning.tune_logistic(planted, {"C": [0.001, 1.0], "penalty": ["l2"]}, 2, **COLS, most_rounds=10, top=1).collect()
    assert one == found[:1]
    assert len(tuning.draw(tuning.BOOSTED_GRID, 50)) == 50
    assert len(tuning.combinations(tuning.FOREST_GRID)) == 216


def test_selectors_find_the_signal(planted):
    columns = ["noise", "x", "y"]
    assert selection.stepwise(planted, columns, "label", 1, True, 2) == ["x"]
    assert set(selection.stepwise(planted, columns, "label", 2, False, 2)) == {"x", "y"}
    ranks = {r["feature"]: r["ranking"] for r in selection.by_elimination(planted, columns, "label", 1).collect()}
    assert ranks["x"] == 1 and ranks["noise"] == 3
    assert "x" in [r["feature"] for r in selection.by_lasso(planted, columns, "label", 3, 5).collect()]
    votes = {r["feature"]: r["consensus_count"] for r in selection.comprehensive(planted, columns, "label", 2).collect()}
    assert votes["x"] == 6 and votes["x"] > votes["noise"]


def test_six_methods_run_the_backward_search(spark):
    """The sum of two columns tells the label, so the search keeps both; the F-test ranks a noisy copy before either."""
    rows = [(i, i % 20 - 10 + 0.1, i // 20 % 20 - 10 + 0.2) for i in range(400)]
    df = spark.createDataFrame([(a, b, a + b + (i * 37 % 11 - 5.0), int(a + b > 0)) for i, a, b in rows], "a double, b double, c double, label int")
    found = selection.comprehensive(df, ["a", "b", "c"], "label", 2)
    assert {r["feature"] for r in found.filter("backward").collect()} == set(selection.stepwise(df, ["a", "b", "c"], "label", 2, False)) == {"a", "b"}
    assert "c" in {r["feature"] for r in found.filter("univariate").collect()}
    every = selection.comprehensive(df, ["a", "b", "c"], "label")  # more than there are
    assert every.filter("backward AND univariate").count() == 3


def test_the_supervised_pipeline_keeps_the_best_columns_only(spark, monkeypatch):
    from secflow.plans import pipelines

    flows = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("label"), F.lit("p").alias("proto"),
                                    *[(F.xxhash64(F.lit(i), "id") % 100 + F.col("id") % 2 * i).cast("double").alias(f"c{i}") for i in range(40)])
    seen = []
    monkeypatch.setattr(pipelines, "flow_view", lambda spark, sf_dir: flows)
    monkeypatch.setattr(pipelines.loading, "prepare_flows", lambda halves: halves)
    monkeypatch.setattr(pipelines, "cut_lineage", lambda df: seen.append(df.columns) or df)
    monkeypatch.setattr(pipelines.su, "train_standard", lambda train, **options: seen.append((train.count(), options["random_forest"]["numeric"])) or {})
    monkeypatch.setattr(pipelines.su, "compare_classifiers", lambda models, test: test)
    assert pipelines.supervised_pipeline(spark, "").count() == 100
    (kept,), (rows, best) = seen[:-1], seen[-1]
    assert kept == ["row_id", "label", "split", *best] and len(best) == 30 and rows == 100


def test_ties_and_single_class_scores(spark):
    flat = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "score double, label int")
    assert evaluation.roc_auc(flat, "score", "label").head()["auc"] == 0.5
    best = evaluation.best_linear_threshold(flat, "score", "label").head()
    assert best["threshold"] == 1.0 and best["f1"] == 0.0
    one = spark.createDataFrame([(1.0, 1), (2.0, 1)], "score double, label int")
    assert evaluation.roc_auc(one, "score", "label").head()["auc"] is None


def test_p_values(spark):
    from secflow.functions import special

    assert special.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert special.chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert special.student_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert special.f_tail(4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    df = spark.createDataFrame([(float(i), int(i >= 5)) for i in range(10)], "x double, label int")
    got = hypothesis.mann_whitney(df, ["x"], "label").head()
    assert got["u"] == 0 and got["p_value"] == pytest.approx(0.01219, abs=1e-4)


def test_sources_and_sinks(spark, tmp_path):
    rows = [(1.5, 1, 2, 3, 4, 5, "p", "h", 6, "e", "s", 1, 0, "[]", 0, 0)]
    raw = spark.createDataFrame(rows, schemas.SYSCALL)
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        raw.write.option("header", True).format(fmt).save(path)
        back = readers.read_syscalls(spark, {"train": path, "test": path}, fmt)
        assert back.count() == 2 and back.filter("split = 'train'").first()["hostName"] == "h"
    done = sinks.write_processed(back, str(tmp_path / "done"), suffix="_tfidf")
    assert spark.read.parquet(done).filter("split = 'test'").count() == 1
    metrics = spark.createDataFrame([("m", 0.5)], "model string, f1 double")
    assert readers.read_metrics(spark, sinks.write_metrics(metrics, str(tmp_path / "m.json")), metrics.schema).collect() == metrics.collect()
    table = sinks.write_result(metrics, str(tmp_path / "r"))
    assert readers.read_result(spark, table, metrics.schema).collect() == metrics.collect()
    assert readers.read_result(spark, str(tmp_path / "absent"), metrics.schema).count() == 0


def test_searches_see_whole_grids_and_all_columns(spark, monkeypatch):
    from secflow.operators import selection, tuning
    from secflow.plans import load_all
    from secflow.plans.selection import BASE

    seen = {}

    def searched(df, kind, settings, folds, **fixed):
        seen[kind.__name__] = (len(settings), folds, set(fixed))
        return df

    monkeypatch.setattr(tuning, "cross_validate", searched)
    monkeypatch.setattr(tuning, "_arrays", lambda df, model: seen.update(columns={(*model.numeric, *model.text)}) or df)
    monkeypatch.setattr(tuning, "_ranked", lambda spark, settings, scores, top: scores)
    for name in ("forest", "boosted"):
        monkeypatch.setattr(tuning.tree_search, f"search_{name}", lambda df, settings, folds, most, name=name: seen.update({name: (len(settings), folds, most)}) or df)
    monkeypatch.setattr(tuning, "tune_mixture", lambda df, counts, kinds: seen.update(mixture=(counts, len(kinds))) or df)
    monkeypatch.setattr(selection, "stepwise", lambda df, columns, label, n, forward, *rest: seen.update({forward: (columns, rest)}) or columns[:n])
    monkeypatch.setattr(tuning, "tune_dbscan", lambda df, radii, least, label: seen.update(density=(len(radii), len(least))) or df)
    for name in ("density_search", "logistic_search", "forest_search", "boosted_search", "mixture_search", "selection_forward", "selection_backward"):
        load_all()[name].plan(spark, "/root/testdata/sf0.001")
    columns = {"numeric", "text"}
    assert seen == {"LogisticClassifier": (12, 5, columns), "forest": (216, 3, 40_000), "boosted": (50, 3, 40_000),
                    "columns": {("sbytes", "dbytes", "spkts", "dload", "sttl", "service", "state")}, "mixture": (list(range(2, 11)), 4), "density": (5, 5), True: (BASE, ()), False: (BASE, ())}
