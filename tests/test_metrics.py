"""Exact metric fixtures (the reference's documented 10-element example) and edge cases."""

import pytest
from pyspark.sql import functions as F

from churnlens.operators import evaluate as E

Y = [0, 1, 1, 0, 1, 0, 1, 1, 0, 0]
P = [0, 1, 1, 0, 0, 0, 1, 1, 0, 1]


@pytest.fixture()
def pairs(spark):
    return spark.createDataFrame(list(zip(Y, P)), "label int, prediction int")


def test_confusion(pairs):
    r = E.confusion(pairs).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (4, 1, 1, 4)


def test_metrics_all_point_eight(pairs):
    r = E.classification_metrics(pairs).first()
    assert r.accuracy == r.precision == r.recall == r.f1 == r.roc_auc == 0.8
    assert r.n == 10


def test_business(pairs):
    r = E.business_metrics(pairs).first()
    assert r.actual_churn_rate == 0.5 and r.predicted_churn_rate == 0.5
    assert r.churn_capture_rate == 0.8 and r.false_alarm_rate == 0.2 and r.missed_churn_rate == 0.2


def test_no_positive_predictions_and_single_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    r = E.classification_metrics(df).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.roc_auc == 0.0


def test_empty_input_raises(spark):
    df = spark.createDataFrame([], "label int, prediction int")
    with pytest.raises(Exception, match="empty input"):
        E.classification_metrics(df).collect()


def test_report_rows(pairs):
    rows = {r["class"]: r for r in E.classification_report(pairs).collect()}
    assert rows["1"].support == 5 and rows["accuracy"].precision == 0.8
    assert rows["macro avg"].f1_score == 0.8


def test_auc_ties_match_sklearn_definition(spark):
    # scores with ties: AUC = P(s+ > s-) + 0.5 P(s+ = s-)
    data = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1), (0, 0.3)]
    df = spark.createDataFrame(data, "label int, score double")
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert E.auc_from_scores(df).first().roc_auc == round(expected, 6)


def test_champion_challenger(spark):
    cur = spark.createDataFrame([(0.60,)], "f1 double")
    better = spark.createDataFrame([(0.63,)], "f1 double")
    close = spark.createDataFrame([(0.615,)], "f1 double")
    assert E.champion_challenger(cur, better).first().accepted == 1
    assert E.champion_challenger(cur, close).first().accepted == 0
    assert E.champion_challenger(None, close).first().accepted == 1


def test_gates(spark):
    m = spark.createDataFrame([("train", 0.70, 0.9), ("test", 0.62, 0.85)], "split string, f1 double, accuracy double")
    gap = E.train_test_gap(m)
    g = E.quality_gates(gap).first()
    assert g.passed == 1 and g.overfit_warning == 1
    assert gap.first().is_overfit == 0
