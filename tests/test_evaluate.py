import random

from tabml.operators import evaluate as ev
from tabml.operators import report as rp

SCHEMA = "model string, id string, split string, label int, score double, prediction int"


def _preds(spark, rows):
    return spark.createDataFrame([("m", str(i), "test", *r) for i, r in enumerate(rows)], SCHEMA)


def test_roc_one_point_per_distinct_score(spark):
    # tiny_preds_ties
    p = _preds(spark, [(1, 0.9, 1), (0, 0.9, 1), (1, 0.5, 1), (0, 0.5, 1), (0, 0.1, 0), (1, 0.1, 0)])
    roc = sorted((r.fpr, r.tpr) for r in ev.roc_curve(p).collect())
    assert roc == [(0.0, 0.0), (1 / 3, 1 / 3), (2 / 3, 2 / 3), (1.0, 1.0)] or \
        [(round(a, 6), round(b, 6)) for a, b in roc] == [(0.0, 0.0), (0.333333, 0.333333),
                                                         (0.666667, 0.666667), (1.0, 1.0)]
    assert ev.roc_auc(p).first().auc == 0.5


def test_single_class_predictions_zero_cells(spark):
    # tiny_preds_one_class
    p = _preds(spark, [(1, 0.8, 1), (1, 0.7, 1), (0, 0.6, 1), (0, 0.9, 1)])
    cm = {(r.label, r.prediction): r.n for r in ev.confusion_matrix(p).collect()}
    assert cm == {(0, 0): 0, (0, 1): 2, (1, 0): 0, (1, 1): 2}
    m = ev.model_metrics(p).first()
    assert m.specificity == 0.0 and m.sensitivity == 1.0 and m.precision == 0.5
    rep = {r["class"]: r for r in ev.classification_report(p).collect()}
    assert rep["Benign"].precision == 0.0 and rep["Benign"].f1 == 0.0
    assert rep["accuracy"].f1 == 0.5 and rep["weighted avg"].support == 4


def test_null_scores_absent_from_roc_and_one_hot_confidence(spark):
    # tiny_preds_noscore
    p = _preds(spark, [(1, None, 1), (0, None, 0), (1, None, 0), (0, None, 1)])
    assert ev.roc_curve(p).count() == 0
    conf = {r.id: (r.confidence, r.band, r.diagnosis) for r in rp.prediction_table(p).collect()}
    assert conf["0"] == (1.0, "high", "Malignant") and conf["1"] == (1.0, "high", "Benign")


def test_auc_equals_rank_sum(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), round(rng.random(), 2), 0) for _ in range(400)]
    p = _preds(spark, rows)
    pos = [s for lab, s, _ in rows if lab == 1]
    neg = [s for lab, s, _ in rows if lab == 0]
    u = sum((a > b_) + 0.5 * (a == b_) for a in pos for b_ in neg) / (len(pos) * len(neg))
    assert abs(ev.roc_auc(p).first().auc - round(u, 6)) < 1e-6


def test_confusion_cells_sum_to_n(spark):
    rng = random.Random(9)
    p = _preds(spark, [(rng.randint(0, 1), rng.random(), rng.randint(0, 1)) for _ in range(300)])
    assert sum(r.n for r in ev.confusion_matrix(p).collect()) == 300


def test_pruned_roc_keeps_corners(spark):
    p = _preds(spark, [(1, 0.9, 1), (1, 0.8, 1), (1, 0.7, 1), (0, 0.6, 1), (0, 0.5, 0), (0, 0.4, 0)])
    pts = sorted((r.fpr, r.tpr) for r in ev.roc_curve_pruned(p).collect())
    assert pts == [(0.0, 0.0), (0.0, 0.333333), (0.0, 1.0), (1.0, 1.0)]


def test_consensus_tie_goes_negative(spark):
    # tiny_vote_tie: 1-1 votes -> negative class
    p = spark.createDataFrame([("a", "x", "test", 1, None, 1), ("b", "x", "test", 1, None, 0)], SCHEMA)
    assert rp.consensus_vote(p).first().consensus == "Benign"
