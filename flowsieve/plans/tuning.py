"""Jobs that fit one model, choose its cut and evaluate it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowsieve.ml.classifiers import (
    attack_probability,
    fit_logistic_regression,
    fit_random_forest,
    predicted_class,
)
from flowsieve.ml.isolation import fit_isolation_forest
from flowsieve.ml.sampling import stratified_split
from flowsieve.operators import evaluation, sweeps
from flowsieve.plans.evaluation import stored
from flowsieve.plans.training import normal_rows
from flowsieve.schema import ANOMALY_CUTS, PROBABILITY_CUTS


def tune_random_forest(
    train: DataFrame,
    test: DataFrame,
    trees: int = 200,
    cuts: list[float] = PROBABILITY_CUTS,
    seed: int = 42,
    **options,
) -> dict[str, DataFrame]:
    """Fit on 80 % of the training rows, choose the cut on the other 20 %, evaluate on test rows."""
    fitting, validation = stratified_split(train, seed=seed)
    model = fit_random_forest(fitting, trees, seed=seed, **options)
    scores = [
        stored(attack_probability(model, rows).select("label", "target", "rf_probability"), name)
        for rows, name in ((validation, "validation-scores"), (test, "test-scores"))
    ]
    sweep = sweeps.probability_sweep(scores[0], cuts)
    return {
        "sweep": sweep,
        "best": sweeps.best_threshold(sweep),
        "test": sweeps.evaluate_at_best(sweep, scores[1]),
        "scores": scores[1],
    }


def tune_isolation(
    train: DataFrame,
    test: DataFrame,
    trees: int = 200,
    cuts: list[float] = ANOMALY_CUTS,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Fit on the normal training rows and sweep the anomaly cut over the scored rows.

    Choosing the cut on the rows it is reported for flatters the result; pass validation rows as
    ``test`` where the cut is to be used elsewhere.
    """
    forest = fit_isolation_forest(normal_rows(train), trees, seed=seed)
    scores = stored(forest.score(test).select("label", "target", "if_score"), "anomaly-scores")
    sweep = sweeps.anomaly_sweep(scores, cuts)
    return {
        "sweep": sweep,
        "best": sweeps.best_threshold(sweep),
        "test": sweeps.evaluate_at_best(sweep, scores, "if_score", orientation="anomaly"),
        "scores": scores,
    }


def baseline(train: DataFrame, test: DataFrame, max_iter: int = 1000) -> dict[str, DataFrame]:
    """Logistic regression with scaled numbers: class metrics and the classification report."""
    model = fit_logistic_regression(train, max_iter)
    classes = stored(predicted_class(model, test).select("target", "predicted"), "classes")
    return {
        "metrics": evaluation.class_metrics(classes, "target", "predicted"),
        "report": evaluation.classification_report(classes, "target", "predicted"),
    }
