"""Training, search and importances on the planted label."""
from pyspark.sql import functions as F

from ..operators import models, split, tuning
from ..plans.profile import customer_profile
from ..session import stored
from . import query
from .exploring import _rounded
from ..operators.metrics import evaluate

COLUMNS = ["Tenure", "CityTier", "WarehouseToHome", "NumberOfAddress", "Complain", "CouponUsed", "OrderCount", "DaySinceLastOrder"]
LABEL, KEY = "ChurnPlanted", "CustomerID"
# Settings small enough for a check.
PARAMS = {
    "logistic_regression": {"C": 1.0, "max_iter": 50},
    "svm": {"C": 1.0, "kernel": "linear", "max_iter": 20},
    "decision_tree": {"max_depth": 6},
    "random_forest": {"n_estimators": 10, "max_depth": 8},
    "xgboost": {"n_estimators": 5, "max_depth": 3},
    "adaboost": {"n_estimators": 5},
}


def model_input(spark, sf):
    """Numbers on one scale, without gaps."""
    scaled = [(F.log1p(F.coalesce(F.col(n).cast("double"), F.lit(0.0)))).alias(n) for n in COLUMNS]
    return stored(customer_profile(spark, sf).select(KEY, LABEL, *scaled), "model-input")


def parts(spark, sf):
    return split.stratified_split(model_input(spark, sf), LABEL, KEY)


def _single(name, model, params=None):
    @query(name)
    def run(spark, sf):
        train, test = parts(spark, sf)
        fitted = models.train(train, model, COLUMNS, LABEL, params or PARAMS[model])
        return _rounded(evaluate(models.scored(fitted, test, LABEL)))


_single("i1_logistic_regression", "logistic_regression")
_single("i2_svm_linear", "svm")
_single("i2_svm_rbf", "svm", {"C": 1.0, "kernel": "rbf", "gamma": "scale", "max_iter": 20})
_single("i3_decision_tree", "decision_tree")
_single("i4_random_forest", "random_forest")
_single("i5_boosted_trees", "xgboost")
_single("i6_adaboost", "adaboost")


@query("i7_rebalanced_model")
def i7(spark, sf):
    train, test = parts(spark, sf)
    fitted = models.train(train, "decision_tree", COLUMNS, LABEL, PARAMS["decision_tree"], sampler="smote", key=KEY)
    return _rounded(evaluate(models.scored(fitted, test, LABEL)))


def _scores(spark, scores):
    rows = [(", ".join(f"{k}={v}" for k, v in sorted(p.items())), float(s)) for p, s in scores]
    return _rounded(spark.createDataFrame(rows, "params string, score double"))


@query("i8_grid_search")
def i8(spark, sf):
    train, _ = parts(spark, sf)
    grid = {"max_depth": [2, 5], "min_samples_leaf": [1, 4]}
    return _scores(spark, tuning.optimise(train, "decision_tree", COLUMNS, LABEL, KEY, grid, method="grid", folds=3)[2])


@query("i9_random_search")
def i9(spark, sf):
    train, _ = parts(spark, sf)
    grid = {"max_depth": [2, 3, 4, 5, 6], "min_samples_leaf": [1, 2, 4, 8]}
    return _scores(spark, tuning.optimise(train, "decision_tree", COLUMNS, LABEL, KEY, grid, n_iter=3, folds=3)[2])


@query("i10_train_all")
def i10(spark, sf):
    train, test = parts(spark, sf)
    # a table without one of the models would look like the whole result
    _, metrics = models.train_all(train, test, COLUMNS, LABEL, params=PARAMS, strict=True)
    return _rounded(models.metrics_table(spark, metrics))


@query("i12_feature_importance")
def i12(spark, sf):
    train, _ = parts(spark, sf)
    fitted = models.train(train, "random_forest", COLUMNS, LABEL, PARAMS["random_forest"])
    return _rounded(models.feature_importance(spark, fitted, COLUMNS, 20))
