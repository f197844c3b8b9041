"""flowverdict: network-flow threat scoring as Spark DataFrame plans."""

from flowverdict.operators.forest import ForestModel, score_forest, train_forest
from flowverdict.operators.fusion import FusionSettings
from flowverdict.operators.rules import evaluate_rules
from flowverdict.plans.pipeline import TrainingRun, score_flows, train_model
from flowverdict.sources.catalog import default_catalog, load_catalog
from flowverdict.session import tune_session
from flowverdict.sources.flow_csv import read_flow_csv

__all__ = [
    "ForestModel",
    "FusionSettings",
    "TrainingRun",
    "default_catalog",
    "evaluate_rules",
    "load_catalog",
    "read_flow_csv",
    "score_flows",
    "score_forest",
    "train_forest",
    "train_model",
    "tune_session",
]
