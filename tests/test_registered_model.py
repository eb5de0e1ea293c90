"""The registered model queries train with the operator's own configuration."""

from __future__ import annotations

from holdfast.operators.model import TrainingConfig
from proof import modelling
from proof.base import Tables
from tests.conftest import SMALL


def test_registered_model_has_the_whole_configuration(spark):
    tables = Tables(spark, SMALL)
    fitted = modelling._trained(tables)
    trees = fitted.stages[-1]
    config = TrainingConfig()
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize()) == (config.iterations, config.depth, config.learning_rate)
    assert modelling._trained(Tables(spark, SMALL)) is fitted
