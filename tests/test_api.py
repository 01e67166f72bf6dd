"""The sample_data facade across every sampler and error method (reference: sample_data protocol)."""

import pytest
from pyspark.sql import functions as F

from approxspark.api import describe, sample_data
from approxspark.operators import samplers


@pytest.mark.parametrize(
    "method,kwargs",
    [
        ("simple", {}),
        ("stratified", {"strata": "event_type"}),
        ("stratified", {"strata": "event_type", "allocation": "neyman"}),
        ("cluster", {"cluster": "user_id"}),
        ("systematic", {"order_by": "event_id"}),
        ("reservoir", {}),
        ("weighted", {"weight": "w"}),
    ],
)
def test_every_sampler_yields_valid_bounds(events, method, kwargs):
    df = events.withColumn("w", F.col("value") + 1)
    size = 20 if method == "cluster" else 400
    smp, b = sample_data(df, size, method, "value", "event_id", 0.95, "normal", seed=3, **kwargs)
    row = b.first()
    assert smp.count() > 0
    assert row["lower_bound"] <= row["estimate"] <= row["upper_bound"]
    assert 0 < row["confidence_level"] < 1


@pytest.mark.parametrize("error_method", ["student_t", "bootstrap", "non_parametric"])
def test_error_methods(events, error_method):
    _smp, b = sample_data(events, 300, "simple", "value", "event_id", 0.9, error_method, seed=2, n_bootstrap=50)
    row = describe(b).first()
    assert row["method"] == error_method and "+-" in row["summary"]


@pytest.mark.parametrize("method,kwargs", [("stratified", {"strata": "event_type"}), ("cluster", {"cluster": "user_id"}), ("systematic", {"order_by": "event_id"}), ("reservoir", {})])
@pytest.mark.parametrize("error_method", ["student_t", "bootstrap", "non_parametric"])
def test_every_sampler_honours_the_error_method(events, method, kwargs, error_method):
    _smp, b = sample_data(events, 15 if method == "cluster" else 200, method, "value", "event_id", 0.95, error_method, seed=3, n_bootstrap=40, **kwargs)
    row = b.first()
    assert error_method in row["method"] and row["lower_bound"] <= row["estimate"] <= row["upper_bound"]


def test_weighted_sample_refuses_other_error_methods(events):
    with pytest.raises(ValueError):
        sample_data(events, 50, "weighted", "value", "event_id", error_method="bootstrap", weight="value")


def test_bad_arguments(events):
    with pytest.raises(ValueError):
        sample_data(events, 10, "nonsense", "value", "event_id")
    with pytest.raises(ValueError):
        sample_data(events, 10, "simple", "value", "event_id", confidence=1.0)
    with pytest.raises(ValueError):
        samplers.stratified(events, 10, "event_type", "event_id", rule="neyman")
