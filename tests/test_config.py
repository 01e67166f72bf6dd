"""Parameter validation (reference: tests/test_config.py, tests/test_validation.py)."""

import pytest

from approxspark.functions.stats import t_value, z_value
from approxspark.operators import bounds
from approxspark.plans.allocation import allocate
from approxspark.plans.sizing import required_sample_size, size_for_accuracy, size_for_shape


@pytest.mark.parametrize("conf", [0, 1, -0.5, 1.5])
def test_confidence_must_be_open_unit_interval(conf):
    with pytest.raises(ValueError):
        bounds.validate_config(conf)


def test_unknown_method_and_bootstrap_count():
    with pytest.raises(ValueError):
        bounds.validate_config(0.95, "magic")
    with pytest.raises(ValueError):
        bounds.validate_config(0.95, "bootstrap", 0)


def test_z_and_t_values():
    assert abs(z_value(0.95) - 1.9599639845400536) < 1e-12
    assert abs(t_value(0.95, 29) - 2.0452296421) < 1e-8
    assert abs(t_value(0.95, 999) - 1.9623414611) < 1e-8
    assert t_value(0.95, 5) > z_value(0.95)


def test_required_sample_size():
    assert required_sample_size(0.05) == 385
    assert required_sample_size(0.05, 15000) == 375
    with pytest.raises(ValueError):
        required_sample_size(0)


def test_accuracy_and_shape_sizes():
    assert size_for_accuracy(95, 15000) == 384
    assert size_for_accuracy(95, 15000, minimum=1000, maximum=100000) == 1000
    assert size_for_accuracy(99, 15000) == 9603
    assert size_for_accuracy(95, 500, minimum=1000) == 500  # capped at N
    with pytest.raises(ValueError):
        size_for_accuracy(100, 10)
    assert size_for_shape(False, 1) == 10000
    assert size_for_shape(True, 3) == 30000


def test_unknown_allocation(spark):
    sizes = spark.createDataFrame([("a", 10)], "h string, pop_n long")
    with pytest.raises(ValueError):
        allocate(sizes, 5, "h", "nonsense")
