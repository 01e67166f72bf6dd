"""Sample-size policies (pure arithmetic on counts; evaluated once per query on the driver)."""

from __future__ import annotations

import math

from ..functions.stats import z_value

# Fixed values that must equal the reference's behaviour:
# accuracy policy: z 1.96, p(1-p) 0.25; its sample is clamped to [1000, 100000] (passed by callers who want that)
ACCURACY_Z = 1.96
ACCURACY_MIN_SAMPLE = 1000
ACCURACY_MAX_SAMPLE = 100000
# shape policy: base 10000, x2 when grouped, x1.5 with more than two aggregates,
# x(1 + (target - 0.95) * 4)
SHAPE_BASE = 10000
# confidence -> z table used for the reported relative half-width "ci"
CI_Z = {90: 1.645, 95: 1.96, 99: 2.576}
CI_Z_DEFAULT = 1.96


def size_for_accuracy(accuracy: float, population: int, minimum: int | None = None, maximum: int | None = None) -> int:
    """e = (100 - accuracy) / 100; int(1.96^2 * 0.25 / e^2), at most N.

    ``minimum`` and ``maximum`` are the caller's limits, without any by default: a maximum below the
    size delivers less than the accuracy asked for (see :func:`delivered_accuracy`).
    """
    if not 0 < accuracy < 100:
        raise ValueError("accuracy must be in (0, 100)")
    e = (100 - accuracy) / 100.0
    n = int(ACCURACY_Z**2 * 0.25 / e**2)
    if maximum is not None:
        n = min(n, maximum)
    if minimum is not None:
        n = max(n, minimum)
    return min(n, population)


def delivered_accuracy(sample: int, population: int) -> float:
    """The accuracy that a sample of this size delivers by the same formula; 100 if it holds every row."""
    return 100.0 if sample >= population else 100.0 * (1 - ACCURACY_Z * 0.5 / math.sqrt(max(1, sample)))


def size_for_shape(grouped: bool, n_aggregates: int, accuracy_target: float = 0.95) -> int:
    """10000, x2 if grouped, x1.5 with more than two aggregates, x(1 + (target - 0.95) * 4)."""
    base = float(SHAPE_BASE)
    if grouped:
        base *= 2
    if n_aggregates > 2:
        base *= 1.5
    return int(base * (1 + (accuracy_target - 0.95) * 4))


def required_sample_size(margin: float, population: int | None = None, confidence: float = 0.95) -> int:
    """n0 = z^2 * 0.25 / m^2; with N: ceil(n0 N / (n0 + N - 1)); without: ceil(n0)."""
    if not 0 < margin < 1:
        raise ValueError("error margin must be in (0, 1)")
    z = z_value(confidence)
    n0 = z * z * 0.25 / (margin * margin)
    if population is None:
        return int(math.ceil(n0))
    return int(math.ceil(n0 * population / (n0 + population - 1)))


def ci_z(confidence: int) -> float:
    return CI_Z.get(confidence, CI_Z_DEFAULT)
