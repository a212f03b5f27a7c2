"""Statistics of histograms far larger than any test table."""

import math

import pytest

from upcharts.functions.histogram import histogram_median, histogram_summary


@pytest.mark.parametrize("values", [[-(10**9), 0, 10**9], [10**9 - 1, 10**9], [7]])
def test_summary_survives_size(spark, values):
    freq = 50_000_000_000
    hist = spark.createDataFrame([("k", v, freq) for v in values], "k string, value long, freq long")
    (got,) = histogram_summary(hist, ["k"]).collect()
    n, mean = freq * len(values), sum(values) / len(values)
    spread = sum((v - mean) ** 2 for v in values) * freq
    assert got["n"] == n and got["mean"] == pytest.approx(mean)
    assert got["se"] == pytest.approx(math.sqrt(spread / (n - 1) / n))
    assert got["mean_without_top"] == pytest.approx((sum(values) * freq - max(values)) / (n - 1))
    (median,) = histogram_median(hist, ["k"]).collect()
    low, high = sorted(values)[(len(values) - 1) // 2], sorted(values)[len(values) // 2]
    assert median["median"] == (low + high) / 2
