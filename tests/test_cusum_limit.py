"""Sums of just the limit."""

from fractions import Fraction

import pytest

from sensorloom.operators.detect.cumulative import cusum


@pytest.mark.parametrize("chunk_rows", [None, 700])
def test_a_sum_of_just_the_limit_is_no_alarm(spark, chunk_rows):
    """Readings of two decimals; after a long decline each excursion ends on a sum of 5, one in three goes a step above."""
    readings, want, total = [], [], Fraction(0)
    for k in range(300):
        a, b = k * 37 % 997 + 1, k * 91 % 997 + 1
        steps = [a, b, 24_500 - a - b] + ([1] if k % 3 == 0 else [])
        for s in steps + [-30_000]:  # a step of 1 is 1/4900 of the sum
            readings.append((len(readings), "a", round((7450 + s) / 100, 2)))
    for _, _, x in readings:
        total = max(Fraction(0), total + (Fraction(str(x)) - 50) / 49 - Fraction(1, 2))
        want.append(total)
    ties = sum(t == 5 for t in want)
    df = spark.createDataFrame(readings, "id long, series string, x double")
    got = {r.id: r for r in cusum(df, ["series"], ["id"], "x", 50, 49, chunk_rows=chunk_rows).collect()}
    assert ties > 20 and sum(t > 5 for t in want) > 20
    assert all(got[i].cusum_pos == pytest.approx(float(t), abs=1e-8) for i, t in enumerate(want))
    down = {i: got[i].cusum_neg > 5 for i in got}
    assert [got[i].alarm for i in range(len(want)) if not down[i]] == [int(t > 5) for i, t in enumerate(want) if not down[i]]
