"""Same output for any partitioning and arrival order (survey §5.2 item 4)."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars, profile, reshape
from tidemark.sources import fixtures

from sf_tables import SF01

PARAMS = ("click", "error", "purchase", "signup", "view")


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_profile_and_pivot_ignore_partitioning(spark, parts):
    r = fixtures.readings(spark, SF01)
    shuffled = r.repartition(parts, F.rand(seed=parts))
    assert same(profile.group_profile(r), profile.group_profile(shuffled))
    assert same(reshape.pivot_mean(r, values=PARAMS), reshape.pivot_mean(shuffled, values=PARAMS))


@pytest.mark.parametrize("parts", [1, 16])
def test_repair_and_metrics_ignore_partitioning(spark, parts):
    raw = fixtures.raw_bars(spark, SF01)
    shuffled = raw.repartition(parts, F.rand(seed=parts))
    assert same(bars.clean_bars(raw), bars.clean_bars(shuffled))
    assert same(bars.bar_metrics(bars.clean_bars(raw)), bars.bar_metrics(bars.clean_bars(shuffled)))
