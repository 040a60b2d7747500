"""Property tests (Hypothesis) for the custom distributed algorithms, plus
idempotence of dedupe and labelling. Examples are few: each runs Spark jobs."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskframe.operators import clean, features, quantiles
from riskframe.operators.cumulative import running_totals

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

values = st.lists(st.one_of(st.integers(-5, 5).map(float),
                            st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                  min_size=1, max_size=400)


@SETTINGS
@given(xs=values, probs=st.lists(st.floats(0, 1), min_size=1, max_size=4, unique=True),
       final_rows=st.sampled_from([1, 3, 50, 4096]), bins=st.sampled_from([16, 64]))
def test_exact_quantiles_equal_numpy(spark, xs, probs, final_rows, bins):
    df = spark.createDataFrame([(x,) for x in xs], "v double").repartition(3)
    got = quantiles.exact_quantile_values(df, ["v"], probs, final_rows=final_rows, bins=bins)
    for p in probs:
        assert got[((), "v", p)] == pytest.approx(np.percentile(xs, p * 100), rel=1e-9, abs=1e-9)


@SETTINGS
@given(keys=st.lists(st.integers(-1000, 1000), min_size=1, max_size=300, unique=True),
       buckets=st.integers(1, 9))
def test_running_totals_equal_cumsum(spark, keys, buckets):
    rows = [(float(k), float(abs(k) % 7)) for k in keys]
    out = running_totals(spark.createDataFrame(rows, "s double, c double"), "s", ["c"], buckets=buckets)
    got = out.orderBy("s").toPandas()
    ref = pd.DataFrame(rows, columns=["s", "c"]).sort_values("s")
    assert np.allclose(got["cum_c"].values, ref["c"].cumsum().values)
    assert np.allclose(got["total_c"].values, ref["c"].sum())


def test_dedupe_and_label_idempotent(spark):
    df = spark.createDataFrame([(1, "3"), (1, "3"), (2, "1"), (None, "4")], "k int, Severity string")
    once = clean.dedupe_rows(df)
    assert sorted(once.collect(), key=repr) == sorted(clean.dedupe_rows(once).collect(), key=repr)
    l1 = features.binary_label(df)
    l2 = features.binary_label(l1)
    assert sorted(map(tuple, l1.collect()), key=repr) == sorted(map(tuple, l2.collect()), key=repr)
