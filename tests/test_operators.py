"""Property tests of the reusable operators against pandas brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.operators.spine import missing_days, zero_filled_daily

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_daily = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.dates(dt.date(2024, 2, 25), dt.date(2024, 3, 5)),
                                st.integers(0, 100)), min_size=1, max_size=25)


@SETTINGS
@given(rows_daily)
def test_zero_filled_daily(spark, rows):
    df = spark.createDataFrame(rows, "k string, d date, v bigint")
    got = {(r.k, r.d): r.total for r in zero_filled_daily(df, "d", "v", ["k"], out="total").collect()}
    want = {}
    for k in {r[0] for r in rows}:
        ds = [r[1] for r in rows if r[0] == k]
        day = min(ds)
        while day <= max(ds):
            want[(k, day)] = sum(r[2] for r in rows if r[0] == k and r[1] == day)
            day += dt.timedelta(days=1)
    assert got == want
    gaps = {(r.k, r.d) for r in missing_days(df, "d", ["k"]).collect()}
    assert gaps == {key for key in want if not any(r[0] == key[0] and r[1] == key[1] for r in rows)}
