"""Property tests against brute force on small random inputs."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starmart.operators import assign_surrogate_keys, distinct_on

rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "a-1", "c"]), st.integers(0, 3), st.integers(-5, 5)),
    min_size=1,
    max_size=40,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_distinct_on_keeps_smallest_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k string, g int, v int")
    got = sorted(tuple(r) for r in distinct_on(df, ["k", "g"], ["v"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "g", "v"])
    want = sorted(tuple(x) for x in pdf.sort_values("v").groupby(["k", "g"], as_index=False).first().itertuples(index=False))
    assert got == [tuple(map(lambda x: x.item() if hasattr(x, "item") else x, t)) for t in want]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.text("abcxyz-", min_size=1, max_size=4), st.integers(0, 50)), min_size=1, max_size=60),
       st.integers(1, 1000))
def test_surrogate_keys_equal_sorted_position(spark, keys, start):
    data = sorted(keys)
    df = spark.createDataFrame(list(keys), "s string, n int")
    got = assign_surrogate_keys(df, ["s", "n"], "sk", start=start)
    assert {(r.s, r.n): r.sk for r in got.collect()} == {k: start + i for i, k in enumerate(data)}
