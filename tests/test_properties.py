"""Property checks (random inputs): row ids, lag, masking, keys."""

from hypothesis import given, settings
from hypothesis import strategies as st

from reelhouse.operators.windows import dense_row_id, lag_delta

ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot"])),
              st.one_of(st.none(), st.integers(-3, 3)),
              st.integers(-1000, 1000)),
    min_size=0, max_size=60,
)


def _key(v):  # ascending, NULLs last
    return (v is None, v if v is not None else 0)


@settings(max_examples=8, deadline=None)
@given(ROWS)
def test_dense_row_id_is_the_sorted_position(spark, rows):
    data = [(i, k, t, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, k string, t int, v int")
    got = {r.id: r.rid for r in dense_row_id(df, ["k", "t", "id"], "rid", partitions=3).collect()}
    want = sorted(data, key=lambda r: (_key(r[1]), _key(r[2]), r[0]))
    assert got == {r[0]: pos + 1 for pos, r in enumerate(want)}


@settings(max_examples=6, deadline=None)
@given(ROWS)
def test_lag_delta_matches_python(spark, rows):
    data = [(i, k, t, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, k string, t int, v int")
    hot = spark.createDataFrame([("hot",)], "k string")
    for hk in (None, hot):
        got = {r.id: r.dv for r in lag_delta(df, ["k"], ["t", "id"], {"v": "dv"}, hot_keys=hk).collect()}
        want = {}
        for key in {r[1] for r in data}:
            grp = sorted([r for r in data if r[1] == key], key=lambda r: (_key(r[2]), r[0]))
            for prev, cur in zip([None] + grp[:-1], grp):
                want[cur[0]] = None if prev is None else cur[3] - prev[3]
        assert got == want
