"""Property test: the prefix scan equals the sequential row loop for any
chunk size, including chunks whose sensors or labels are all null."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from firesight.operators.enrich import ENRICH_COLUMNS, enrich
from tests.helpers import frame, loop_enrich, reading

value = st.one_of(st.none(), st.floats(min_value=-50, max_value=200, allow_nan=False).map(lambda x: round(x, 2)))
row = st.tuples(value, value, st.one_of(st.none(), st.integers(min_value=-1, max_value=2)))
node_rows = st.lists(row, min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.dictionaries(st.sampled_from(["a", "b"]), node_rows, min_size=1, max_size=2),
       chunk=st.integers(min_value=1, max_value=6), gap=st.integers(min_value=1, max_value=3))
def test_prefix_scan_matches_loop(spark, data, chunk, gap):
    rows = []
    for node, vals in data.items():
        for i, (temp, co, fire) in enumerate(vals):
            rows.append(reading(node, i * gap, temp=temp, co=co if co is None else abs(co), fire=fire))
    df = frame(spark, rows)
    expected = loop_enrich([r.asDict() for r in df.collect()])
    got = {(r["node_id"], r["reading_index"]): r.asDict() for r in enrich(df, chunk_rows=chunk).collect()}
    assert set(got) == set(expected)
    for k, exp in expected.items():
        for c in ENRICH_COLUMNS:
            assert got[k][c] == exp[c], (k, c, got[k][c], exp[c])
