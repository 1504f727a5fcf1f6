from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.operators.runs import number_stretches, scan


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), st.one_of(st.none(), st.integers(0, 40)), st.sampled_from([None, "a", "b"]), st.integers(0, 2)), min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1])), st.integers(1, 9))
def test_runs_beside_a_walk(spark, rows, pages):
    df = spark.createDataFrame([(d, p, 0, v, n) for d, p, v, n in rows], "doc_id int, page int, order_id int, v string, n int")
    done = scan(df, carries={"c": F.col("v")}, sums={"s": F.col("n")}, pages=pages)
    got = {(r.doc_id, r.page): (r.c, r.s, r.k) for r in number_stretches(done, "v", "k", pages=pages).collect()}
    want, state = {}, {}
    for d, p, v, n in sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        c, s, k, last = state.get(d, (None, 0, -1, object()))
        state[d] = (v if v is not None else c, s + n, k + (v != last), v)
        want[d, p] = state[d][:3]
    assert got == want


def test_events_stand_before_their_place(spark):
    df = spark.createDataFrame([(1, p, 0) for p in (None, 0, 1, 5, 9)], "doc_id int, page int, order_id int")
    events = spark.createDataFrame([(1, 1, 0, "a"), (1, 7, 0, "b"), (1, 9, 0, "c"), (2, 1, 0, "no rows")], "doc_id int, page int, order_id int, v string")
    for pages in (1, 3, 100):
        got = scan(df, carries={"v": F.lit(None).cast("string")}, sums={"n": F.lit(1)}, events=events, pages=pages).collect()
        assert {r.page: (r.v, r.n) for r in got} == {None: (None, 1), 0: (None, 2), 1: ("a", 3), 5: ("a", 4), 9: ("c", 5)}


def test_one_exchange_moves_the_rows(spark):
    df = spark.range(9).selectExpr("1 as doc_id", "int(id) as page", "0 as order_id", "repeat('x', 9) as text", "id % 3 as v")
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert plan(scan(df, sums={"s": F.col("v")})).count("Exchange") <= 4 and "Join" not in plan(scan(df, sums={"s": F.col("v")}))
    assert "Join" not in plan(number_stretches(df, "v", "k"))
