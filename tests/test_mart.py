"""Lockstep unnest, mart joins, and fact route == mart route."""

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.functions import lockstep_unnest
from shelfspark.operators import scores


def _zip_rows(spark, a, b, c):
    df = spark.createDataFrame([(1, a, b, c)], "id int, a array<string>, b array<string>, c array<string>")
    from pyspark.sql import functions as F
    return [tuple(r) for r in df.select(lockstep_unnest({"x": F.col("a"), "y": F.col("b"), "z": F.col("c")})).collect()]


arrays = st.one_of(st.none(), st.lists(st.sampled_from(["p", "q", "r"]), max_size=4))


@settings(max_examples=15, deadline=None)
@given(arrays, arrays, arrays)
def test_lockstep_pads_to_longest(spark, a, b, c):
    rows = _zip_rows(spark, a, b, c)
    la, lb, lc = (len(x or []) for x in (a, b, c))
    n = max(la, lb, lc)
    assert len(rows) == n
    for i, (x, y, z) in enumerate(rows):
        assert x == ((a or []) + [None] * n)[i]
        assert y == ((b or []) + [None] * n)[i]
        assert z == ((c or []) + [None] * n)[i]


def test_mart_shape(small_models):
    mart = small_models.mart
    assert mart.columns[:3] == ["user_id", "user_name", "media_id"]
    assert len(mart.columns) == 25
    assert mart.count() == 14583
    assert len(small_models.mart_wide.columns) == 27


def test_fact_route_equals_mart_route(small_models):
    m = small_models
    assert (scores.count_scores(m.mart).collect()
            == scores.count_scores_from_facts(m.fact, m.users, m.media).collect())
    for item, k in (("genre", 10), ("tag", 20)):
        a = scores.count_scores_by_top(m.mart, item, k).collect()
        b = scores.count_scores_by_top_from_facts(m.fact, m.users, m.media, item, k).collect()
        assert a == b and len(a) == 10 * k


def test_sql_text_equals_dataframe(spark, small_models):
    m = small_models
    assert scores.count_scores_sql(spark, m.mart).collect() == scores.count_scores(m.mart).collect()
    assert (scores.count_scores_by_top_sql(spark, m.mart, "genre", 10).collect()
            == scores.count_scores_by_top(m.mart, "genre", 10).collect())


def test_top_k_plan_has_group_limit(small_models):
    df = scores.count_scores_by_top(small_models.mart, "genre", 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan
