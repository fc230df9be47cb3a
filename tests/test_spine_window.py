import datetime as dt

from martspark.functions.calendar import month_to_date
from martspark.operators.spine import keyed, spine_full_join_literal

W = month_to_date(dt.date(1998, 2, 1))


def test_literal_spine_is_windowed_before_the_joins(spark, tmp_path):
    rows = [(dt.date(1998, 1, 1), 1, 5), (dt.date(1996, 1, 1), 1, 6), (None, 1, 7)]
    spark.createDataFrame(rows, "d date, i long, m_a long").write.parquet(str(tmp_path / "spine"))
    spine = keyed("a", spark.read.parquet(str(tmp_path / "spine")), "d", "i", resum=["m_a"])
    branch = keyed("b", spark.createDataFrame([(dt.date(1996, 1, 1), 1, 9), (dt.date(1998, 1, 1), 1, 8)], "d date, i long, m_b long"), "d", "i")
    dim = spark.createDataFrame([(1, "ENTERPRISE")], "restaurant_id long, classification_type_name string")
    out = spine_full_join_literal(spine, dim, [branch], W)
    assert "GreaterThanOrEqual(d,1998-01-01)" in out._jdf.queryExecution().executedPlan().toString()
    assert [(r._d, r.m_a, r.m_b) for r in out.collect()] == [(dt.date(1998, 1, 1), 5, 8)]
