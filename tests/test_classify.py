from pyspark.sql import functions as F

from martspark.functions import classify


def test_bands_half_open_and_null_as_zero(spark):
    rows = [(None,), (-5.0,), (24999.99,), (25000.0,), (49999.99,), (249999.99,), (250000.0,), (1e9,)]
    df = spark.createDataFrame(rows, "v double")
    got = [r[0] for r in df.select(classify.aov_band(F.col("v"))).collect()]
    assert got == ["a. 0-25k", "a. 0-25k", "a. 0-25k", "b. 25k-50k", "b. 25k-50k",
                   "g. 200k-250k", "h. >= 250k", "h. >= 250k"]


def test_flags_truth_table_and_negative_amounts(spark):
    rows = [(0, 0.0, 0.0), (1, 0.0, 0.0), (0, 1.0, 0.0), (0, 0.0, 1.0), (1, 1.0, 0.0),
            (0, 1.0, 1.0), (1, 0.0, 1.0), (1, 1.0, 1.0), (None, None, None), (1, -1.0, 0.0)]
    df = spark.createDataFrame(rows, "s long, c double, v double")
    got = [r[0] for r in df.select(classify.flags_to_class(F.col("s"), F.col("c"), F.col("v"))).collect()]
    assert got == ["1. organic", "3. sku", "2. cart", "4. voucher", "5. cart_sku", "6. cart_voucher",
                   "7. sku_voucher", "8. sku_cart_voucher", "1. organic", None]


def test_channel_class_null_goes_to_default(spark):
    df = spark.createDataFrame([("x recommended y",), ("cms",), ("wizard",), (None,), ("other",)], "c string")
    got = [r[0] for r in df.select(classify.channel_class(F.col("c"))).collect()]
    assert got == ["RP", "Sales", "Campaign_Wizard", "OC", "OC"]


def test_city_tiers_are_nested(spark):
    t = classify.CityTiers()
    assert set(t.top5) <= set(t.focus) <= set(t.tier3)
    assert len(t.tier3) == 47 and len(set(t.tier3)) == 47 and len(t.focus) == 22 and len(t.top5) == 5
    df = spark.createDataFrame([("GARUT",), ("AMBON",), ("JAKARTA",)], "a string")
    got = [tuple(r) for r in df.select(*t.columns(F.col("a"))).collect()]
    assert got == [("T3 Cities", "Focus 22 T3", "Top 5 T3 cities"),
                   ("T3 Cities", "Other Catgories", "Others"),
                   ("Other Cities", "Other Catgories", "Others")]


def test_bands_match_a_plain_python_rule(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from martspark.functions import constants as K

    def rule(v):
        v = 0 if v is None else v
        for edge, label in zip(K.AOV_EDGES, K.AOV_LONG_LABELS):
            if v < edge:
                return label
        return K.AOV_LONG_LABELS[-1]

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.integers(-10, 400000).map(lambda x: x / 1.0)), min_size=1, max_size=40))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        got = [r[0] for r in df.select(classify.aov_band(F.col("v"))).collect()]
        assert got == [rule(v) for v in values]

    check()
