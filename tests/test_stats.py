from tabml.operators import stats as st


def test_constant_column_corr_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "x double, y double")
    m = {(r.col_a, r.col_b): r.corr for r in st.corr_matrix(df, ["x", "y"]).collect()}
    assert m[("x", "y")] is None and m[("x", "x")] is None
    assert abs(m[("y", "y")] - 1.0) < 1e-12


def test_corr_matrix_symmetric(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.5), (2.0, 1.0, 0.1), (3.0, 7.0, 0.3), (4.0, 3.0, 0.9)],
                               "a double, b double, c double")
    m = {(r.col_a, r.col_b): r.corr for r in st.corr_matrix(df).collect()}
    assert len(m) == 9
    for (a, b), v in m.items():
        assert abs(v - m[(b, a)]) < 1e-12


def test_corr_uses_rows_where_both_are_present(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (100.0, None)], "a double, b double")
    m = {(r.col_a, r.col_b): r.corr for r in st.corr_matrix(df).collect()}
    assert abs(m["a", "b"] - 1.0) < 1e-12
    wide = df.select("a", "b", *[(df.a * i).alias(f"c{i}") for i in range(43)])
    w = {(r.col_a, r.col_b): r.corr for r in st.corr_matrix(wide).filter("col_a = 'a' AND col_b = 'b'").collect()}
    assert abs(w["a", "b"] - 1.0) < 1e-12


def test_summarize_and_pivot(spark):
    df = spark.createDataFrame([("u1", "a", 1.0), ("u1", "b", 2.0), ("u2", "a", 3.0),
                                ("u2", "a", 4.0)], "u string, k string, v double")
    s = {r.column: r for r in st.summarize(df, ["v"]).collect()}
    assert s["v"]["count"] == 4 and s["v"]["mean"] == 2.5 and s["v"]["max"] == 4.0
    p = {r.u: r for r in st.pivot_sum(df, "u", "k", "v").collect()}
    assert p["u1"]["a"] == 1.0 and p["u2"]["a"] == 7.0 and p["u2"]["b"] is None


def test_pivot_keeps_the_null_column(spark):
    df = spark.createDataFrame([("u", "a", 1.0), ("u", None, 2.0)], "u string, k string, v double")
    r = st.pivot_sum(df, "u", "k", "v").first()
    assert r["a"] == 1.0 and r["null"] == 2.0


def test_small_keeps_every_row(spark):
    from tabml.operators.models import small
    assert small(spark.range(20_000)).count() == 20_000
