import numpy as np
import pytest
from pyspark.sql import functions as F

from mobspark.functions import exprs, naming
from mobspark.functions.stats import pooled_t, t_p_value, two_sided_p


def values(df):
    return [tuple(r) for r in df.collect()]


def test_age_classes_differ_at_18_and_unknown(frame):
    ages = frame("age bigint", (None,), (17,), (18,), (60,), (61,))
    got = values(ages.select("age", exprs.age_class("age"), exprs.age_class_activity("age")))
    assert got == [(None, 1, 0), (17, 0, 0), (18, 1, 0), (60, 1, 1), (61, 2, 2)]


def test_bands_are_half_open(frame):
    incomes = frame("v double", (-1.0,), (0.0,), (9999.0,), (10000.0,), (149999.0,), (150000.0,), (175000.0,), (450000.0,), (None,))
    assert [r[0] for r in incomes.select(exprs.income_level("v")).collect()] == [999, 0, 0, 1, 14, 15, 16, 23, 999]
    ages = frame("v bigint", (0,), (11,), (12,), (69,), (70,), (-1,), (None,))
    assert [r[0] for r in ages.select(exprs.age_level("v")).collect()] == [0, 0, 1, 11, 12, 999, 999]


def test_zero_division_is_null(frame):
    assert values(frame("a double, b double", (1.0, 0.0), (0.0, 0.0), (1.0, 2.0)).select(exprs.ratio("a", "b"))) == [(None,), (None,), (0.5,)]


def test_distance_bin_truncates(frame):
    d = frame("d double", (0.4,), (0.5,), (1.49,), (1.5,), (2.0,))
    assert [r[0] for r in d.select(exprs.distance_bin("d")).collect()] == [0, 0, 1, 1, 2]
    assert [r[0] for r in d.select(exprs.distance_bin("d", half_units=True)).collect()] == [0.0, 0.5, 1.0, 1.5, 2.0]


def test_number_formats(frame):
    v = frame("v double", (12.0,), (12.3,), (12.345,), (0.125,), (12345678.9,), (-0.004,))
    assert [r[0] for r in v.select(exprs.short_number("v", 2)).collect()] == ["12.0", "12.3", "12.34", "0.12", "12345678.9", "0.0"]
    assert [r[0] for r in v.limit(2).select(exprs.starred_percent("v", F.lit("*"))).collect()] == ["1200.0% *", "1230.0% *"]


def test_levels_stars_and_quartiles(frame):
    v = frame("v double", (None,), (0.9,), (0.8,), (0.5,), (0.1,))
    assert [r[0] for r in v.select(exprs.level("v", [0.8, 0.6, 0.4], "No Data")).collect()] == ["No Data", "1", "2", "3", "4"]
    p = frame("p double", (None,), (0.004,), (0.005,), (0.01,), (0.05,))
    assert [r[0] for r in p.select(exprs.stars("p")).collect()] == ["", "***", "**", "*", ""]
    q = frame("q double", (None,), (26339.0,), (26340.0,), (60000.0,), (95341.0,))
    assert [r[0][0] for r in q.select(exprs.income_quartile("q")).collect()] == ["1", "1", "2", "3", "4"]


def test_mode_names_and_relabel(frame):
    m = frame("m bigint", (0,), (34,), (1015,), (16,), (None,))
    assert [r[0] for r in m.select(exprs.mode_name("m")).collect()] == ["SOV", "DUMMY REPOSITIONING", "NO_MOVE", None, None]
    assert len(exprs.MODE_NAMES) == 52
    t = frame("s string", ("a",), ("b",), (None,))
    assert [r[0] for r in t.select(exprs.relabel("s", {"a": "x"})).collect()] == ["x", "b", None]


def test_row_total_skips_null(frame):
    assert values(frame("a double, b double", (1.0, None), (None, None)).select(exprs.row_total("a", "b"))) == [(1.0,), (0.0,)]


def test_case_names(frame):
    names = frame("folder string", ("gvl_du_7",), ("gsc_300_nr_7",), ("atx_500_0.2_3",), ("gsc_300_heur",), ("x",))
    a = naming.add_city_case_iteration(names).select("City", "Strategy", "WTP_Type", "Iteration")
    assert values(a)[0] == ("gvl", "Proactive", "du", "7")
    assert values(a)[4] == ("x", "Proactive", None, None)
    b = naming.add_city_fleet_weight(names).select("City", "Fleet Size", "Strategy", "Repo_Weight", "Iteration")
    assert values(b)[1:3] == [("gsc", "300", "nr_0", "0", "7"), ("atx", "500", "jar_0.2", "0.2", "3")]
    assert values(b)[4] == ("x", None, "jar_0", "0", None)
    c = naming.add_city_fleet_strategy(names).select("City", "Fleet Size", "Strategy", "Iteration")
    assert values(c)[1] == ("gsc", "300", "Proactive", "7")
    assert values(c)[3] == ("gsc", "300", "Heuristic", "heur")
    assert values(names.select(naming.strip_last_part("folder"))) == [("gvl_du",), ("gsc_300_nr",), ("atx_500_0.2",), ("gsc_300",), ("x",)]


@pytest.mark.parametrize("t, df, p", [(2.228139, 10, 0.05), (12.7062, 1, 0.05), (1.959966, 1e7, 0.05), (2.575829, 1e9, 0.01), (3.169273, 10, 0.01)])
def test_tabulated_quantiles(t, df, p):
    assert two_sided_p(np.array([t, -t]), np.array([df, df])) == pytest.approx([p, p], rel=1e-4)


def test_p_value_edges():
    got = two_sided_p(np.array([0.0, np.nan, 1.0, 80.0]), np.array([5.0, 5.0, 0.0, 1000.0]))
    assert got[0] == 1.0 and np.isnan(got[1]) and np.isnan(got[2]) and got[3] < 1e-100


def test_t_from_summary_statistics(frame):
    s = frame("m1 double, s1 double, n1 bigint, m2 double, s2 double, n2 bigint", (10.0, 2.0, 6, 8.0, 2.0, 6), (1.0, 0.0, 3, 1.0, 0.0, 3), (1.0, None, 1, 2.0, 1.0, 4))
    t, df = pooled_t(*[F.col(c) for c in s.columns])
    rows = s.select(t.alias("t"), df.alias("df")).withColumn("p", t_p_value("t", "df")).collect()
    # finite series for 10 degrees of freedom at t = sqrt(3)
    c2, sine = 10 / 13, (3 / 13) ** 0.5
    closed = 1 - sine * (1 + c2 / 2 + 3 * c2**2 / 8 + 5 * c2**3 / 16 + 35 * c2**4 / 128)
    assert rows[0].t == pytest.approx(3**0.5) and rows[0].df == 10 and rows[0].p == pytest.approx(closed, abs=1e-9)
    assert rows[1].t is None and rows[1].p is None and rows[2].t is None


def test_p_values_with_very_many_degrees_of_freedom():
    import numpy as np

    from mobspark.functions.stats import two_sided_p

    got = two_sided_p(np.array([1.96, 1.96, 1.96]), np.array([9.9e5, 1e10, 1e12]))
    assert abs(got[2] - 0.04999579029644) < 1e-12 and abs(got[1] - got[2]) < 1e-9 and abs(got[0] - got[1]) < 1e-6
