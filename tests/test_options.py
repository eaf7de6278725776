import pytest

from skein.operators import options as O

EST = "struct<low:double,expected:double,high:double,confidence:double>"


def question(spark):
    options = spark.createDataFrame(
        [("a", "A", 0, [], [(0.8, (0.4, 0.6, 0.8, 0.5), "future")]), ("b", "B", 1, [(False, False, 0.1)], []), ("c", "C", 2, [(True, False, 0.0)], [])],
        f"option_id string, option_name string, ord int, constraints array<struct<hard:boolean,satisfied:boolean,penalty:double>>, outcomes array<struct<p:double,value:{EST},scope:string>>",
    )
    criteria = spark.createDataFrame([("k", "Gain", 0, 1.0, {"self": 2.0}, False), ("l", "Cost", 1, 1.0, {}, True)], "criterion_id string, criterion_name string, cord int, weight double, scope_weights map<string,double>, cost boolean")
    estimates = spark.createDataFrame([("a", "k", (0.5, 0.9, 1.0, 0.8)), ("a", "l", (0.1, 0.2, 0.4, 0.8)), ("b", "k", (0.3, 0.4, 0.5, 0.6))], f"option_id string, criterion_id string, est {EST}")
    scopes = spark.createDataFrame([("self", {"future": 0.25}), ("future", {})], "scope string, beneficiaries map<string,double>")
    return options, criteria, estimates, scopes


def test_scopes_outcomes_and_missing(spark):
    judged, ranks = O.evaluated(*question(spark))
    got = {(r.scope, r.option_id): r for r in ranks.collect()}
    a, b, c = (got["self", k] for k in "abc")
    assert a.criteria_score == pytest.approx((2 * 0.9 + 0.8) / 3) and a.outcome_value == pytest.approx(0.8 * 0.25 * 0.6)
    assert got["future", "a"].outcome_value == pytest.approx(0.8 * 0.6)
    assert a.total_score == pytest.approx(0.5 * (2 * 0.9 + 0.8) / 3 + 0.5 * 0.12) and a.missing_names in (None, "")
    assert b.total_score == pytest.approx((2 * 0.4 + 0.5) / 3 - 0.1) and b.missing_names == "Cost" and b.outcome_value is None
    assert (c.status, c.total_score, c.rank) == ("impermissible", 0.0, 3) and c.missing_names == "Gain, Cost"
    assert (a.rank, a.status) == (1, "recommended")


def test_cruxes(spark):
    judged, ranks = O.evaluated(*question(spark))
    rows = [r for r in O.cruxes(judged, ranks).collect() if r.scope == "self"]
    gain = next(r for r in rows if r.criterion_id == "k")
    assert gain.delta == pytest.approx(2 * (0.9 - 0.4) / 3) and gain.voi == pytest.approx(2 / 3 * 0.5 * (1.5 - 0.6))
    assert [r.place for r in sorted(rows, key=lambda r: r.place)] == list(range(1, len(rows) + 1))


def test_no_options(spark):
    options, criteria, estimates, scopes = question(spark)
    judged, ranks = O.evaluated(options.limit(0), criteria, estimates, scopes)
    assert ranks.count() == 0 and O.cruxes(judged, ranks).count() == 0
