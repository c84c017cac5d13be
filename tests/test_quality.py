import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratum.operators import quality
from stratum.operators.columns import RunInfo
from stratum.operators.quality import Rule, parse_rules


def entry(expression, criticality=None, inside=False, **arguments):
    check = {"function": "sql_expression", "arguments": {"expression": expression, **arguments}}
    result = {"check": check}
    if criticality:
        (check if inside else result)["criticality"] = criticality
    return result


def test_criticality_positions_and_default():
    rules = parse_rules([entry("a", "warn"), entry("b", "warn", inside=True), entry("c")])
    assert [r.criticality for r in rules] == ["warn", "warn", "error"]
    assert parse_rules(None) == []


@pytest.mark.parametrize("bad", [
    {}, {"check": "x"}, {"check": {"function": "is_unique", "arguments": {"expression": "a"}}},
    {"check": {"function": "sql_expression"}}, entry("", "warn"), entry("a", "fatal"), "text",
])
def test_malformed_rules(bad):
    with pytest.raises(ValueError):
        parse_rules([bad])


def test_expressions_are_checked_before_any_job(spark):
    with pytest.raises(ValueError):
        quality.annotated(spark.range(1), [Rule("r", "nope > 1", "m")])
    with pytest.raises(ValueError):
        quality.annotated(spark.range(1), [Rule("r", "id + 1", "m")])


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(
        [(1, 5, "ok"), (2, -1, "ok"), (3, 5, "odd"), (4, -1, "odd"), (5, None, "ok")], "id int, v int, s string")


RULES = [Rule("positive", "v > 0", "not positive"), Rule("small", "v >= 0", "negative"),
         Rule("known", "s = 'ok'", "unknown", "warn")]


def test_annotate(frame):
    rows = {r.id: r for r in quality.annotated(frame, RULES).collect()}
    assert rows[1].dq_errors is None and rows[1].dq_warnings is None
    assert [e.name for e in rows[2].dq_errors] == ["positive", "small"]
    assert rows[3].dq_errors is None and rows[3].dq_warnings[0].message == "unknown"
    assert rows[5].dq_errors is None


def test_warn_only_rows_are_on_both_sides(frame):
    checked = quality.annotated(frame, RULES)
    assert sorted(r.id for r in quality.passed(checked).collect()) == [1, 3, 5]
    assert sorted(r.id for r in quality.quarantined(checked).collect()) == [2, 3, 4]
    assert quality.passed(checked).columns == frame.columns


def test_only_warnings(frame):
    checked = quality.annotated(frame, RULES[2:])
    assert quality.passed(checked).count() == 5
    assert quality.failure_counts(quality.quarantined(checked)).collect()[0]["count"] == 2


def test_summary(frame):
    failing = quality.quarantined(quality.annotated(frame, RULES))
    rows = quality.failure_summary(failing, "t", RunInfo("c", "j", "r"), RULES).collect()
    assert sorted((r.quality_check_type, r.name, r["count"]) for r in rows) == [
        ("error", "positive", 2), ("error", "small", 2), ("warn", "known", 2)]
    assert rows[0].correlation_id == "c"


def test_summary_uses_the_rows_own_correlation_ids(spark):
    df = spark.createDataFrame([("x", -1), ("x", -2), ("y", -1)], "correlation_id string, v int")
    failing = quality.quarantined(quality.annotated(df, RULES[:1]))
    rows = quality.failure_summary(failing, "t", RunInfo("run"), RULES[:1]).collect()
    assert sorted((r.correlation_id, r["count"]) for r in rows) == [("x", 2), ("y", 1)]


def test_exception_record_holds_the_row(frame):
    rows = quality.exception_rows(quality.quarantined(quality.annotated(frame, RULES)), "t", RunInfo("c"))
    got = rows.selectExpr("variant_get(exception_record, '$.id', 'int') id",
                          "variant_get(exception_record, '$.dq_errors[1].name', 'string') second").collect()
    assert sorted((r.id, str(r.second)) for r in got) == [(2, "small"), (3, "None"), (4, "small")]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=12))
def test_passed_and_error_rows_make_up_the_input(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    checked = quality.annotated(df, RULES[:2])
    good = [r.id for r in quality.passed(checked).collect()]
    bad = [r.id for r in checked.where("dq_errors is not null").collect()]
    assert sorted(good + bad) == list(range(len(values)))
    assert bad == [i for i, v in enumerate(values) if v is not None and v <= 0]
