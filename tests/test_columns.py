import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, PySparkException

from stratum.operators.columns import (
    LineageNames,
    RunInfo,
    all_text,
    converted,
    filled,
    keep,
    moved_last,
    renamed,
    standardized,
    with_expressions,
    with_lineage,
    without,
)
from stratum.operators.names import ILLEGAL, clean_names, illegal_names, with_clean_names


def test_expressions_build_on_each_other(spark):
    df = with_expressions(spark.range(2), [("a", "id + 1"), ("b", "a * 2")])
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(0, 1, 2), (1, 2, 4)]


def test_bad_expression_fails_or_is_skipped(spark):
    with pytest.raises(AnalysisException):
        with_expressions(spark.range(1), [("a", "nope + 1")])
    assert with_expressions(spark.range(1), [("a", "nope + 1"), ("b", "id +")], "skip").columns == ["id"]
    with pytest.raises(ValueError):
        with_expressions(spark.range(1), [], "ignore")


def test_lineage_columns_and_types(spark):
    run = RunInfo("c", "j", "r", "u", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    df = with_lineage(spark.range(1), run, file_name="f.csv")
    assert dict(df.dtypes) == {
        "id": "bigint", "file_name": "string", "correlation_id": "string", "job_id": "string", "run_id": "string",
        "load_create_user_id": "string", "load_update_user_id": "string", "load_create_dtm": "timestamp",
        "load_update_dtm": "timestamp"}
    row = df.first()
    assert (row.file_name, row.run_id, row.load_update_dtm) == ("f.csv", "r", None)


def test_lineage_names_can_be_prefixed(spark):
    df = with_lineage(spark.range(1), RunInfo(), "f", LineageNames(job="platform_job_id", run="platform_run_id"))
    assert "platform_job_id" in df.columns and "job_id" not in df.columns


def test_lineage_keeps_existing_file_name(spark):
    df = with_lineage(spark.sql("select 'x.csv' as file_name"), RunInfo())
    assert df.first().file_name == "x.csv"


def test_rename_is_sequential_and_case_sensitive(spark):
    assert renamed(spark.sql("select 1 a, 2 B"), {"a": "c", "c": "d", "b": "x"}).columns == ["d", "B"]


def test_standardize_order_and_edges(spark):
    df = spark.createDataFrame([(" Ab\t ", " Cd ", 1), (None, "", 2), ("É ", "ß", 3)], "a string, b string, n int")
    rows = standardized(df, case="lower", trim_all=True, upper=["b"]).collect()
    assert [tuple(r) for r in rows] == [("ab\t", "CD", 1), (None, "", 2), ("é", "SS", 3)]


def test_standardize_protects_columns(spark):
    df = spark.sql("select 'a' x, 'b' file_name")
    assert tuple(standardized(df, case="upper", protect=["file_name"]).first()) == ("A", "b")
    with pytest.raises(ValueError):
        standardized(df, case="title")


def test_standardize_is_one_projection(spark):
    df = standardized(spark.read.parquet("/root/testdata/sf0.001/customer.parquet"), rename={"c_name": "n"},
                      case="upper", trim_all=True, lower=["n"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_casts(spark):
    df = spark.createDataFrame([("1",), (" 2 ",), ("x",), ("",), (None,), ("1e3",)], "n string")
    assert [r.n for r in converted(df, [("n", "int")], "null").collect()] == [1, 2, None, None, None, None]
    with pytest.raises(PySparkException):
        converted(df, [("n", "int")]).collect()
    assert converted(df, [("missing", "int"), ("n", "")]).dtypes == [("n", "string")]


def test_dotted_names_are_quoted(spark):
    df = spark.sql("select 1 as `a.b`, 'x' as `c.d`")
    assert converted(df, [("a.b", "string")]).dtypes[0] == ("a.b", "string")
    assert all_text(df).columns == ["a.b", "c.d"]
    assert standardized(df, case="upper").first()[1] == "X"
    assert keep(df, ["c.d", "zz"]).columns == ["c.d"]
    assert without(df, ["a.b", "zz"]).columns == ["c.d"]
    assert moved_last(df, "a.b").columns == ["c.d", "a.b"]


def test_fill(spark):
    df = spark.createDataFrame([(None, None)], "a int, b string")
    assert tuple(filled(df, {"a": 3, "b": "z"}).first()) == (3, "z")


def test_clean_names_examples():
    assert clean_names(["na me", "a;b", "_id", "A", "a", "()", "x__y"]) == ["na_me", "a_b", "_id", "A", "a_1", "col", "x_y"]
    assert clean_names(["_id", "A", "a"], compat=True) == ["id", "A", "a"]
    assert illegal_names(["ok", "not ok", "a=b"]) == ["not ok", "a=b"]


@given(st.lists(st.text(alphabet="aAbB_ ,;{}()\n\t=1", max_size=6), max_size=8))
def test_clean_names_are_legal_unique_and_stable(names):
    cleaned = clean_names(names)
    assert len(cleaned) == len(names)
    assert not any(ILLEGAL.search(n) or not n for n in cleaned)
    assert len({n.lower() for n in cleaned}) == len(cleaned)
    assert clean_names(cleaned) == cleaned


def test_clean_names_on_frame(spark):
    assert with_clean_names(spark.sql("select 1 as `a b`, 2 as `a;b`")).columns == ["a_b", "a_b_1"]
