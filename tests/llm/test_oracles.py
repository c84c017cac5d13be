"""The queries that SQL can express, against their SQL."""

import duckdb
import pytest

from oracle import connect, difference
from stratum.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_line_frequency_sql_counts_lines_of_any_length(spark, tmp_path):
    notice = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{notice}\n" + " ".join(f"own{i}x{k}" for k in range(25)), "en", "host", 0) for i in range(30)]
    rows += [(100 + i, " ".join(f"other{i}y{k}" for k in range(25)), "en", "host", 0) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").toPandas().to_parquet(
        f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    df = QUERIES["op3_line_frequency"](spark, str(tmp_path))
    assert df.where("n_removed_words = 60").count() == 30
    assert difference(df, con, ORACLES["op3_line_frequency"]) is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None
