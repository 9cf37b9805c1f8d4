"""Queries against their SQL on small tables with odd values, made for each test."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siftwork.functions import text
from siftwork.streaming import ledgers
from tests.compare import compare


def against_sql(spark, folder, name, **tables):
    con = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    return compare(spark, con, str(folder), name, entry.queries()[name], entry.oracle_sql()[name])


@pytest.mark.parametrize("domain, reachable", [("mail2.example.com", 4000), ("mail2.example.com", 3900), ("MAIL2.example.com", 3900)])
def test_coverage_rounds_and_compares_as_its_sql(spark, tmp_path, domain, reachable):
    """103 of 4,000 are 2.575 percent, which a double holds as 2.5749999999999997."""
    mail = F.when(F.col("id") < 101, F.concat(F.lit("write to a@"), F.lit(domain))).when(F.col("id") < 103, F.lit("b@mail5.example.com.")).when(F.col("id") == 200, F.lit(None)).otherwise(F.lit("no @ here"))
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), mail.alias("text"), F.when(F.col("id") % 7 > 0, F.lit("en")).alias("lang"), F.lit("s").alias("source"),
        F.when(F.col("id") < reachable, F.lit(300)).cast("long").alias("n_chars"))
    ok, note = against_sql(spark, tmp_path / "t", "A18_coverage", documents=docs)
    assert ok, note


def test_rounding_is_that_of_the_sql_engine(spark):
    cases = [(103, 4000, 2), (309, 12000, 2), (1, 8, 2), (-103, 4000, 2), (2, 3, 4), (0, 5, 1)]
    for a, b, n in cases:
        got = spark.range(1).select(text.rounded(F.lit(float(a)) / b * 100, n)).first()[0]
        assert got == duckdb.connect().execute(f"SELECT round(CAST({a} AS DOUBLE) / {b} * 100, {n})").fetchone()[0]


@pytest.mark.parametrize("name", ["W10_deep_scan", "A3_repeated_contact"])
def test_contact_scans_shuffle_no_text_and_cut_rows_first(spark, name):
    lines = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(entity_id" in line:
            below = "".join(lines[i + 1:i + 4])
            assert "WindowGroupLimit" in below or "HashAggregate" in below, below
    assert any("WindowGroupLimit" in line for line in lines)
    for i, line in enumerate(lines):
        if "WindowGroupLimit" in line and "Partial" in line:
            project = next(x for x in lines[i:] if "Project" in x)
            assert "regexp_extract_all" in project and "description" not in project


def test_a_new_entry_costs_two_calls_to_the_state():
    calls = []

    class State:
        def __getattr__(self, name):
            return lambda *a: calls.append(name)

        def getValueState(self, *a):
            return self

    class Times:
        getCurrentWatermarkInMs = staticmethod(lambda: 0)

    entry_of = ledgers._Retained(7, ["label"])
    entry_of.init(State())
    rows = list(entry_of.handleInputRows(("day 1",), iter([pd.DataFrame({"start_ms": [-1, -1], "day": ["day 1"] * 2})]), Times))
    assert rows[0].values.tolist() == [["day 1", "day 1", 2, -1, False]] and calls == ["get", "update"]
