"""Plans that must hold at scale: scalars in filters prune partitions, no nested-loop joins."""

import datetime as dt

import pytest

from barline.operators import facts
from barline.plans import analytics
from barline.sources.storage import ParquetTable, unknown_rows


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('fact')}/fact"
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(12)]
    rows = [(f"S{s}", d, 1000 * k, 10.0 + s + k) for s in range(3) for k, d in enumerate(days)]
    spark.createDataFrame(rows, "symbol string, date date, start_timestamp long, close double").write.partitionBy("date").parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("make", "days"), [(lambda f: facts.since_latest(f, 3), 4), (analytics.latest_day, 1), (lambda f: unknown_rows(f.where("date > '2024-01-09'"), f, ["symbol", "close"]), 0)])
def test_latest_dates_prune_partitions(fact, make, days):
    df = make(fact)
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
    filters = [x for x in plan(df).replace("\n", " ").split("FileScan") if "PartitionFilters" in x]
    assert any("ubquery" in x.split("PartitionFilters")[1].split("PushedFilters")[0] for x in filters)
    assert df.count() == 3 * days


def test_replace_is_in_the_history(spark, tmp_path, fact):
    table = ParquetTable(spark, f"{tmp_path}/t")
    table.create(fact.where("date > '2024-01-09'"))
    assert table.replace(fact.where("symbol = 'S1'"))["rows"] == 12
    assert table.read().count() == 12
    assert [r.operation for r in table.history().collect()] == ["replace", "create"]
