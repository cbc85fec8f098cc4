"""market_times over every bar, against a plain version."""

import datetime as dt
from zoneinfo import ZoneInfo

from barline.plans import catalog


def test_every_bar_has_its_market_time(spark, tmp_path):
    days = [dt.date(2001, 1, 15), dt.date(2001, 7, 16), dt.date(2001, 10, 29)]
    rows = [(k, 1, 1, k % 3, 10.0 + k, 5.0, 0.05, 0.01, "N", days[k % len(days)]) for k in range(30)]
    shape = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_shipdate date"
    spark.createDataFrame(rows, shape).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = catalog.QUERIES["market_times"](spark, str(tmp_path)).collect()
    want, nth = [], {}
    for row in rows:
        key = (row[3], row[-1])
        minute = nth[key] = nth.get(key, -1) + 1
        at = dt.datetime.combine(row[-1], dt.time(14, 30), dt.timezone.utc) + dt.timedelta(minutes=minute)
        local = at.astimezone(ZoneInfo("America/New_York"))
        seconds = int(at.timestamp())
        want.append((f"S{row[3]}", seconds * 1000, seconds, local.date(), local.hour * 100 + local.minute))
    assert sorted(map(tuple, got)) == sorted(want)
