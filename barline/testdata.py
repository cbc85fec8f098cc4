"""The engine's inputs from the TPC-H-like test tables. Nothing is rounded here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

SESSION_START_MS = (14 * 60 + 30) * 60_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars "L": each line item is a bar of its supplier, minutes of a day in line order from 14:30 UTC."""
    opened, closed = F.col("l_extendedprice"), F.col("l_extendedprice") * (F.lit(0.95) + F.col("l_discount"))
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        opened.alias("open"),
        (F.greatest(opened, closed) + 100 * F.col("l_tax")).alias("high"),
        (F.least(opened, closed) - 100 * F.col("l_tax")).alias("low"),
        closed.alias("close"),
        (F.col("l_quantity").cast("long") * 100).alias("volume"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", "l_tax",
    )
    # Numbered by the columns that daily bars are grouped by: these need no second shuffle, and filters on symbol or
    # date go below the window.
    seq = F.row_number().over(W.partitionBy("symbol", "date").orderBy("l_orderkey", "l_linenumber", "l_partkey", "open", "l_quantity"))
    start = F.unix_millis(F.col("date").cast("timestamp")) + SESSION_START_MS + (seq - 1) * 60_000
    rows = rows.withColumn("start_timestamp", start.cast("long"))
    return rows.select(
        "symbol", "date", "start_timestamp", (F.col("start_timestamp") + 60_000).alias("end_timestamp"), "open", "high", "low", "close", "volume",
        F.lit("flatfile").alias("source"), F.lit("ms").alias("ts_unit"), F.lit(None).cast("boolean").alias("otc"),
        F.timestamp_seconds(F.lit(1_000_000_000)).alias("ingestion_timestamp"), "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_tax",
    )


BAR_COLUMNS = ("symbol", "date", "start_timestamp", "end_timestamp", "open", "high", "low", "close", "volume", "source", "ts_unit", "otc", "ingestion_timestamp")


def plain_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute_bars(spark, sf_dir).select(*BAR_COLUMNS)


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars "L" with faults: low above high, negative volume, opening price 0, and a few null closes."""
    b = minute_bars(spark, sf_dir)
    return (
        b.withColumn("low", F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.col("high") + 1).otherwise(F.col("low")))
        .withColumn("volume", F.when(F.col("l_quantity") == 50, -1).otherwise(F.col("volume")))
        .withColumn("open", F.when((F.col("l_tax") == 0) & (F.col("l_linenumber") == 1), 0.0).otherwise(F.col("open")))
        .withColumn("close", F.when(F.col("l_orderkey") % 997 == 0, None).otherwise(F.col("close")))
        .select(*BAR_COLUMNS)
    )


def competing_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars "L" and, for a fifth of the orders, later versions of them from the stream."""
    b = minute_bars(spark, sf_dir)
    late = b.where(F.col("l_orderkey") % 5 == 0).withColumn("close", F.col("close") * 1.01).withColumn("source", F.lit("stream"))
    late = late.withColumn("ingestion_timestamp", F.timestamp_seconds(F.lit(1_500_000_000)))
    return b.unionByName(late).select(*BAR_COLUMNS)


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars "E": events of a type by minute."""
    e = table(spark, sf_dir, "events").select(
        F.upper("event_type").alias("symbol"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "event_id", "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    e = e.withColumn("start_timestamp", F.col("ms") - F.col("ms") % 60_000)
    order = F.struct("ms", "event_id")
    return e.groupBy("symbol", "start_timestamp").agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.sum("k").alias("volume")
    )


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0")
    symbol = F.concat(F.lit("S"), "s_suppkey").alias("symbol")
    shift = (F.col("s_suppkey") % 200).cast("int")
    both = F.col("s_suppkey") % 6 == 0
    first = s.select(symbol, F.date_add(F.lit("1997-06-02").cast("date"), shift).alias("execution_date"), F.lit(1.0).alias("split_from"), F.lit(2.0).alias("split_to"), F.when(both, 0.1).otherwise(0.5).alias("historical_adjustment_factor"))
    second = s.where(both).select(symbol, F.date_add(F.lit("1999-06-01").cast("date"), shift).alias("execution_date"), F.lit(1.0).alias("split_from"), F.lit(5.0).alias("split_to"), F.lit(0.2).alias("historical_adjustment_factor"))
    return first.unionByName(second).withColumn("adjustment_type", F.lit("forward_split"))


def ticker_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as companies, in two snapshots of which the later counts."""
    s = table(spark, sf_dir, "supplier")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    active, x = F.col("s_suppkey") % 10 != 0, F.greatest(F.col("s_acctbal"), F.lit(0.0))
    sic = F.concat(F.lpad((10 + 3 * F.col("s_nationkey")).cast("string"), 2, "0"), F.lit("00"))
    now = j.select(
        F.concat(F.lit("S"), "s_suppkey").alias("symbol"),
        F.col("s_name").alias("name"),
        F.element_at(F.array(*map(F.lit, ("CS", "ETF", "ADRC", "WARRANT"))), (F.col("s_suppkey") % 4 + 1).cast("int")).alias("type"),
        active.alias("active"),
        F.when(active, F.col("r_name")).alias("primary_exchange"),
        F.when(F.col("s_suppkey") % 7 != 0, sic).alias("sic_code"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("n_name")).alias("sic_description"),
        F.when(F.col("s_suppkey") % 11 != 0, x * x * x).alias("market_cap"),
        F.lit("1990-01-02").alias("list_date"),
    )
    before = now.where("symbol <> 'S1'").withColumn("name", F.lit("old"))
    return before.withColumn("snapshot_date", F.lit("2001-11-01").cast("date")).unionByName(now.withColumn("snapshot_date", F.lit("2001-11-04").cast("date")))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles; some have a broken address, a blank title, blanks around it, no description, a bad
    date or a null ticker."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    count = pages.agg(F.count(F.lit(1)).alias("n_pages"))
    suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n_symbols"))
    d = d.crossJoin(F.broadcast(count)).crossJoin(F.broadcast(suppliers))
    d = d.join(pages, F.col("doc_id") % F.col("n_pages") == F.col("page_id"), "left")
    i = F.col("doc_id")

    def ticker(shift: int):
        return F.concat(F.lit("S"), (i + shift) % F.col("n_symbols") + 1)

    tickers = F.when(i % 3 == 0, F.array(ticker(0))).when(i % 3 == 1, F.array(ticker(0), ticker(7))).otherwise(F.array(ticker(0), ticker(7), ticker(0)))
    tickers = F.when(i % 29 == 0, F.array(ticker(0), F.lit(None))).otherwise(tickers)
    day = F.date_add(F.lit("2001-10-01").cast("date"), (i % 34).cast("int"))
    return d.select(
        i.cast("string").alias("article_id"),
        F.when(i % 31 == 0, F.lit("  ")).when(i % 5 == 0, F.concat(F.lit("  "), F.substring("text", 1, 80), F.lit(" "))).otherwise(F.substring("text", 1, 80)).alias("title"),
        F.when(i % 23 == 0, None).when(i % 7 == 0, F.concat(F.lit("   "), "text")).otherwise(F.col("text")).alias("description"),
        F.col("source").alias("author"),
        F.when(i % 41 == 0, F.lit("no date")).otherwise(F.concat(day.cast("string"), F.lit("T12:00:00Z"))).alias("published_utc"),
        F.when(i % 37 == 0, F.concat(F.lit("ftp:"), F.col("url"))).otherwise(F.col("url")).alias("article_url"),
        F.when(i % 2 == 0, F.col("url")).alias("image_url"),
        tickers.alias("tickers"),
        F.array("lang", "source").alias("keywords"),
        F.lit("Wire").alias("publisher_name"),
        F.to_timestamp(F.lit("2001-12-01 00:00:00")).alias("ingestion_timestamp"),
    )
