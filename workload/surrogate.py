"""Trip records and observations derived from the given ``events`` table.

Same derivation as the first two relations of ``oracle``.  Amounts, temperatures
and durations are multiples of powers of two, so sums do not depend on the order
of the rows and both engines agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR, MONTH = 2024, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips, every fiftieth twice, with rows each rule rejects, stray years,
    unreadable rate codes, no airport fee and one capitalised column."""
    rides = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "CAST(trim(BOTH '{\"k: }' FROM props) AS int) AS k",
        "IF(event_id % 97 = 0, ts - INTERVAL 22 YEARS, ts) AS pickup",
        """CASE WHEN event_id % 53 = 0 THEN 0.0D WHEN event_id % 59 = 0 THEN -20.0D
                WHEN event_id % 61 = 0 THEN 12000.0D ELSE floor(value * 4) / 4.0D END AS fare""",
        "greatest(0.0D, fare) * (event_id % 5) * 0.25D AS tip",
        "explode(IF(event_id % 50 = 0, array(1, 2), array(1))) AS copy",
    )
    return rides.selectExpr(
        "event_id % 2 + 1 AS VendorID",
        "pickup AS tpep_pickup_datetime",
        """pickup + make_dt_interval(0, 0, k - 3, CAST((event_id % 4) * 15 AS DECIMAL(18, 6)))
               AS tpep_dropoff_datetime""",
        "IF(event_id % 83 <> 0, event_id % 11, NULL) AS passenger_count",
        "k * 6.0D AS trip_distance",
        "IF(event_id % 41 = 0, 'n/a', CAST(event_id % 6 + 1 AS string)) AS RatecodeID",
        "IF(event_id % 10 = 0, 'Y', 'N') AS store_and_fwd_flag",
        "(user_id * 17 + event_id) % 270 AS PULocationID",
        "(user_id * 7 + event_id) % 270 AS DOLocationID",
        """CASE WHEN event_type IN ('purchase', 'click') THEN 1 WHEN event_type = 'view' THEN 2
                WHEN event_type = 'signup' THEN 3 ELSE 4 END AS payment_type""",
        "fare AS fare_amount",
        "(event_id % 3) * 0.5D AS extra",
        "0.5D AS mta_tax",
        "tip AS tip_amount",
        "IF(event_id % 7 = 0, 6.5D, 0.0D) AS tolls_amount",
        "1.0D AS improvement_surcharge",
        "fare + tip AS total_amount",
        "2.5D AS Congestion_Surcharge",
    )


def observations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations with missing, short and unreadable fields, whole days
    without temperature (gaps) and one day of wrongly marked missing values."""
    read = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts",
        "day(ts) AS d",
        "CAST(trim(BOTH '{\"k: }' FROM props) AS int) AS k",
        "((event_id * 7) % 140 - (d % 6) * 20) * 5 AS tenths",
    )
    return read.selectExpr(
        "event_id",
        """IF(event_id % 101 = 0, 'no date', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) AS DATE""",
        """CASE WHEN d = 20 THEN '+9999,1' WHEN d % 9 = 0 THEN '+9999,9'
                WHEN event_id % 40 = 0 THEN '+9999,9' WHEN event_id % 71 = 0 THEN '12d,1'
                ELSE concat(IF(tenths < 0, '-', '+'), lpad(abs(tenths), 4, '0'), ',1')
           END AS TMP""",
        """CASE WHEN event_id % 61 = 0 THEN '090,1' WHEN event_id % 67 = 0 THEN '090,1,N,9999,9'
                ELSE concat('090,1,N,', lpad((k % 40) * 5, 4, '0'), ',1') END AS WND""",
        """CASE WHEN event_id % 6 = 0 THEN '01' WHEN event_id % 3 = 0
                THEN concat('01,', lpad(IF(d % 4 = 0, 0, k * 5), 4, '0'), ',1,1') END AS AA1""",
    )


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the month of their date as partition columns."""
    return table(spark, sf_dir, "orders").withColumns(
        {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )


def shifted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which some lie in the partition of a later month."""
    shelved = F.col("o_orderdate") + F.when(
        F.col("o_orderkey") % 97 == 0, F.expr("INTERVAL 40 DAYS")
    ).otherwise(F.expr("INTERVAL 0 DAYS"))
    return table(spark, sf_dir, "orders").withColumns(
        {"year": F.year(shelved), "month": F.month(shelved)}
    )


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest order price per status and day, with gaps: single days, pairs of
    days, and days at the ends of months."""
    day = F.dayofmonth("day")
    gap = day.isin(1, 7, 8, 15, 31)
    highest = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus", F.to_date("o_orderdate").alias("day"))
        .agg(F.max("o_totalprice").alias("price"))
    )
    return highest.withColumn("price", F.when(~gap, F.col("price")))


def order_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the file inventory of a dataset: one row per month with files, bytes
    and the newest modification."""
    return order_months(spark, sf_dir).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.col("o_orderkey") % 1000).alias("bytes"),
        F.max(F.col("o_orderdate").cast("timestamp")).alias("newest"),
    )
