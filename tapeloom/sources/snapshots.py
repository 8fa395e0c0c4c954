"""JSON files for consumers outside Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.columns import Moment, moment
from tapeloom.schemas import STATUSES

SNAPSHOT_DDL = (
    "ticker string, generated_at timestamp, last_price double, bid double, ask double, "
    "volume bigint, vwap double, intraday_high double, intraday_low double"
)


def market_snapshot_json(snapshot: DataFrame, path: str, as_of: Moment = None) -> None:
    """One JSON file per ticker, in a folder named after it."""
    (
        snapshot.select(
            F.col("ticker").alias("symbol"),
            "ticker",
            moment(as_of).alias("generated_at"),
            "last_price", "bid", "ask", "volume", "vwap", "intraday_high", "intraday_low",
        )
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .partitionBy("symbol")
        .json(path)
    )


def read_market_snapshot_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT_DDL).json(path).drop("symbol")


def order_summary(orders: DataFrame, executions: DataFrame, as_of: Moment = None) -> DataFrame:
    """One row: when, how many orders and executions, and orders per status."""
    rows = orders.select(F.lit(True).alias("is_order"), "status").unionByName(
        executions.select(F.lit(False).alias("is_order")), allowMissingColumns=True
    )
    status = F.col("status")
    return rows.agg(
        F.count_if("is_order").alias("total_orders"),
        F.count_if(~F.col("is_order")).alias("total_executions"),
        F.struct(*[F.count_if(status == s).alias(s) for s in STATUSES]).alias("status_counts"),
    ).withColumn("generated_at", moment(as_of)).select(
        "generated_at", "total_orders", "total_executions", "status_counts"
    )


def order_summary_json(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
