"""Silver streams that count what they keep and drop, in the pass that writes the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tapeloom.functions.columns import Moment
from tapeloom.operators.quality import EXECUTION_RULES, ORDER_RULES, TICK_RULES, Rules, expect_or_drop, rule_counts
from tapeloom.operators.touched import keys_of, split_by_keys
from tapeloom.plans.silver import enriched_executions, enriched_orders, enriched_ticks
from tapeloom.session import tune
from tapeloom.sources.layout import Layout, read_table, write_batch
from tapeloom.streaming.jobs import ONCE, Trigger, _each_batch, _source

#: The bronze table and the rules of each silver table.
SILVER: dict[str, tuple[str, Rules]] = {
    "market_data_silver": ("raw_market_data", TICK_RULES),
    "orders_silver": ("raw_orders", ORDER_RULES),
    "executions_silver": ("raw_executions", EXECUTION_RULES),
}
METRICS = "table_name string, batch bigint, rule string, passed bigint, failed bigint, total bigint, kept bigint"
LATE_ROWS = "query string, batch bigint, late_rows bigint"


def _metrics_path(layout: Layout, name: str) -> str:
    return f"{layout.path('silver_metrics')}/of={name}"


def write_counted(enriched: DataFrame, layout: Layout, name: str, batch: int) -> None:
    """Write the rows of a batch that hold all rules, and how many hold each; one pass, and a retry replaces both."""
    rules = SILVER[name][1]
    counts = Observation(f"{name}-{batch}")
    write_batch(expect_or_drop(enriched.observe(counts, *rule_counts(rules)), rules), layout, name, batch)
    found = counts.get
    rows = [
        (name, batch, rule, found[f"rule_{i}"], found["total"] - found[f"rule_{i}"], found["total"], found["kept"])
        for i, rule in enumerate(rules)
    ]
    metrics = enriched.sparkSession.createDataFrame(rows, METRICS)
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{_metrics_path(layout, name)}/at={batch}")


def start_counted_silver(
    spark: SparkSession, layout: Layout, name: str, trigger: Trigger = ONCE, max_files: int | None = None, as_of: Moment = None,
) -> StreamingQuery:
    """`start_silver` with the numbers of rows that passed and failed each expectation, by batch.

    Ticks are de-duplicated before they are counted, so copies and late rows are not among them; `late_rows`
    has the latter.
    """
    tune(spark, streaming=True)
    stream = _source(spark, layout, SILVER[name][0], max_files)
    if name == "market_data_silver":
        stream = enriched_ticks(stream)

    def enriched(batch: DataFrame) -> DataFrame:
        if name == "orders_silver":
            return enriched_orders(batch, read_table(batch.sparkSession, layout, "etf_reference"), as_of)
        if name == "executions_silver":
            orders = read_table(batch.sparkSession, layout, "raw_orders")
            return enriched_executions(batch, split_by_keys(orders, keys_of(batch)).touched)
        return batch

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_counted(enriched(batch), layout, name, batch_id)

    return _each_batch(stream, layout, name, trigger, handle)


def read_metrics(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """(table_name, batch, rule, passed, failed, total, kept) of a silver table's batches so far."""
    return spark.read.schema(METRICS).parquet(f"{_metrics_path(layout, name)}/*")


def late_rows(query: StreamingQuery) -> DataFrame:
    """(query, batch, late_rows): rows that each recent batch dropped since they came after the watermark."""
    dropped: dict[int, int] = {}
    for progress in query.recentProgress:
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in progress["stateOperators"])
        dropped[progress["batchId"]] = max(late, dropped.get(progress["batchId"], 0))
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(query.name, b, n) for b, n in sorted(dropped.items())], LATE_ROWS)


def append_late_rows(layout: Layout, query: StreamingQuery) -> None:
    """Keep the numbers of late rows of a query; called again, it replaces those of the same batches."""
    rows = late_rows(query)
    first = rows.agg(F.min("batch")).first()[0]
    if first is not None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{layout.path('late_rows')}/of={query.name}/from={first}")


def read_late_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    rows = spark.read.schema(LATE_ROWS).parquet(f"{layout.path('late_rows')}/*/*")
    return rows.groupBy("query", "batch").agg(F.max("late_rows").alias("late_rows"))
