"""Order state: applying batches of trader actions to the live orders.

An action is judged by what precedes it for the same order, in the order of
(ts, action_id). That needs no sequential replay:

* an order is filled by its first EXECUTE and never reopens; its first CANCEL closes
  it for everything except an EXECUTE;
* size and price actions count while the order is open and their value is positive,
  so the size or price before an action is the last such value before it.

Both are prefix expressions over windows. One order may own a large share of all
actions, so no window over actions spans an order: actions are sorted by order, time and id
over all tasks, and a slice is what one task has of an order, however its actions spread over
time. What a slice inherits comes from the summaries of the earlier slices of its order, of which
there are no more than tasks. The sliced actions are stored once and read twice.

An action that is delivered again as it was counts once. An action whose id was used by an
earlier, different action is rejected.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.columns import bps_from, json_object, or_default
from tapeloom.operators.quality import with_defaults
from tapeloom.schemas import ACTION_TYPES, CLOSED_STATUSES, TABLES
from tapeloom.session import scratch_dir

# Why an action is rejected, with the code its caller sees.
REJECTIONS = {
    "REPEATED_ID": 409,
    "UNKNOWN_ACTION": 404,
    "BAD_VALUE": 400,
    "BAD_HEDGE": 422,
    "UNKNOWN_ORDER": 404,
    "CLOSED": 400,
    "NO_PRICE": 500,
}
ACCEPTED = "OK"

_SLICE = ["order_id", "slice"]


class OrderState(NamedTuple):
    live_orders: DataFrame
    audit: DataFrame
    rejected: DataFrame
    hedge_requests: DataFrame


def _before(*partition: str, order: tuple[str, ...]):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _once(actions: DataFrame) -> DataFrame:
    """Distinct actions; `acts` is the type of those whose id no earlier action has."""
    content = F.xxhash64(*TABLES["actions"].columns)
    same_id = Window.partitionBy("action_id", F.when(F.col("action_id").isNull(), content)).orderBy("ts", content)
    return (
        actions.select(*TABLES["actions"].columns).distinct()
        .withColumn("is_repeated", F.row_number().over(same_id) > 1)
        .withColumn("acts", F.when(~F.col("is_repeated"), F.col("action_type")))
    )


def _with_slices(actions: DataFrame) -> DataFrame:
    """Actions with the number of their slice, which ascends along an order."""
    ordered = actions.repartitionByRange("order_id", "ts", "action_id")
    return ordered.withColumn("slice", F.spark_partition_id())


def _with_prefixes(actions: DataFrame) -> DataFrame:
    """Actions with their position, and what precedes each inside its own slice."""
    kind = F.col("acts")
    earlier = _before(*_SLICE, order=("ts", "action_id"))
    open_size = (kind == "ADJUST_SIZE") & (F.col("qty") > 0) & ~F.col("cancel_seen")
    open_price = (kind == "ADJUST_PRICE") & (F.col("price_limit") > 0) & ~F.col("cancel_seen")
    dated = with_defaults(actions, {**TABLES["actions"].defaults, "ts": F.current_timestamp()})
    return (
        _with_slices(_once(dated))
        .withColumn("seq", F.struct("ts", "action_id"))
        .withColumn("cancel_seen", F.coalesce(F.max(kind == "CANCEL").over(earlier), F.lit(False)))
        .withColumns({
            "size_value": F.when(open_size, F.col("qty")),
            "price_value": F.when(open_price, F.col("price_limit")),
            "hedge_value": F.when((kind == "HEDGE") & _hedge_is_whole(), F.col("action_id")),
        })
        .withColumns({
            f"{name}_seen": F.last(f"{name}_value", ignorenulls=True).over(earlier)
            for name in ("size", "price", "hedge")
        })
    )


def _sliced(actions: DataFrame) -> DataFrame:
    """The same, stored, since slices have to stay as they are."""
    sliced = _with_prefixes(actions)
    path = scratch_dir(actions.sparkSession, "sliced-actions")
    sliced.write.parquet(path)
    return actions.sparkSession.read.schema(sliced.schema).parquet(path)


def _hedge_is_whole() -> Column:
    """A hedge names instrument, side, size and type."""
    whole = F.lit(True)
    for name in TABLES["hedge_requests"].not_null:
        if name != "parent_order_id":
            whole = whole & F.col(name).isNotNull()
    return whole


def _inherited(sliced: DataFrame, live: DataFrame, prices: DataFrame) -> DataFrame:
    """Per slice: the order's initial state, what earlier slices left, when it closes."""
    kind, seq = F.col("acts"), F.col("seq")
    summaries = sliced.groupBy(*_SLICE).agg(
        F.max(kind == "CANCEL").alias("has_cancel"),
        F.min(F.when(kind == "CANCEL", seq)).alias("cancel_seq"),
        F.min(F.when(kind == "EXECUTE", seq)).alias("execute_seq"),
        F.min(F.when((kind == "EXECUTE") & F.col("price_seen").isNotNull(), seq)).alias("priced_seq"),
        F.max_by("size_value", F.when(F.col("size_value").isNotNull(), seq)).alias("last_size"),
        F.max_by("price_value", F.when(F.col("price_value").isNotNull(), seq)).alias("last_price"),
        F.max_by("hedge_value", F.when(F.col("hedge_value").isNotNull(), seq)).alias("last_hedge"),
    )
    earlier = _before("order_id", order=("slice",))
    whole = Window.partitionBy("order_id")
    still_open = ~F.col("cancelled_earlier")
    initial = live.select(
        "order_id", F.lit(True).alias("known"),
        F.col("status").alias("status0"), F.col("qty").alias("qty0"),
        F.col("price_limit").alias("price0"), F.col("filled_qty").alias("filled0"),
        F.col("assigned_hedge_id").alias("hedge0"), "arrival_price",
        F.col("etf_ticker").alias("ticker"),
    )
    market = prices.select("ticker", F.col("last_price").alias("market_price"))
    open0 = ~F.col("status0").isin(*CLOSED_STATUSES)
    # An EXECUTE needs a price unless there is no arrival price to compare it with.
    always_priced = (
        F.col("market_price").isNotNull()
        | ~F.coalesce(F.col("arrival_price") > 0, F.lit(False))
        | F.col("price0").isNotNull()
    )
    executable = (
        F.when(always_priced | (open0 & F.col("carry_price").isNotNull()), F.col("execute_seq"))
        .when(open0 & still_open, F.col("priced_seq"))
    )
    return (
        summaries
        .withColumn("cancelled_earlier", F.coalesce(F.max("has_cancel").over(earlier), F.lit(False)))
        .withColumns({
            "carry_size": F.last(F.when(still_open, F.col("last_size")), True).over(earlier),
            "carry_price": F.last(F.when(still_open, F.col("last_price")), True).over(earlier),
            "carry_hedge": F.last("last_hedge", True).over(earlier),
            "closed_at": F.min("cancel_seq").over(whole),
        })
        .join(initial, "order_id", "left")
        .join(market, "ticker", "left")
        .withColumns({"open0": open0, "executable": F.when(F.col("status0") != "FILLED", executable)})
        .withColumn("filled_at", F.min("executable").over(whole))
        .select(
            *_SLICE, "known", "open0", "status0", "filled0", "arrival_price", "market_price",
            "price0", "cancelled_earlier", "closed_at", "filled_at",
            F.coalesce(F.when(F.col("open0"), F.col("carry_size")), "qty0").alias("slice_size"),
            F.coalesce(F.when(F.col("open0"), F.col("carry_price")), "price0").alias("slice_price"),
            F.coalesce(F.col("carry_hedge").cast("string"), "hedge0").alias("slice_hedge"),
        )
    )


def judge_actions(
    live_orders: DataFrame,
    actions: DataFrame,
    snapshot: DataFrame,
) -> DataFrame:
    """Every action with its verdict, the status of its order before it and the value it replaces.

    qty_before is given for size actions, price_before for price actions and
    executions, hedge_before for hedges, filled_before for executions.
    """
    sliced = _sliced(actions)
    before = sliced.join(_inherited(sliced, live_orders, snapshot), _SLICE, "left")
    kind, seq = F.col("action_type"), F.col("seq")
    live_here = F.col("open0") & ~F.col("cancelled_earlier")
    filled = (F.col("status0") == "FILLED") | F.coalesce(F.col("filled_at") < seq, F.lit(False))
    cancelled = (F.col("status0") == "CANCELLED") | F.coalesce(F.col("closed_at") < seq, F.lit(False))
    status = F.when(filled, "FILLED").when(cancelled, "CANCELLED").otherwise(F.col("status0"))
    bad = (
        ((kind == "ADJUST_SIZE") & ~F.coalesce(F.col("qty") > 0, F.lit(False)))
        | ((kind == "ADJUST_PRICE") & ~F.coalesce(F.col("price_limit") > 0, F.lit(False)))
    )
    closed = (
        (kind.isin("CANCEL", "ADJUST_SIZE", "ADJUST_PRICE") & F.col("status_before").isin(*CLOSED_STATUSES))
        | ((kind == "EXECUTE") & (F.col("status_before") == "FILLED"))
    )
    unpriced = (kind == "EXECUTE") & ~F.coalesce(F.col("filled_at") == seq, F.lit(False))
    return (
        before
        .withColumns({
            "status_before": status,
            "qty_before": F.coalesce(F.when(live_here, F.col("size_seen")), "slice_size"),
            "price_before": F.coalesce(F.when(live_here, F.col("price_seen")), "slice_price"),
            "hedge_before": F.coalesce(F.col("hedge_seen").cast("string"), "slice_hedge"),
        })
        .withColumn(
            "verdict",
            F.when(F.col("is_repeated"), "REPEATED_ID")
            .when(~F.coalesce(kind.isin(*ACTION_TYPES), F.lit(False)), "UNKNOWN_ACTION")
            .when(bad, "BAD_VALUE")
            .when((kind == "HEDGE") & ~_hedge_is_whole(), "BAD_HEDGE")
            .when(F.col("known").isNull(), "UNKNOWN_ORDER")
            .when(closed, "CLOSED")
            .when(unpriced, "NO_PRICE")
            .otherwise(ACCEPTED),
        )
        .withColumn("fill_price", F.when(
            (kind == "EXECUTE") & (F.col("verdict") == ACCEPTED),
            F.coalesce("market_price", "price_before"),
        ))
        .withColumn("fill_slippage_bps", F.when(
            (kind == "EXECUTE") & (F.col("verdict") == ACCEPTED),
            F.when(F.col("arrival_price") > 0,
                   F.round(bps_from(F.col("fill_price"), F.col("arrival_price")), 2)).otherwise(0.0),
        ))
        .select(
            *TABLES["actions"].columns, "seq", "verdict", "status_before",
            F.when(kind == "ADJUST_SIZE", F.col("qty_before")).alias("qty_before"),
            F.when(kind.isin("ADJUST_PRICE", "EXECUTE"), F.col("price_before")).alias("price_before"),
            F.when(kind == "HEDGE", F.col("hedge_before")).alias("hedge_before"),
            F.when(kind == "EXECUTE", F.col("filled0")).alias("filled_before"),
            "fill_price", "fill_slippage_bps",
        )
    )


def _accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == ACCEPTED)


def orders_after(live_orders: DataFrame, judged: DataFrame) -> DataFrame:
    """The live orders after the accepted actions."""
    kind, seq = F.col("action_type"), F.col("seq")

    def latest(value: str, action: str):
        return F.max_by(value, F.when(kind == action, seq))

    changes = _accepted(judged).groupBy("order_id").agg(
        latest("qty", "ADJUST_SIZE").alias("new_qty"),
        latest("price_limit", "ADJUST_PRICE").alias("new_price"),
        latest("action_id", "HEDGE").cast("string").alias("new_hedge"),
        F.max(kind == "CANCEL").alias("cancelled"),
        F.max(kind == "EXECUTE").alias("executed"),
        F.max("fill_price").alias("fill_price"),
        F.max("fill_slippage_bps").alias("fill_slippage_bps"),
        F.max("ts").alias("touched"),
    )
    executed = F.coalesce(F.col("executed"), F.lit(False))
    qty = F.coalesce("new_qty", "qty")
    price = F.coalesce("new_price", "price_limit")
    resized = F.col("new_qty").isNotNull() | F.col("new_price").isNotNull()
    return (
        live_orders.join(changes, "order_id", "left")
        .withColumns({
            "qty": qty,
            "price_limit": price,
            "notional_value": F.when(
                resized, F.coalesce(qty, F.lit(0)) * F.coalesce(price, F.lit(0.0))
            ).otherwise(F.col("notional_value")),
            "status": F.when(executed, "FILLED").when(F.col("cancelled"), "CANCELLED")
            .otherwise(F.col("status")),
            "filled_qty": F.when(executed, qty.cast("long")).otherwise(F.col("filled_qty")),
            "avg_fill_price": F.when(executed, F.col("fill_price")).otherwise(F.col("avg_fill_price")),
            "avg_slippage_bps": F.when(executed, F.col("fill_slippage_bps"))
            .otherwise(F.col("avg_slippage_bps")),
            "fill_rate": F.when(executed, 1.0).otherwise(F.col("fill_rate")),
            "assigned_hedge_id": F.coalesce("new_hedge", "assigned_hedge_id"),
            "last_updated": F.coalesce("touched", "last_updated"),
        })
        .select(*TABLES["live_orders"].columns)
    )


def audit_rows(judged: DataFrame) -> DataFrame:
    """One row per accepted action with the changed fields before and after, as JSON."""
    kind = F.col("action_type")
    old, new = F.lit(None).cast("string"), F.lit(None).cast("string")
    fields = {
        "CANCEL": (
            [F.col("status_before").alias("status")],
            [F.lit("CANCELLED").alias("status")],
        ),
        "EXECUTE": (
            [F.col("status_before").alias("status"), F.col("filled_before").alias("filled_qty")],
            [F.lit("FILLED").alias("status"), F.col("fill_price"),
             F.col("fill_slippage_bps").alias("slippage_bps")],
        ),
        "ADJUST_SIZE": ([F.col("qty_before").alias("qty")], [F.col("qty")]),
        "ADJUST_PRICE": (
            [F.nullif(F.col("price_before"), F.lit(0.0)).alias("price_limit")],
            [F.col("price_limit")],
        ),
        "HEDGE": (
            [F.col("hedge_before").alias("assigned_hedge_id")],
            [F.col("action_id").alias("hedge_id"), F.col("instrument_id"), F.col("qty")],
        ),
    }
    for action, (was, becomes) in fields.items():
        old = F.when(kind == action, json_object(*was)).otherwise(old)
        new = F.when(kind == action, json_object(*becomes)).otherwise(new)
    return _accepted(judged).select(
        "action_id", "order_id", "action_type", old.alias("old_value"), new.alias("new_value"),
        "trader_id", "ts",
    )


def rejected_rows(judged: DataFrame) -> DataFrame:
    codes = F.create_map(*[F.lit(x) for pair in REJECTIONS.items() for x in pair])
    return judged.where(F.col("verdict") != ACCEPTED).select(
        "action_id", "order_id", "action_type", F.col("verdict").alias("reason"),
        codes[F.col("verdict")].alias("code"), "trader_id", "ts",
    )


def hedge_request_rows(judged: DataFrame) -> DataFrame:
    """A pending request per accepted hedge; it is known by the id of its action."""
    return _accepted(judged).where(F.col("action_type") == "HEDGE").select(
        F.col("action_id").alias("hedge_id"), F.col("order_id").alias("parent_order_id"),
        "instrument_id", "direction", "qty", "hedge_type",
        F.lit("PENDING").alias("status"), F.col("ts").alias("created_at"),
    )


def order_state(live_orders: DataFrame, judged: DataFrame) -> OrderState:
    return OrderState(
        orders_after(live_orders, judged),
        audit_rows(judged),
        rejected_rows(judged),
        hedge_request_rows(judged),
    )


def apply_order_actions(
    live_orders: DataFrame,
    actions: DataFrame,
    snapshot: DataFrame,
) -> OrderState:
    """Live orders, audit, rejections and hedge requests after a batch of actions.

    All four come from the same verdicts. Store `judge_actions` first and pass it to
    `order_state` where all four are written.
    """
    return order_state(live_orders, judge_actions(live_orders, actions, snapshot))


def audit_trail(audit: DataFrame, orders: DataFrame) -> DataFrame:
    """The audit rows of the given orders in the order of events."""
    wanted = orders.select("order_id").distinct()
    return audit.join(wanted, "order_id", "left_semi").orderBy("order_id", "ts", "action_id")


def audit_of_order(audit: DataFrame, order_id: str) -> DataFrame:
    """The audit rows of one order; of a table stored by order_id one bucket is read."""
    return audit.where(F.col("order_id") == order_id).orderBy("ts", "action_id")


def adjustment_preview(live_orders: DataFrame, actions: DataFrame) -> DataFrame:
    """What each size or price change would do to notional and size; nothing is applied."""
    current = live_orders.select(
        "order_id", F.col("qty").alias("current_qty"), F.col("price_limit").alias("current_price")
    )
    is_size = F.col("action_type") == "ADJUST_SIZE"
    by_size = F.when(F.col("qty") > 0, F.col("qty") * F.coalesce("current_price", F.lit(0.0)))
    by_price = F.when(
        F.col("price_limit") > 0, F.coalesce("current_qty", F.lit(0)) * F.col("price_limit")
    )
    change = (F.col("qty") - F.coalesce("current_qty", F.lit(0))) / or_default("current_qty", 1) * 100
    return (
        actions.where(F.col("action_type").isin("ADJUST_SIZE", "ADJUST_PRICE"))
        .join(current, "order_id")
        .select(
            "action_id", "order_id", "action_type",
            F.when(is_size, by_size).otherwise(by_price).alias("new_notional"),
            F.when(is_size & (F.col("qty") > 0), F.round(change, 1)).alias("qty_change_pct"),
        )
    )
