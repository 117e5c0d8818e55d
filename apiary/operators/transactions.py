"""Card transactions: accept flag, stored calendar split, per-minute rollup.

``txn_count_min`` aggregates transactions per calendar minute (partial +
final aggregate), then adds the figures of the whole calendar hour with a
window over the minute rows of that hour: the window's input is the small
per-minute aggregate (at most 60 rows per hour), never the transactions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apiary.functions.baskets import (
    ITEM_PREFIX,
    format_total,
    items_total,
    render_items,
)
from apiary.functions.transactions import ACCEPTED, calendar_columns, txn_status
from apiary.operators.aggregate import fixed_sum
from apiary.operators.ingest import CORRUPT, MALFORMED, MISSING_FIELD, _json_options, message_columns
from apiary.schemas import MESSAGE_TIMESTAMP_FORMAT, REQUIRED_TXN_FIELDS, TRANSACTION, TXN_COUNT_MIN, TXN_MESSAGE

TRANSACTION_COLUMNS = tuple(f.name for f in TRANSACTION.fields)


def flag(txns: DataFrame, init_status: str = "init_status") -> DataFrame:
    """Add ``status``: REJECTED below 5, ACCEPTED from 5 on."""
    return txns.withColumn("status", txn_status(init_status))


def with_calendar(txns: DataFrame, ts: str = "txn_time") -> DataFrame:
    cols = calendar_columns(ts)
    return txns.select(*[c for c in txns.columns if c not in cols], *[v.alias(k) for k, v in cols.items()])


def to_transactions(txns: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rows in the stored transaction layout (and the columns ``keep``); absent columns are null."""
    out = with_calendar(txns)
    cols = []
    for f in TRANSACTION.fields:
        if f.name in out.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return out.select(*cols, *keep)


def parse_transaction_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    """``messages(value[, key])`` → message fields + ``reason``, null for a good message.

    A message that is not valid JSON or has a wrongly typed field is malformed;
    one without ``txn_id``, ``cc_no`` or ``txn_time`` misses a field: the stored key
    (card, day, instant) holds no nulls. In strict mode either raises instead.
    """
    schema = TXN_MESSAGE
    if not strict:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = messages.select(
        *message_columns(messages),
        F.explode(F.array(F.from_json(F.col("value").cast("string"), schema, _json_options(strict)))).alias("m"),
    ).select("key", "value", "source_pos", "m.*")
    parsed = parsed.withColumn("tags", F.array_distinct("tags"))
    missing = reduce(or_, [F.col(c).isNull() for c in REQUIRED_TXN_FIELDS])
    if strict:
        said = F.concat(F.lit("message misses a required field: "), F.coalesce("value", F.lit("null")))
        checked = F.when(missing, F.raise_error(said)).otherwise(F.col("txn_id"))
        return parsed.withColumn("txn_id", checked.cast("string")).withColumn("reason", F.lit(None).cast("string"))
    reason = F.when(F.col(CORRUPT).isNotNull() | F.col("value").isNull(), F.lit(MALFORMED)).when(
        missing, F.lit(MISSING_FIELD)
    )
    return parsed.withColumn("reason", reason).drop(CORRUPT)


def good_transactions(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Good parsed messages → flagged rows in the stored layout (and the columns ``keep``)."""
    return to_transactions(flag(parsed.where(F.col("reason").isNull())), keep)


def parse_transactions(messages: DataFrame, strict: bool = False) -> DataFrame:
    """JSON transaction messages → flagged rows in the stored layout.

    Bad messages are left out here; the streaming sink stores them with a
    reason. In strict mode the first one raises.
    """
    return good_transactions(parse_transaction_messages(messages, strict))


def minute_counts(txns: DataFrame, status: str = "status", ts: str = "txn_time") -> DataFrame:
    """Total and approved transactions per calendar minute (partial + final)."""
    t = F.col(ts)
    return txns.groupBy(
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"),
        F.minute(t).alias("minute"),
    ).agg(
        F.count("*").cast("int").alias("ttl_txn_min"),
        F.count_if(F.col(status) == ACCEPTED).cast("int").alias("approved_txn_min"),
    )


def with_hour_figures(per_min: DataFrame) -> DataFrame:
    """Add the hour's totals and both approval rates to per-minute rows."""
    hour = Window.partitionBy("year", "month", "day", "hour")
    out = (
        per_min.withColumn("ttl_txn_hr", F.sum("ttl_txn_min").over(hour).cast("int"))
        .withColumn("approved_txn_hr", F.sum("approved_txn_min").over(hour).cast("int"))
        .withColumn("approved_rate_min", F.col("approved_txn_min") / F.col("ttl_txn_min"))
        .withColumn("approved_rate_hr", F.col("approved_txn_hr") / F.col("ttl_txn_hr"))
    )
    return out.select(*[f.name for f in TXN_COUNT_MIN.fields])


def txn_count_min(txns: DataFrame, status: str = "status", ts: str = "txn_time") -> DataFrame:
    """Approved and total counts and approval rates per minute and its hour."""
    return with_hour_figures(minute_counts(txns, status, ts))


def encode_transactions(txns: DataFrame) -> DataFrame:
    """Rows → JSON transaction messages (``value``), message fields only."""
    fields = [f.name for f in TXN_MESSAGE.fields if f.name in txns.columns]
    body = F.to_json(F.struct(*fields), {"timestampFormat": MESSAGE_TIMESTAMP_FORMAT})
    return txns.select(body.alias("value"))


def baskets(lines: DataFrame, basket: str, item: str, price: str) -> DataFrame:
    """(basket, items MAP<item, price>) from one row per item line.

    Lines are first summed per (basket, item), map-side combined, so a
    repeated item becomes one map entry; the map holds one entry per
    distinct item of the basket.
    """
    per_item = lines.groupBy(basket, F.concat(F.lit(ITEM_PREFIX), F.col(item).cast("string")).alias("item")).agg(
        fixed_sum(price).alias("price")
    )
    return per_item.groupBy(basket).agg(
        F.map_from_entries(F.collect_list(F.struct("item", "price"))).alias("items")
    )


def basket_text(baskets_df: DataFrame, basket: str) -> DataFrame:
    return baskets_df.select(basket, render_items("items").alias("items_text"))


def basket_totals(baskets_df: DataFrame, basket: str, scale: int = 2) -> DataFrame:
    total = items_total("items", scale)
    return baskets_df.select(basket, total.alias("total"), format_total(total).alias("total_text"))
