"""Basket text of a transaction: ``Item_<id>-><price>,Item_<id>-><price>``.

The ``items`` column is a ``MAP<STRING, DOUBLE>``. Rendering, parsing and the
total are higher-order built-in functions, evaluated per row inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and price format of the basket text (fixed values).
ITEM_SEPARATOR = ","
PRICE_SEPARATOR = "->"
PRICE_FORMAT = "%1.2f"
ITEM_PREFIX = "Item_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_items(items: Column | str, sort: bool = True) -> Column:
    """Map of item → price as basket text; entries sorted by item name."""
    entries = F.map_entries(_col(items))
    if sort:
        entries = F.array_sort(entries)
    return F.array_join(
        F.transform(
            entries,
            lambda e: F.concat(
                e["key"], F.lit(PRICE_SEPARATOR), F.format_string(PRICE_FORMAT, e["value"])
            ),
        ),
        ITEM_SEPARATOR,
    )


def item_entries(text: Column | str) -> Column:
    """Basket text → array of (item, price) structs, repeats kept.

    An item may occur more than once in a basket, which a map cannot hold;
    explode this array and sum per item where a map is wanted.
    """
    parts = F.split(_col(text), ITEM_SEPARATOR)
    return F.transform(
        F.filter(parts, lambda p: F.length(p) > 0),
        lambda p: F.struct(
            F.substring_index(p, PRICE_SEPARATOR, 1).alias("item"),
            # try_cast: a price that is no number gives null, not a failed job
            # (ANSI mode is on by default).
            F.substring_index(p, PRICE_SEPARATOR, -1).try_cast("double").alias("price"),
        ),
    )


def parse_items(text: Column | str) -> Column:
    """Basket text → ``MAP<STRING, DOUBLE>``; item names must not repeat."""
    return F.map_from_entries(item_entries(text))


def items_total(items: Column | str, scale: int | None = 2) -> Column:
    """Sum of the prices of a basket map, rounded to ``scale`` decimals at the end.

    The prices are added in ascending order, so the total does not depend on
    the order of the map entries; null prices are left out.
    """
    prices = F.array_sort(F.filter(F.map_values(_col(items)), lambda v: v.isNotNull()))
    total = F.aggregate(prices, F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    return total if scale is None else F.round(total, scale)


def format_total(total: Column | str) -> Column:
    return F.format_string(PRICE_FORMAT, _col(total))
