import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from apiary.functions.baskets import item_entries, parse_items, render_items
from apiary.operators import transactions as txn


def test_flag_edges(spark):
    df = spark.createDataFrame([(4,), (5,), (None,), (0,), (9,)], "init_status int")
    got = [r.status for r in txn.flag(df).collect()]
    assert got == ["REJECTED", "ACCEPTED", None, "REJECTED", "ACCEPTED"]


def test_calendar_split_and_layout(spark):
    df = spark.createDataFrame(
        [("t1", "c1", dt.datetime(2017, 1, 29, 13, 45, 50), 12.5, 7)],
        "txn_id string, cc_no string, txn_time timestamp, amount double, init_status int",
    )
    row = txn.to_transactions(txn.flag(df)).first()
    assert (row.year, row.month, row.day, row.hour, row.min) == (2017, 1, 29, 13, 45)
    assert row.date_text == "2017-01-29" and row.status == "ACCEPTED"
    assert row.items is None and row.tags is None


def test_count_min_hour_figures(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 5)
    rows = [
        (t0, "ACCEPTED"),
        (t0 + dt.timedelta(seconds=10), "REJECTED"),
        (t0 + dt.timedelta(minutes=1), "ACCEPTED"),
        (t0 + dt.timedelta(hours=1), "REJECTED"),
    ]
    df = spark.createDataFrame(rows, "txn_time timestamp, status string")
    out = {(r.hour, r.minute): r for r in txn.txn_count_min(df).collect()}
    m0 = out[(10, 0)]
    assert (m0.ttl_txn_min, m0.approved_txn_min, m0.approved_rate_min) == (2, 1, 0.5)
    assert (m0.ttl_txn_hr, m0.approved_txn_hr) == (3, 2)
    assert m0.approved_rate_hr == pytest.approx(2 / 3)
    assert out[(11, 0)].approved_rate_hr == 0.0


def test_basket_text_roundtrip(spark):
    df = spark.createDataFrame([("Item_2->3.50,Item_10->1.25,Item_2->1.00",)], "s string")
    entries = df.select(F.explode(item_entries("s")).alias("e")).select("e.*").collect()
    assert [(e.item, e.price) for e in entries] == [("Item_2", 3.5), ("Item_10", 1.25), ("Item_2", 1.0)]
    ok = spark.createDataFrame([("Item_2->3.50,Item_10->1.25",)], "s string")
    row = ok.select(render_items(parse_items("s")).alias("r")).first()
    assert row.r == "Item_10->1.25,Item_2->3.50"


def test_baskets_sum_repeats(spark):
    lines = spark.createDataFrame(
        [(1, 7, 1.10), (1, 7, 2.20), (1, 8, 0.005), (2, 7, 5.0)], "o long, p long, price double"
    )
    b = txn.baskets(lines, "o", "p", "price")
    totals = {r.o: (r.total, r.total_text) for r in txn.basket_totals(b, "o").collect()}
    assert totals[1] == (3.31, "3.31")
    assert totals[2] == (5.0, "5.00")
    text = {r.o: r.items_text for r in txn.basket_text(b, "o").collect()}
    assert text[1] == "Item_7->3.30,Item_8->0.01"


def test_dirty_price_is_null_not_an_error(spark):
    df = spark.createDataFrame([("Item_1->abc,Item_2->2.00",)], "s string")
    entries = df.select(F.explode(item_entries("s")).alias("e")).select("e.*").collect()
    assert [(e.item, e.price) for e in entries] == [("Item_1", None), ("Item_2", 2.0)]


def test_bad_messages_are_quarantined_and_all_columns_stored(spark):
    from apiary.session import work_path
    from apiary.streaming import transactions as st

    good = '{"txn_id": "t", "cc_no": "4", "cc_provider": "p", "country": "c", "notes": "n", "tags": ["a", "b", "a"], "init_status": 7, "txn_time": "2024-01-01 10:00:00.000"}'
    bad = {"{": "malformed", '{"txn_id": "u", "amount": "x"}': "malformed", '{"cc_no": "1"}': "missing_field", None: "malformed"}
    for part in ("cc_no", "txn_time", "txn_id"):
        bad[json.dumps({k: v for k, v in json.loads(good).items() if k != part})] = "missing_field"
    msgs = spark.createDataFrame([(v,) for v in [good, *bad]], "value string")
    paths = st.TxnPaths(work_path(spark, "q-txn"), work_path(spark, "q-lines"), work_path(spark, "q-ck"), work_path(spark, "q-bad"))
    seen = []
    st.txn_batch(msgs, 0, paths, lambda *n: seen.append(n))
    assert seen == [(0, 8, 1)]
    row = st.read_transactions(spark, paths.table).collect()
    assert [(r.txn_id, r.cc_provider, r.country, r.notes, r.tags) for r in row] == [("t", "p", "c", "n", ["a", "b"])]
    assert {r.value: r.reason for r in st.read_txn_quarantine(spark, paths.quarantine).collect()} == bad
    for value in bad:
        with pytest.raises(Exception):
            txn.parse_transactions(spark.createDataFrame([(value,)], "value string"), strict=True).collect()
