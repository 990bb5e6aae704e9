"""Value rules on hand-written rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgersync.functions import predicates as P
from ledgersync.functions import scalar as X
from ledgersync.functions.clock import Window, ts, window_for


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


@pytest.mark.parametrize(
    ("number", "masked"),
    [("", None), ("1", "x"), ("123", "xxx"), ("1234", "1234"), ("12345", "x2345"), (None, None), ("123456  ", "xx3456  ")],
)
def test_mask(spark, number, masked):
    assert values(spark, [(number,)], "a string", X.mask_tail("a")) == [masked]


def test_addresses(spark):
    rows = [("1 Main", " ", None, "Fargo", "ND"), (None, None, None, None, None), ("A", "B", "C", None, "MN")]
    got = values(spark, rows, "a string, b string, c string, d string, e string", X.join_address(["a", "b", "c"], "d", "e"))
    assert got == ["1 Main, Fargo, ND", ", ", "A, B, C, , MN"]
    full = values(spark, [("1 Main", None, "Fargo", "ND", "58102")], "a string, b string, c string, d string, e string",
                  X.full_address("a", "b", "c", "d", "e"))
    assert full == ["1 Main, Fargo, ND 58102"]


def test_party_name(spark):
    rows = [("B", " Acme ", None, None, None, None), ("I", "x", " Ann ", " ", "Lee", ""), (None, "x", None, None, None, None)]
    schema = "k string, n string, f string, m string, l string, s string"
    assert values(spark, rows, schema, X.party_name("k", "n", "f", "m", "l", "s")) == ["Acme", "Ann Lee", ""]


def test_composite_key_collides_without_separator(spark):
    rows, schema = [(1, 23, "Co"), (12, 3, "Co")], "a long, b long, r string"
    assert values(spark, rows, schema, X.composite_key("a", "b", X.prefix("r", 1))) == ["123C", "123C"]
    assert len(set(values(spark, rows, schema, X.composite_key("a", "b", X.prefix("r", 1), sep="-")))) == 2


def test_memo_and_address_differ_on_null(spark):
    assert values(spark, [("Lease", None, "n", "t")], "a string, b string, c string, d string", X.memo("a", "b", "c", "d")) == [None]


def test_latest_of_falls_through_on_null(spark):
    rows = [(3, None, 1), (1, 2, None), (5, 4, 3), (1, 4, 3), (2, 2, 2)]
    assert values(spark, rows, "a int, b int, c int", X.latest_of(["a", "b", "c"])) == [1, None, 5, 4, 2]
    assert values(spark, rows[:1], "a int, b int, c int", X.latest_of(["a", "b", "c"], [F.lit("x"), F.lit("y"), F.lit("z")])) == ["z"]


def test_days_past_due(spark):
    day = datetime(2024, 3, 10, 15)
    rows = [(day - timedelta(days=1),), (day,), (day + timedelta(days=1),), (None,)]
    assert values(spark, rows, "d timestamp_ntz", X.days_past_due("d", ts(day))) == [1, 0, 0, None]


def test_rounded_days(spark):
    rows = [(datetime(2024, 1, 2, 11, 59),), (datetime(2024, 1, 2, 12),), (datetime(2023, 12, 30),)]
    assert values(spark, rows, "d timestamp_ntz", X.days_between_rounded("d", ts("2024-01-01"))) == [1, 2, -2]


def test_next_due_date(spark):
    def due(d, now, ended=0):
        return values(spark, [(d, datetime(2020, 1, 1), ended)], "d timestamp_ntz, f timestamp_ntz, t int", X.next_due_date("d", "f", now, "t"))[0]

    assert due(datetime(2024, 5, 1), "2024-03-10") == date(2020, 1, 1)
    assert due(datetime(2024, 1, 20), "2024-03-10") == date(2024, 3, 20)
    assert due(datetime(2024, 1, 5), "2024-03-10") == date(2024, 4, 5)
    assert due(datetime(2023, 12, 20), "2024-03-10") == date(2025, 2, 20)
    assert due(datetime(2024, 1, 10), "2024-03-10") is None
    assert due(datetime(2024, 1, 30), "2024-02-10") is None  # February has no 30th
    assert due(datetime(2024, 1, 5), "2024-03-10", 1) is None


def test_sign_split_and_reclass(spark):
    rows, schema = [(5,), (0,), (-5,)], "n int"
    assert values(spark, rows, schema, X.split_debit("n")) == [5, 0, None]
    assert values(spark, rows, schema, X.split_credit("n")) == [None, None, 5]
    rows = [("42001", 5, 5, None), ("42001", -5, 0, "I"), ("42001", -5, 3, "I"), ("42001", -5, None, "CO"), ("42001", -5, 0, None), ("1", 5, 5, "I")]
    got = values(spark, rows, "a string, n int, d int, r string", X.reclass("a", "n", "d", "r"))
    assert got == ["14000", "42002", "42001", "42002", "42001", "1"]


def test_net_investment(spark):
    rows = [(100, 10, 5, 1, 2, 3), (None, 10, 5, 1, 2, 3), (100, None, None, None, None, None)]
    schema = "a int, b int, c int, d int, e int, f int"
    assert values(spark, rows, schema, X.net_investment(*"abcdef")) == [93, 0, 100]
    assert values(spark, rows, schema, X.net_investment(*"abcdef", at_termination=True)) == [-93, 7, -100]


def test_rate_text(spark):
    assert values(spark, [(Decimal("0.125"),)], "r decimal(18,8)", X.rate_text("r", "%")) == ["12.50000000%"]


def test_month_filter_takes_midnight_bounds(spark):
    rows = [(datetime(2023, 9, 30),), (datetime(2023, 9, 30, 8),), (datetime(2023, 10, 31),), (datetime(2023, 10, 31, 8),)]
    assert values(spark, rows, "d timestamp_ntz", P.in_month("d", "2023-10-31")) == [False, True, True, False]


def test_filters_on_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    assert df.filter(P.in_codes("c", [1])).count() == 1
    assert df.filter(P.in_codes("c", [1], negate=True)).count() == 1
    assert P.exclude(df, F.col("c") == 1).count() == 1
    assert P.require(df, "c").count() == 2


def test_group_predicate(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "a")], "j int, acct string")
    hit = F.col("acct") == "a"
    assert sorted(r[0] for r in df.select(P.row_predicate(hit, "j")).collect()) == [False, False, False, True]
    grouped = {(r.j, r.acct): r.g for r in df.withColumn("g", P.row_predicate(hit, "j", "group")).collect()}
    flagged = {(r.j, r.acct): r.g for r in P.flag_groups(df, hit, "j", "g").collect()}
    assert grouped == flagged == {(1, "a"): True, (1, "b"): True, (2, "b"): False, (None, "a"): False}


def test_window_is_closed(spark):
    w = Window.of("2024-01-01", "2024-01-02")
    rows = [(datetime(2024, 1, 1),), (datetime(2024, 1, 2),), (datetime(2024, 1, 2, 0, 0, 1),), (None,)]
    df = spark.createDataFrame(rows, "d timestamp_ntz")
    assert P.changed_between(df, "d", w).count() == 2 and P.changed_between(df, "d", None).count() == 4
    assert window_for("2024-01-02", "notes") == w
