"""Operators on small hand-made frames: ties, gaps, duplicates, missing values, hot keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators import aggregates as agg, filters as flt, joins, payments, ranking, reshape


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


# -- filters ----------------------------------------------------------------------------------


def test_blank_parameters_do_not_filter(spark):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    assert flt.when_set(df, "x", " ").count() == 2
    assert flt.in_list(df, "x", ",").count() == 2
    assert flt.in_list(df, "x", "b, z").count() == 1


def test_long_list_becomes_a_join_with_the_same_result(spark, monkeypatch):
    df = spark.range(100).select(F.col("id").cast("string").alias("x"))
    values = [str(i) for i in range(0, 100, 3)]
    expected = rows(flt.in_list(df, "x", values))
    monkeypatch.setattr(flt, "INLINE_LIST_LIMIT", 5)
    assert rows(flt.in_list(df, "x", values)) == expected


def test_numbers_in_lists_compare_as_numbers(spark, monkeypatch):
    df = spark.range(100).select("id")
    for limit in (1000, 1):
        monkeypatch.setattr(flt, "INLINE_LIST_LIMIT", limit)
        assert rows(flt.in_list(df, "id", "007, abc,3, +12")) == [(12,), (3,), (7,)]
        assert flt.in_list(df, "id", "abc").count() == 0


def test_member_zero_is_known(spark):
    assert rows(flt.known_members(spark.createDataFrame([(-1,), (0,), (4,), (None,)], "k int"), "k")) == [(0,), (4,)]


def test_store_matching_on_two_levels_appears_once(spark):
    stores = spark.createDataFrame([(1, "10", "N", "1"), (2, None, "S", "2"), (3, "30", None, "3")], "store_idx int, a string, b string, store_id string")
    assert rows(flt.store_group(stores, "10,N,3", ["a", "b", "store_id"]).select("store_idx")) == [(1,), (3,)]
    assert flt.store_group(stores, "", ["a"]).count() == 0


def test_direction_extra_takes_blank_and_missing(spark):
    df = spark.createDataFrame([("D",), ("A",), ("",), (" ",), (None,)], "origin_code string")
    assert [flt.in_direction(df, t).count() for t in range(4)] == [5, 1, 1, 3]
    with pytest.raises(ValueError):
        flt.in_direction(df, 7)


def test_ranges_parenthesised_and_null_friendly(spark):
    df = spark.createDataFrame([("A",), ("C",), ("Z",), (None,)], "b string")
    assert rows(flt.value_between(df, "b", "B", "M")) == [("C",), (None,)]
    assert rows(flt.value_between(df, "b", "B", "M", keep_null=False)) == [("C",)]


def test_exclude_keeps_rows_without_group(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "g string")
    assert rows(flt.exclude(df, "g", ["a"])) == [("b",), (None,)]


def test_moments_across_month_end(spark):
    df = spark.createDataFrame([(20240131, 2359), (20240201, 0), (20240201, 1201), (20240131, 1159)], "d int, t int")
    assert rows(flt.between_moments(df, "d", "t", (20240131, 1200), (20240201, 1200))) == [(20240131, 2359), (20240201, 0)]


def test_leaf_and_upper_level(spark):
    df = spark.createDataFrame([(1, "a", None, None), (3, "a", "b", "c"), (0, "a", None, None)], "n int, l1 string, l2 string, l3 string")
    got = rows(df.select("n", flt.leaf_level("n", ("l1", "l2", "l3"), "None"), flt.upper_level("n", "l1", "l2", "Unknown")))
    assert got == [(0, "None", "Unknown"), (1, "a", "a"), (3, "c", "b")]


def test_weekday_mask(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 8)], "d date")
    assert flt.on_weekdays(df, "d", (True,) * 7).count() == 7
    assert rows(flt.on_weekdays(df, "d", (False,) * 6 + (True,))) == [(dt.date(2024, 1, 7),)]


# -- joins ------------------------------------------------------------------------------------


def _brute_next(events):
    out = []
    for key, number, status in events:
        if status == 1:
            later = [n for k, n, s in events if k == key and s == 2 and n > number]
            out.append((key, number, min(later) if later else None))
    return sorted(out)


@pytest.mark.parametrize("piece_size", [1, 3, 10, 1000])
def test_next_event_across_pieces_with_a_hot_key(spark, piece_size):
    rng = random.Random(piece_size)
    events = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(4)}", n, rng.choice([1, 1, 2, 3])) for n in range(120)]
    df = spark.createDataFrame(events, "k string, n bigint, s int").withColumn("v", F.col("n") * 10)
    got = joins.next_event(df, "k", "n", F.col("s") == 1, {"stop": F.col("s") == 2}, "v", piece_size=piece_size)
    found = sorted((r.k, r.n, None if r.stop is None else r.stop // 10) for r in got.collect())
    assert found == _brute_next(events)


def test_either_key_counts_a_double_match_once(spark):
    left = spark.createDataFrame([(1, "g"), (9, "h"), (None, "g")], "item int, grp string")
    right = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h")], "article int, article_group string")
    got = joins.either_key(left, right, ("item", "article"), ("grp", "article_group")).select("item", "article")
    assert rows(got) == [(1, 1), (1, 2), (9, 3), (None, 1), (None, 2)]


def test_difference_keeps_unmatched_left(spark):
    a = spark.createDataFrame([("x", 5), ("y", 3)], "k string, q int")
    b = spark.createDataFrame([("x", 2), ("z", 9)], "k string, q int")
    assert rows(joins.difference(a, b, ["k"], ["q"])) == [("x", 3), ("y", 3)]


def test_single_row_without_data(spark):
    empty = spark.createDataFrame([], "x int").agg(F.max("x").alias("m"), F.count("*").alias("n"))
    got = joins.single_row({"e": empty}, empty).select("e.m", "e.n")
    assert rows(got) == [(None, 0)]


def test_latest_before_breaks_ties_by_order(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 1, "y"), ("a", 2, 7, "z"), ("b", 1, 1, None)], "k string, d int, n int, v string")
    assert rows(joins.latest_before(df, ["k"], ["d", "n"], ["v"])) == [("a", "z"), ("b", None)]


def test_full_chain_merges_keys(spark):
    frames = [spark.createDataFrame([(k, i)], f"k string, v{i} int") for i, k in enumerate("aba")]
    assert rows(joins.full_chain(frames, ["k"])) == [("a", 0, None, 2), ("b", None, 1, None)]


def test_fallback_lookup(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "a int, b int")
    one = spark.createDataFrame([(1, "one")], "ka int, v string")
    two = spark.createDataFrame([(10, "ten"), (20, "twenty")], "kb int, v string")
    got = joins.first_match(df, (one, "a", "ka"), (two, "b", "kb"), "v", "name").select("a", "name")
    assert rows(got) == [(1, "one"), (2, "twenty"), (3, None)]


def test_semi_and_anti_make_the_whole(spark):
    a = spark.createDataFrame([(i % 5, i) for i in range(20)], "k int, v int")
    b = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    both = a.join(b, "k", "left_semi").unionByName(a.join(b, "k", "left_anti"))
    assert rows(both) == rows(a)


# -- aggregates -------------------------------------------------------------------------------


def test_subtotal_is_not_confused_with_a_missing_value(spark):
    df = spark.createDataFrame([("o", "p", 1), ("o", None, 2), ("q", None, 4)], "o string, p string, s int")
    got = agg.subtotals(df, "o", "p", [F.sum("s").alias("s")])
    assert rows(got) == [("o", "Total", 3), ("o", "p", 1), ("o", None, 2), ("q", "Total", 4), ("q", None, 4)]


def test_grand_total_equals_the_parts(spark):
    df = spark.createDataFrame([(str(i % 4), i) for i in range(40)], "g string, v int")
    got = {r.g: r.v for r in agg.with_grand_total(df, ["g"], [F.sum("v").alias("v")]).collect()}
    assert got.pop("Total") == sum(got.values()) == sum(range(40))


def test_attributes_with_repeated_and_absent_keys(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "c", "z")], "id int, k string, v string")
    assert rows(agg.attributes_wide(df, ["id"], "k", "v", ["a", "b"])) == [(1, "y", None), (2, None, None)]


def test_latest_rows_of_two_counts(spark):
    df = spark.createDataFrame([("t", 1, 10), ("t", 3, 30), ("t", 2, 20), ("u", 1, None)], "k string, n int, v int")
    assert rows(agg.latest_rows(df, ["k"], ["n"], ["n", "v"])) == [("t", 3, 30), ("u", 1, None)]


def test_conditional_sums_empty_and_null(spark):
    df = spark.createDataFrame([("a", 1, 5)], "k string, t int, v int")
    got = df.groupBy("k").agg(*agg.conditional_sums({"x": F.col("t") == 2}, "v"), *agg.conditional_sums({"y": F.col("t") == 2}, "v", None))
    assert rows(got) == [("a", 0, None)]


def test_distinct_text_is_sorted(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b")], "k string, v string")
    assert rows(df.groupBy("k").agg(agg.distinct_text("v"))) == [("k", "a, b")]


# -- ranking ----------------------------------------------------------------------------------


def test_ties_and_missing_measures(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", None), ("d", 1)], "k string, net_sales int")
    assert [r.k for r in ranking.top_by_name(df, "TopNetSales", 2, ["k"]).collect()] == ["a", "b"]
    assert [r.k for r in ranking.top_by_name(df, "LowNetSales", 4, ["k"]).collect()] == ["d", "a", "b", "c"]
    with pytest.raises(ValueError):
        ranking.top_by_name(df, "Best", 1, ["k"])


# -- reshape ----------------------------------------------------------------------------------


def test_distinct_union_collapses_identical_rows(spark):
    a = spark.createDataFrame([(1, 2), (1, 2)], "x int, y int")
    assert rows(reshape.union_distinct(a, a)) == [(1, 2)]
    assert reshape.union_rows(a, a).count() == 4


def test_ledger_balances(spark):
    df = spark.createDataFrame([(1, 5, 3, 2), (2, None, 4, -4)], "k int, total int, cash int, card int")
    lines = reshape.ledger_lines(df, ["k"], {"Sales": "total"}, {"Cash": "cash", "Card": "card"})
    sums = rows(lines.groupBy("k").agg(F.sum("debit_amount") - F.sum("credit_amount")))
    assert [(k, float(v)) for k, v in sums] == [(1, 0.0), (2, 0.0)]
    assert lines.count() == 6


def test_missing_categories_are_added_once(spark):
    df = spark.createDataFrame([("a", "Single", 1), ("a", "Single", 2), ("b", "Single", 3), ("b", "MixMatch", 4)], "k string, c string, v int")
    got = reshape.fill_categories(df, ["k"], "c", ["Single", "MixMatch"])
    assert rows(got.filter(F.col("v").isNull())) == [("a", "MixMatch", None)]
    assert got.count() == 5


def test_padded_union(spark):
    a = spark.createDataFrame([(1, 2)], "k int, x int")
    b = spark.createDataFrame([(1, 5), (2, 7)], "k int, y int")
    got = [(k, float(x), float(y)) for k, x, y in rows(reshape.padded_union_sum([a, b], ["k"], ["x", "y"]))]
    assert got == [(1, 2.0, 5.0), (2, 0.0, 7.0)]


def test_periods_share_no_receipt(spark):
    at = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    facts = spark.createDataFrame([(1, at(1, 9), 1), (1, at(1, 12), 2), (1, at(2, 0), 3), (1, at(4, 23, 59), 4), (1, at(5, 8), 5), (2, at(1, 12), 6), (1, None, 7)], "store int, at timestamp, n int")
    spans = [(1, at(1, 9), at(1, 12), "a"), (1, at(1, 12), at(2, 0), "b"), (1, at(2, 0), at(5, 8), "c"), (1, at(5, 8), at(5, 8), "empty"), (1, at(6, 0), at(5, 0), "back"), (2, at(1, 0), at(1, 13), "d"), (2, at(1, 12), at(1, 14), "e"), (2, None, at(3, 0), "x")]
    periods = spark.createDataFrame(spans, "store int, s timestamp, e timestamp, name string")
    got = joins.in_periods(facts, periods, ["store"], "at", "s", "e")
    assert sorted((r.n, r.name) for r in got.collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "c"), (6, "d"), (6, "e")]
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()


def test_ancestors_of_any_depth(spark):
    chain = [(f"n{k}", f"n{k + 1}") for k in range(13)]
    links = spark.createDataFrame([*chain, *chain, ("x", "n3"), ("x", "n9"), ("n13", "n13"), ("c1", "c2"), ("c2", "c1"), (None, "n1"), ("lone", None)], "node string, parent string")
    got = {(r.node, r.ancestor): r.steps for r in joins.ancestors(links).collect()}
    assert {a: s for (n, a), s in got.items() if n == "n2"} == {f"n{k}": k - 2 for k in range(2, 14)}
    assert {a: s for (n, a), s in got.items() if n == "x"} == {"x": 0, **{f"n{k}": k - 2 for k in range(3, 9)}, **{f"n{k}": k - 8 for k in range(9, 14)}}
    assert {a: s for (n, a), s in got.items() if n == "c1"} == {"c1": 0, "c2": 1}
    assert not any(n in ("lone", None) for n, _ in got)


def test_lists_hold_every_bigint(spark):
    df = spark.createDataFrame([(9223372036854775807,), (-9223372036854775808,), (7,)], "k bigint")
    got = flt.in_list(df, "k", "9223372036854775807, -9223372036854775808, 9223372036854775808, 0000000000000000000000007")
    assert sorted(r.k for r in got.collect()) == [-9223372036854775808, 7, 9223372036854775807]


# -- payments ---------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "line,expected",
    [
        (("Tender", "Cash", "Finished", 10, False, None, None), (1, 20101, 10)),
        (("TenderChange", "Cash", "Finished", 10, False, None, None), (1, 21301, -10)),
        (("TenderChange", "Cash", "PostVoided", 10, False, None, None), (1, 21301, 10)),
        (("Tender", "Cash", "Finished", 10, True, 9, None), (8, 20101, -10)),
        (("Tender", "CreditDebit", "Finished", 10, False, None, None), (3, 20303, 10)),
        (("Tender", "StoreAccountOut", "Finished", 10, False, None, None), (11, 20704, -10)),
        (("Tender", "StoreAccount", "Finished", -10, False, None, None), (10, 20705, 10)),
        (("PaidOut", "Other", "Finished", 10, False, None, None), (-4, 21304, 10)),
        (("Tender", "Other", "Finished", 10, False, None, 14), (14, -3, 10)),
        # A tender with a number of its own has the type it is looked up under, or none.
        (("Tender", "Other", "Finished", 10, False, None, 140), (140, None, 10)),
        (("Tender", "Ikano", "Finished", 10, False, None, None), (16, 20206, 10)),
        (("Tender", "Retain24Out", "Finished", 10, False, None, None), (18, -3, 10)),
        (("Tender", "TypiskNorskReturn", "Finished", 10, False, None, None), (21, 20710, 10)),
        (("Tender", "VRExt:CashHandlingSystem", "Finished", 10, False, None, None), (9, -3, 10)),
        (("Info", "Cash", "Finished", 10, False, None, None), (-4, -3, 0)),
        (("Info", "Mobile", "Finished", 10, False, None, None), (22, 20401, 0)),
    ],
)
def test_payment_rules(spark, line, expected):
    shape = "line_type string, tender_type string, status string, amount int, is_refund boolean, foreign_rate int, internal_tender_id int"
    df = spark.createDataFrame([line], shape).withColumns(
        {"host_authorized": F.lit(True), "authorization_method": F.lit("Automatically")}
    )
    assert tuple(payments.classify_payments(df).select("tender_id", "trans_type", "signed_amount").first()) == expected


def test_payment_lookups_and_cash_machine(spark):
    shape = "n int, line_type string, tender_type string, internal_tender_id int, foreign_rate int, foreign_currency string, is_deposit boolean, is_withdrawal boolean, deposit_result string"
    lines = [
        (1, "Tender", "ChainCard", None, None, None, False, False, None), (2, "Tender", "Unheard", None, None, None, None, None, None),
        (3, "Tender", "x", 101, None, None, False, False, None), (4, "Tender", "x", 102, None, None, True, False, "OK"),
        (5, "PaidIn", "Cash", None, None, None, True, False, "ok"), (6, "PaidIn", "Cash", None, None, None, True, False, "FlagError"), (7, "PaidIn", "Cash", None, None, None, True, False, "Error"),
        (8, "PaidOut", "Cash", None, None, None, False, True, "OK"), (9, "PaidOut", "Cash", None, None, None, False, True, "NoCash"),
        (10, "PaidOut", "Cash", None, None, None, False, True, "FlagError"), (11, "PaidOut", "Cash", None, None, None, False, True, "Error"),
        (12, "Tender", "Cash", None, 9, "EUR", False, False, None), (13, "Tender", "Cash", None, 9, "NOK", False, False, None),
    ]
    df = spark.createDataFrame(lines, shape).withColumns({
        "status": F.lit("Finished"), "amount": F.lit(10), "is_refund": F.lit(False), "host_authorized": F.lit(True), "authorization_method": F.lit("Automatically"), "currency": F.lit("NOK"),
    })
    custom = spark.createDataFrame([("ChainCard", 150), ("ChainCard", 151)], "tender_type string, custom_tender_id int")
    own = spark.createDataFrame([(101, 20801)], "internal_tender_id int, own_trans_type int")
    got = {r.n: (r.tender_id, r.trans_type) for r in payments.classify_payments(df, custom, own).collect()}
    assert got == {
        1: (150, -3), 2: (-4, -3), 3: (101, 20801), 4: (102, None), 5: (1, 30111), 6: (1, 30112), 7: (1, 30113), 8: (1, 30110), 9: (1, 30114),
        10: (1, 30115), 11: (1, 30116), 12: (8, 20101), 13: (-4, 20101),
    }
