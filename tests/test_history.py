import datetime as dt

import pytest
from conftest import collect
from pyspark.sql import functions as F

from tapeloom.operators import trades as t
from tapeloom.operators.quality import check_checkpoint, check_cursor, check_history_arguments
from tapeloom.plans.history_load import load_history, page_trades, resolve_start
from tapeloom.sinks import history
from tapeloom.sources.trade_pages import bad_rows, good_rows, is_rate_limit_page, page_rows, read_pages

ROW = '[4711,%d,"-0.0048","731.5"]'
DAY_ONE, DAY_TWO = 1740852000000, 1740938400000


def pages(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "page string")


def trade_row(identity, mts, amount="1.50", price="100.0"):
    return f'[{identity},{mts},"{amount}","{price}"]'


def page(*rows):
    return "[" + ",".join(rows) + "]"


def test_trade_row_without_float_conversion(spark):
    [row] = collect(t.stored_form(page_trades(pages(spark, page(ROW % 1740808801375)), "tSOLEUR")))
    assert row == {
        "exchange": "bitfinex", "symbol": "tSOLEUR", "id": 4711, "mts": 1740808801375,
        "timestamp": "2025-03-01T06:00:01.375Z", "side": "sell", "amount": "-0.0048",
        "amount_abs": "0.0048", "price": "731.5",
    }


def test_numbers_strings_extra_fields_and_zero(spark):
    text = '[[1,2,0,1.10,"x"],["2","3","0.000",5e-7],[3,4,1e2,"12345678901234567890.123456789012345678"]]'
    rows = collect(t.stored_form(page_trades(pages(spark, text), "tX").orderBy("id")))
    assert [(r["side"], r["amount"], r["price"]) for r in rows] == [
        ("buy", "0", "1.1"),
        ("buy", "0", "0.0000005"),
        ("buy", "100", "12345678901234567890.123456789012345678"),
    ]


@pytest.mark.parametrize(
    "text, problem",
    [
        ("[[1,2,3]]", "fewer than 4 fields"),
        ("[5]", "not an array"),
        ('["[1,2,3,4]x"]', "not an array"),
        ("{}", "not an array"),
        ("hello", "not an array"),
        ("[[1.0,2,3,4]]", "ID is not an integer"),
        ("[[1,true,3,4]]", "MTS is not an integer"),
        ("[[1,2,null,4]]", "AMOUNT is not a decimal"),
        ("[[1,2,3,[4]]]", "PRICE is not a decimal"),
        ('{"error":"ERR_RATE_LIMIT"}', "rate limited page"),
    ],
)
def test_bad_rows_fail_or_are_quarantined(spark, text, problem):
    rows = page_rows(pages(spark, text, page(ROW % 5)))
    assert [r["problem"] for r in bad_rows(rows).collect()] == [problem]
    assert good_rows(rows, "skip").count() == 1
    with pytest.raises(Exception, match=problem):
        good_rows(rows).collect()


def test_empty_page_has_no_rows(spark):
    assert page_rows(pages(spark, "[]")).count() == 0


def test_rate_limit_body(spark):
    df = pages(spark, '{"error":"ERR_RATE_LIMIT"}', "[]", '{"error":"other"}', "x", '{"error":5}')
    assert [r[0] for r in df.select(is_rate_limit_page(F.col("page"))).collect()] == [True] + [False] * 4


def test_time_range_is_inclusive_and_checked(spark):
    trades = page_trades(pages(spark, page(*[trade_row(i, i) for i in range(1, 6)])), "tX")
    assert {r["id"] for r in t.in_time_range(trades, 2, 4).collect()} == {2, 3, 4}
    assert t.in_time_range(trades, 9).count() == 0
    with pytest.raises(ValueError):
        t.in_time_range(trades, 5, 4)


def test_order_limit_and_recent_page(spark):
    rows = [trade_row(3, 7), trade_row(1, 7), trade_row(2, 5), trade_row(9, 9)]
    trades = page_trades(pages(spark, page(*rows)), "tX")
    assert [r["id"] for r in t.sorted_trades(trades).collect()] == [2, 1, 3, 9]
    for top_k in (100, 1):
        assert {r["id"] for r in t.first_trades(trades, 3, top_k_rows=top_k).collect()} == {2, 1, 3}
    assert [r["id"] for r in t.recent_page(trades, 2).collect()] == [3, 9]
    assert [r["id"] for r in t.recent_page(trades, 3, end=8, max_trades=2).collect()] == [2, 1]
    for bad in (0, 10_001):
        with pytest.raises(ValueError):
            t.recent_page(trades, bad)
    with pytest.raises(ValueError):
        t.first_trades(trades, 0)


def test_daily_files_and_checkpoint(spark, tmp_path):
    root = str(tmp_path)
    landed = pages(spark, page(ROW % DAY_ONE), page((ROW % DAY_TWO).replace("4711", "4712")))
    summary = load_history(spark, landed, root, start=DAY_ONE)
    assert summary.rows == 2
    stored = history.read_history(spark, root, "tBTCUSD")
    assert {(r["date"], r["count"]) for r in stored.groupBy("date").count().collect()} == {
        (dt.date(2025, 3, 1), 1),
        (dt.date(2025, 3, 2), 1),
    }
    checkpoint = history.load_checkpoint(spark, root, "tBTCUSD")
    assert checkpoint["symbol_partition"] == "tbtcusd"
    assert checkpoint["last_completed_date"] == "2025-03-01"
    assert checkpoint["last_trade_mts"] == DAY_ONE
    assert checkpoint["next_start_mts"] == DAY_ONE + 1
    assert (tmp_path / "tbtcusd" / "date=2025-03-01").exists()


def test_resume_rewrites_open_days_and_keeps_completed_ones(spark, tmp_path):
    root = str(tmp_path)
    first = pages(spark, page(trade_row(1, DAY_ONE), trade_row(2, DAY_ONE + 5), trade_row(3, DAY_TWO)))
    load_history(spark, first, root, symbol="tX", start=DAY_ONE)
    # Landed later: trade 2 again, a late trade of the completed day, more of the open day.
    later = pages(spark, page(trade_row(2, DAY_ONE + 5), trade_row(4, DAY_ONE + 9), trade_row(3, DAY_TWO)),
                  page(trade_row(3, DAY_TWO), trade_row(5, DAY_TWO + 1)))
    for _ in range(2):
        load_history(spark, later, root, symbol="tX")
        stored = history.read_history(spark, root, "tX")
        assert sorted(r["id"] for r in stored.collect()) == [1, 2, 3, 4, 5]
    assert history.load_checkpoint(spark, root, "tX")["last_completed_date"] == "2025-03-01"
    third = pages(spark, page(trade_row(6, DAY_TWO + 86_400_000)))
    summary = load_history(spark, third, root, symbol="tX")
    assert summary.checkpoint is not None
    assert sorted(r["id"] for r in history.read_history(spark, root, "tX").collect()) == [1, 2, 3, 4, 5, 6]


def test_resume_point_after_end_loads_nothing(spark, tmp_path):
    root = str(tmp_path)
    landed = pages(spark, page(trade_row(1, DAY_ONE), trade_row(2, DAY_TWO)))
    load_history(spark, landed, root, symbol="tX", start=DAY_ONE)
    assert load_history(spark, landed, root, symbol="tX", end=DAY_ONE).rows == 0
    assert load_history(spark, landed, root, symbol="tX", start=DAY_ONE, end=DAY_ONE, ignore_checkpoint=True).rows == 1


def test_recent_page_saves_no_checkpoint(spark, tmp_path):
    root = str(tmp_path)
    landed = pages(spark, page(trade_row(1, DAY_ONE), trade_row(2, DAY_TWO)))
    assert load_history(spark, landed, root, symbol="tX").rows == 2
    assert history.load_checkpoint(spark, root, "tX") is None


def test_max_trades_counts_over_all_pages(spark, tmp_path):
    landed = pages(spark, page(trade_row(5, DAY_TWO), trade_row(1, DAY_ONE)), page(trade_row(2, DAY_ONE + 1)))
    assert load_history(spark, landed, str(tmp_path), symbol="tX", start=0, max_trades=2).rows == 2
    assert {r["id"] for r in history.read_history(spark, str(tmp_path), "tX").collect()} == {1, 2}


def test_resolve_start():
    checkpoint = {"next_start_mts": 500}
    assert resolve_start(None, checkpoint) == 500
    assert resolve_start(499, checkpoint) == 500
    assert resolve_start(501, checkpoint) == 501
    assert resolve_start(3, None) == 3
    assert resolve_start(None, None) is None


def test_checkpoint_checks():
    good = {
        "version": 1, "exchange": "bitfinex", "symbol": "tX", "symbol_partition": "tx", "last_trade_mts": 1,
        "next_start_mts": 2,
    }
    assert check_checkpoint(good, "tX", "tx") is good
    for change in ({"version": 2}, {"exchange": "x"}, {"symbol": "y"}, {"symbol_partition": "y"}, {"next_start_mts": 1}):
        with pytest.raises(ValueError):
            check_checkpoint({**good, **change}, "tX", "tx")
    with pytest.raises(ValueError, match="version is 2, not 1; exchange is 'x'.*next start"):
        check_checkpoint({**good, "version": 2, "exchange": "x", "next_start_mts": 0}, "tX", "tx")
    assert check_cursor(2, 1) == 2
    with pytest.raises(ValueError):
        check_cursor(1, 1)


def test_saved_checkpoint_of_another_symbol_is_refused(spark, tmp_path):
    root = str(tmp_path)
    history.save_checkpoint(spark, root, "tX", dt.date(2026, 6, 14), 5, 1)
    history.save_checkpoint(spark, root, "tX", dt.date(2026, 6, 15), 9, 2)
    assert history.load_checkpoint(spark, root, "tX")["next_start_mts"] == 10
    with pytest.raises(ValueError, match="symbol is 'tX', not 'TX'"):
        history.load_checkpoint(spark, root, "TX")


def test_arguments():
    check_history_arguments("tX", 1, 1, 10_000, None)
    for bad in [("", 1, 2, 5, None), ("t", 2, 1, 5, None), ("t", 1, 2, 0, None), ("t", 1, 2, 10_001, None),
                ("t", 1, 2, 5, 0)]:
        with pytest.raises(ValueError):
            check_history_arguments(*bad)


def test_pages_from_files_and_pushed_range(spark, tmp_path, capsys):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p1.json").write_text(page(trade_row(1, DAY_ONE)) + "\n\n[]\n")
    landed = read_pages(spark, str(tmp_path / "pages"))
    load_history(spark, landed.select("page"), str(tmp_path), symbol="tX", start=0)
    stored = history.read_history(spark, str(tmp_path), "tX")
    assert stored.count() == 1
    t.in_time_range(stored, 5, 9).explain()
    assert "GreaterThanOrEqual(mts,5)" in capsys.readouterr().out
