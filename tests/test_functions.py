"""Hand-written rows, one per branch of the vocabulary rules."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quotebridge.functions import assessor as A
from quotebridge.functions import exchange as X
from quotebridge.functions import internal as I
from quotebridge.functions import prices as P
from quotebridge.functions.text import token


def outputs(spark, rows, schema, *columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"row_no int, {schema}")
    got = df.select("row_no", *[c.alias(f"o{k}") for k, c in enumerate(columns)]).collect()
    got = [tuple(r)[1:] for r in sorted(got, key=lambda r: r.row_no)]
    return [g[0] for g in got] if len(columns) == 1 else got


def test_location(spark):
    cases = {
        "NG_PNX_TTF.EOD": "TTF", "NG_PNX_ZEEHUB.DA": "ZEE", "NG_PNX_GASPOOL": "GPL",
        "NG_PNX_PEG NORD.EOD": "PEG", "NG_PNX_ZBH": "ZEE", "NG_PNX_VTP2X": "VTP2X", "NG_PNX": None,
        "NG_PNX_zbh": "ZEE", "NG_PNX_gaspool.x.y": "GPL",
    }
    got = outputs(spark, [(c,) for c in cases], "c string", I.location(I.hub(F.col("c"))))
    assert got == list(cases.values())


def test_period(spark):
    cases = [
        ("PNX EOD", "x", "Day"), ("Heren Fin", "NG_ESGM_TTF_IND_D_MAH", "Month"),
        ("Heren_Fin", "NG_ESGM_TTF_WKD", "Day"), ("Heren Weekend", "x", "Weekend"),
        ("PNX GASYEAR", "x", "Gasyear"), ("PNX Gas Year", "x", "Year"), ("Heren BOW", "x", "Week"),
        ("Month Day", "x", "Month"), ("Powernext Foo", "x", "NA"), ("Heren Fin", "NG_A_B_QAH", "Quarter"),
        ("Heren Fin", "NG_A_B.SAH", "Season"), ("Heren Fin", "NG_A_B-GY", "Gasyear"),
        ("Heren Fin", "NG_A_B+cal", "Year"), ("Heren Fin", "NG_A_B_WDNW", "Week"), ("Monthx", "x", "NA"),
    ]
    texts = I.texts(F.col("p"), F.col("c"))
    got = outputs(
        spark, [c[:2] for c in cases], "p string, c string",
        I.period(texts["pub_words"], texts["curve_words"]),
    )
    assert got == [c[2] for c in cases]


def test_publication(spark):
    esgm = "European Spot Gas Markets"
    cases = [
        ("PNX EOD", "x", ("EEX", "EOD", "Spot")), ("EEX EGSI", "x", ("EEX", "EGSI", "Spot")),
        ("POWERNEXT Month", "x", ("EEX", "Settlement", "Futures")),
        ("Heren Fin", "NG_ESGM_TTF_IND_MONTHCUM", (esgm, "Monthly Cumulative Index", "Spot")),
        ("Heren Fin", "NG_ESGM_TTF_IND_MONTHLY", (esgm, "Monthly Index", "Spot")),
        ("Heren Fin", "NG_ESGM_TTF_IND_D_MAH", (esgm, "Daily Month Ahead Index", "Spot")),
        ("Heren Fin", "NG_ESGM_TTF_IND_DA+WSI", (esgm, "Day Ahead Index and Weekend Spot Index", "Spot")),
        ("Heren Fin", "NG_ESGM_TTF_IND_DA+WI", (esgm, "Day Ahead Index and Weekend Index", "Spot")),
        ("Heren Fin", "NG_ESGM_TTF_IND_XYZ", (esgm, "Non-identified Index", "Spot")),
        ("Heren Fin", "NG_ESGM_TTF_CONT_DA", (esgm, "Continental Price Assessments", "Spot")),
        ("Other", "NG_esgm_TTF", (esgm, "Price Assessments", "Spot")),
        ("Foo", "NG_X_TTF", (None, None, None)),
    ]
    t = I.texts(F.col("p"), F.col("c"))
    args = (t["pub_upper"], t["curve_upper"])
    got = outputs(
        spark, [c[:2] for c in cases], "p string, c string",
        I.publication_name(*args), I.product_name(*args), I.product_type(*args),
    )
    assert got == [c[2] for c in cases]


def test_internal_units(spark):
    ccy = I.currency(F.col("c"))
    got = outputs(
        spark, [("GBP", 0.5, "Therms"), ("EUR", 20.0, "MWh"), ("GBp", 50.0, "therm")],
        "c string, p double, u string",
        ccy, I.price_in_quoted_currency(F.col("p"), ccy), I.unit(F.col("u")),
    )
    assert got == [("GBp", 50.0, "therm"), ("EUR", 20.0, "MWh"), ("GBp", 5000.0, "therm")]


def test_unquoted_curves(spark):
    cases = {"NG_PNX_TTF_BID": True, "NG_X_AVG": True, "NG_ESGM_TTF_WIN21": True, "NG_PNX_TTF.EOD": False}
    got = outputs(spark, [(c,) for c in cases], "c string", I.is_unquoted_curve(F.lower("c")))
    assert got == list(cases.values())


def test_relative_period_prefix(spark):
    cases = {"M01": "Month", "Q02": "Quarter", "S01": "Season", "Y01": "Year", "GY01": "Gasyear",
             "WKD": "Weekend", "D01": "Day", "WDNW": "WDNW"}
    got = outputs(spark, [(c,) for c in cases], "c string", I.period_of_relative(F.col("c")))
    assert got == list(cases.values())


def test_month_ahead_end(spark):
    cases = [
        (date(2021, 1, 31), date(2021, 2, 28)), (date(2020, 1, 10), date(2020, 2, 29)),
        (date(2021, 12, 15), date(2022, 1, 31)),
    ]
    d = F.col("d")
    got = outputs(
        spark, [(c[0],) for c in cases], "d date",
        I.month_ahead_end(F.lit("Daily Month Ahead Index"), d, d),
        I.month_ahead_end(F.lit("Monthly Index"), d, d),
    )
    assert got == [(end, start) for start, end in cases]


def test_spot_rules(spark):
    rel = X.spot_period_rel(F.col("p"))
    got = outputs(
        spark,
        [("EGSI WEEKEND", date(2021, 10, 25)), ("TTF DAY AHEAD", date(2021, 10, 27))],
        "p string, e date",
        X.spot_product(F.col("p")), rel, X.spot_duration(rel), X.last_delivery_day(F.col("e")),
    )
    assert got == [("EGSI", "WKD", "Weekend", date(2021, 10, 24)), ("EOD", "DA01", "Day", date(2021, 10, 26))]


def test_futures_granularity_and_tokens(spark):
    got = outputs(
        spark, [("EEX TTF Natural Gas Month Futures",), ("Futures",)], "p string",
        X.granularity(F.col("p")), token(F.col("p"), " ", 9),
    )
    assert got == [("Month", None), (None, None)]


def test_exchange_and_assessor_units(spark):
    got = outputs(
        spark, [("GBP/thm",), ("p/thm",), ("EUR/MWh",)], "u string",
        X.currency(F.col("u")), X.unit(F.col("u")),
    )
    assert got == [("GBp", "therm"), ("GBp", "therm"), ("EUR", "MWh")]
    assert outputs(spark, [("Euro",), ("Pence Sterling",), ("USD",)], "c string", A.currency(F.col("c"))) == [
        "EUR", "GBp", "USD"]


def test_assessor_periods(spark):
    cases = {
        "Day-Ahead": ("Day", "D01"), "Weekend": ("Weekend", "WKD"), "Month +1": ("Month", "M01"),
        "Month +10": ("Month", "M10"), "Quarter +2": ("Quarter", "Q02"), "Season +1": ("Season", "S01"),
        "Gasyear +1": ("Gasyear", "GY01"), "Year +1": ("Year", "Y01"), "BOM": ("BOM", "M00"),
        "WDNW": ("Week", "WDNW"), "D": ("D", "D"),
    }
    p = F.col("p")
    assert outputs(spark, [(c,) for c in cases], "p string", A.duration(p), A.relative_period(p)) == list(cases.values())


def test_index_ids(spark):
    cases = {
        "u/1/ttf-day-ahead-index": ("Day Ahead Index", "Day", "D01"),
        "u/ttf-weekend-spot-index": ("Weekend Spot Index", "Weekend", "WKD"),
        "u/ttf-monthly-cumulative-index": ("Monthly Cumulative Index", "Month", "M01"),
        "u/nbp-within-day-index": ("Within Day Index", "Day", "D00"),
        "u/ttf-daily-month-ahead-index": ("Daily Month Ahead Index", "Month", "M01"),
        "u/ttf-daily-index": ("Daily Index", None, None),
    }
    w = A.index_words(F.col("i"))
    got = outputs(
        spark, [(c,) for c in cases], "i string", A.index_product(w), A.index_duration(w), A.index_period_rel(w)
    )
    assert got == list(cases.values())


def test_rolled_balance_of_month(spark):
    cases = [
        (date(2021, 10, 28), date(2021, 10, 31), False), (date(2021, 10, 28), date(2021, 11, 30), True),
        (date(2021, 12, 30), date(2022, 1, 31), True),
    ]
    got = outputs(
        spark, [c[:2] for c in cases], "p date, e date",
        A.is_rolled_balance_of_month(F.lit("BOM"), F.col("p"), F.col("e")),
    )
    assert got == [c[2] for c in cases]


def test_match_classes(spark):
    cases = [
        (20.1, 20.1, "True", "Match"), (20.1, 20.1005, "True (rounding diff)", "Match"),
        (20.1, 20.15, "False", "Mismatch"), (None, 20.0, "False", "Match"),
    ]
    a, b = F.col("a"), F.col("b")
    got = outputs(spark, [c[:2] for c in cases], "a float, b float", P.match_class(a, b))
    assert got == [c[2] for c in cases]
    tiny = outputs(spark, [(1.0, 1.0000004)], "a double, b double", P.match_class(a, b))
    assert tiny == ["True"]
    assert outputs(spark, [(20.1, 20.15), (20.1, 20.1)], "a double, b double", P.binary_match_class(a, b)) == [
        "Mismatch", "Match"]


@pytest.mark.parametrize(
    ("text", "value"),
    [("85,5", 85.5), ("20.12345", 20.1234), ("2,00005", 2.0), ("", None), ("abc", None), (None, None)],
)
def test_parse_price(spark, text, value):
    got = outputs(spark, [(text,)], "t string", P.parse_price(F.col("t")))
    assert got == [value]


def test_key_needs_every_part(spark):
    row = ("P", "C", "T", "N", "L", date(2021, 1, 2), "Day", date(2021, 1, 3), "EUR", "MWh")
    schema = (
        "publication_name string, commodity_type string, product_type string, product_name string, location_name string, "
        "pub_date date, period_duration string, end_date date, currency string, unit string"
    )
    rows = [row] + [row[:i] + (None,) + row[i + 1:] for i in range(10)]
    got = outputs(spark, rows, schema, P.price_key())
    assert got == ["P/C/T/N/L/2021-01-02/Day/2021-01-03/EUR/MWh"] + [None] * 10
