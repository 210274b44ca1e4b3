"""Small supplier files written to a fresh folder, read by the file readers."""

from datetime import date, datetime

import pytest

from quotebridge.plans import normalize as N
from quotebridge.sources import assessor_xml, exchange_files, jdbc, landing

SPOT = """# spot results
ST;2021-10-26;2021-10-26T18:05:00Z
SP;TTF;TTF DAY AHEAD;2021-10-27;2021-10-28;85,5;EUR/MWh# note
SP;NBP;NBP WEEKEND;2021-10-30;2021-11-01;;GBP/thm
IL;TTF;EGSI WEEKEND;2021-10-30;2021-11-01;84,12345;EUR/MWh
XX;TTF;other;2021-10-30;2021-11-01;1;EUR/MWh
"""

_FUT = "{code};x;{product};2021-11;2021-11-01;2021-11-30;;;;;;;;;{price};{unit}"
FUTURES = "\n".join(
    [f"# line {i}" for i in range(7)]
    + ["ST;2021-10-26;2021-10-26T18:10:00Z"]
    + [
        _FUT.format(code="PR", product="EEX TTF Natural Gas Month Futures", price="85,5", unit="EUR/MWh"),
        _FUT.format(code="PR", product="EEX OTF TTF Month Futures", price="80", unit="EUR/MWh"),
        _FUT.format(code="PR", product="NR TTF Natural Gas Month Futures", price="81", unit="EUR/MWh"),
        _FUT.format(code="PR", product="EEX TTF Natural Gas Quarter Futures", price="", unit="EUR/MWh"),
        _FUT.format(code="OT", product="EEX TTF Natural Gas Month Futures", price="82", unit="EUR/MWh"),
    ]
) + "\n"


def entry(**tags):
    names = {
        "commodity": "c_series.commodity.name", "ccy": "c_series.currency.name", "unit": "c_series.size-unit.name",
        "hub": "c_series.location.name", "pub": "c_series.publication.name", "order": "c_series-order",
        "timeframe": "c_series.timeframe.name", "method": "c_series.methodology.name",
        "approach": "c_series.quote-approach.name", "kind": "c_series.transaction-type.name",
        "high": "assessment-high", "low": "assessment-low", "start": "start-date", "end": "end-date", "label": "period-label",
    }
    body = "".join(f"<{names.get(k, k)}>{v}</{names.get(k, k)}>" for k, v in tags.items())
    return f"<entry><content type='x'><item>{body}</item></content></entry>"


COMMON = {
    "commodity": "Natural Gas", "updated": "2021-10-26T17:00:00Z", "order": "2021-10-26", "ccy": "Euro", "unit": "MWh",
    "pub": "European Spot Gas Markets", "start": "2021-10-27",
}
ASSESS = {**COMMON, "method": "Price Assessment", "approach": "Assessment", "kind": "Spot", "high": "86", "low": "85"}
ASSESSMENTS = "<feed><returned-count>5</returned-count>" + "".join([
    entry(**ASSESS, mid="85.5", end="2021-10-27", label="DA", timeframe="Day-Ahead", hub="Zeebrugge", id="a/1"),
    entry(**ASSESS, mid="85.7", end="2021-10-27", label="DA", timeframe="Day-Ahead", hub="Zeebrugge", id="a/2"),
    entry(**ASSESS, mid="85.5", end="2021-10-27", label="DA", timeframe="Day-Ahead", hub="Germany", id="a/3"),
    entry(**ASSESS, mid="85.5", end="2021-11-30", label="BOM", timeframe="BOM", hub="TTF", id="a/4"),
    entry(**ASSESS, mid="84", end="2021-10-31", label="BOM", timeframe="BOM", hub="TTF", id="x &amp; y"),
]) + "</feed>"
INDICES = "<feed><returned-count>2</returned-count>" + "".join([
    entry(**COMMON, mid="85.6", end="2021-10-27", label="DA", hub="TTF", id="i/ttf-day-ahead-index"),
    entry(**COMMON, mid="85.6", end="2021-10-27", label="D", hub="TTF", id="i/ttf-daily-index"),
]) + "</feed>"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "GasSpotMarketResults_TTF_20211026.csv").write_text(SPOT)
    (tmp_path / "GasFutureMarketResults_TTF_20211026.csv").write_text(FUTURES)
    (tmp_path / "quotes_assessments.xml").write_text(ASSESSMENTS)
    (tmp_path / "quotes_indices.xml").write_text(INDICES)
    return str(tmp_path)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_line_ends(spark, tmp_path, end):
    (tmp_path / "GasSpotMarketResults_TTF_1.csv").write_bytes(SPOT.replace("\n", end).encode())
    (tmp_path / "GasFutureMarketResults_TTF_1.csv").write_bytes(FUTURES.replace("\n", end).encode())
    assert exchange_files.read_exchange_spot(spark, str(tmp_path)).count() == 3
    assert exchange_files.read_exchange_futures(spark, str(tmp_path)).count() == 5


def test_small_splits_surplus_columns_and_missing_header(spark, tmp_path):
    (tmp_path / "GasSpotMarketResults_A_1.csv").write_text(SPOT + "SP;PEG;x;2021-10-27;2021-10-28;1;EUR/MWh;more;and more\n")
    (tmp_path / "GasSpotMarketResults_B_1.csv").write_text("# no result line\nXX;1\n")
    (tmp_path / "GasFutureMarketResults_A_1.csv").write_text(FUTURES)
    (tmp_path / "GasFutureMarketResults_B_1.csv").write_text("# one\n# two\n")
    (tmp_path / "other.csv").write_text(SPOT)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400b")
    try:
        spot = exchange_files.read_exchange_spot(spark, str(tmp_path)).collect()
        assert sorted(r.location_name for r in spot) == ["NBP", "PEG", "TTF", "TTF"]
        assert {r.pub_date for r in spot} == {"2021-10-26"}
        assert exchange_files.read_exchange_futures(spark, str(tmp_path)).count() == 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_spot_file(spark, folder):
    df = exchange_files.read_exchange_spot(spark, folder)
    rows = sorted(df.collect(), key=lambda r: r.product_name)
    assert [(r.idx_code, r.product_name, r.price_mid, r.price_unit.strip()) for r in rows] == [
        ("IL", "EGSI WEEKEND", "84,12345", "EUR/MWh"), ("SP", "NBP WEEKEND", None, "GBP/thm"),
        ("SP", "TTF DAY AHEAD", "85,5", "EUR/MWh"),
    ]
    assert {(r.pub_date, r.src_last_update) for r in rows} == {("2021-10-26", "2021-10-26T18:05:00Z")}


def test_futures_file(spark, folder):
    df = exchange_files.read_exchange_futures(spark, folder)
    assert df.count() == 5
    kept = N.normalize_futures(df).collect()
    assert len(kept) == 1
    row = kept[0]
    assert (row.location_name, row.period_duration, row.price_mid) == ("TTF", "Month", 85.5)
    assert (row.pub_date, row.end_date) == (date(2021, 10, 26), date(2021, 11, 30))


def test_missing_spot_or_futures(spark, folder):
    spot = exchange_files.read_exchange_spot(spark, folder)
    assert N.normalize_exchange(spark, spot, None, "X").count() == 2
    assert N.normalize_exchange(spark, None, None, "X").count() == 0


def test_assessor_documents(spark, folder):
    assessments = assessor_xml.read_assessor(spark, folder, "assessments")
    indices = assessor_xml.read_assessor(spark, folder, "indices")
    assert (assessments.count(), indices.count()) == (5, 2)
    quotes = N.normalize_assessor(assessments, indices, "S").collect()
    got = {(r.location_name, r.product_name, r.period_rel, round(r.price_mid, 4), r.src_price_id) for r in quotes}
    assert got == {
        ("ZEE", "Price Assessments", "D01", 85.5, "a/1"), ("TTF", "Price Assessments", "M00", 84.0, "x & y"),
        ("TTF", "Day Ahead Index", "D01", 85.6, "i/ttf-day-ahead-index"),
    }
    assert {r.src_last_update for r in quotes} == {datetime(2021, 10, 26, 17)}


def test_entry_counts(spark, folder):
    counts = assessor_xml.entry_counts(spark, folder).collect()
    assert sorted((r.announced, r.parsed, r.at_cap) for r in counts) == [(2, 2, False), (5, 5, False)]


def test_landing_layout():
    assert landing.landing_path("/l/", date(2021, 1, 2), "s") == "/l/ingest_date=2021-01-02/source=s"


def test_jdbc_options():
    plain = jdbc.jdbc_options("u", "SELECT 1", {"accessToken": "t", "encrypt": "true"})
    assert plain == {"url": "u", "accessToken": "t", "encrypt": "true", "query": "SELECT 1"}
    sliced = jdbc.jdbc_options("u", "SELECT d", {}, jdbc.DateSlices("d", "2021-01-01", "2021-12-31", 12))
    assert sliced == {
        "url": "u", "dbtable": "(SELECT d) q", "partitionColumn": "d", "lowerBound": "2021-01-01",
        "upperBound": "2021-12-31", "numPartitions": "12",
    }


def test_numbers_days_and_bad_prices(spark):
    from pyspark.sql import functions as F

    from quotebridge.functions.prices import day_of, parse_price

    texts = ["85,5", "NaN", "Infinity", "85d", "n/a", "", None, "-1.5", "+2", "2.00005", "2.00015", "1e2", " 3 ", "1.2.3"]
    got = [r.p for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_price(F.col("t")).alias("p")).collect()]
    assert got == [85.5, None, None, None, None, None, None, -1.5, 2.0, 2.0, 2.0002, 100.0, 3.0, None]
    days = ["2021-10-26T02:00:00Z", "2021-10-26", "2021-10-26 23:59:59", "x", None, "2021-13-01"]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = [str(r.d) for r in spark.createDataFrame([(d,) for d in days], "d string").select(day_of(F.col("d")).alias("d")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == ["2021-10-26"] * 3 + ["None"] * 3


def test_unreadable_spot_prices(spark, tmp_path):
    bad = SPOT + "SP;PEG;PEG DAY AHEAD;2021-10-27;2021-10-28;NaN;EUR/MWh\nSP;PEG\n"
    (tmp_path / "GasSpotMarketResults_TTF_1.csv").write_text(bad)
    lines = exchange_files.read_exchange_spot(spark, str(tmp_path))
    assert sorted(r.price_mid for r in N.normalize_spot(lines).collect()) == [84.1234, 85.5]
    found = {r.reason: r for r in N.unreadable(N.judged_spot(lines)).collect()}
    assert sorted(found) == ["line", "price"]
    assert found["line"].source_line == "SP;PEG" and found["line"].source_file.endswith("GasSpotMarketResults_TTF_1.csv")


@pytest.mark.parametrize(("xml", "text"), [
    ("<a>x &amp; y</a>", "x & y"), ("<a><![CDATA[x < &amp; y]]></a>", "x < &amp; y"), ("<a>caf&#233; &#x26; &#8364;</a>", "café & €"),
    ("<a>before<b>nested</b></a>", "before"), ("<a></a><a>later</a>", None), ("<a/><a>later</a>", None), ('<a n="1">x</a>', "x"),
    ("<ab>x</ab>", None), ("<a>1 &# 2</a>", "1 &# 2"), ("<a>" + "x" * 1_000_000 + "</a>", "x" * 1_000_000),
    ("<a>&#38;lt;</a>", "&lt;"), ("<a>&amp;amp; & &foo; &</a>", "&amp; & &foo; &"), ("<a>&#9999999;</a>", "&#9999999;"),
    ("<a>&#xD800; &#0; &#x110000;</a>", "&#xD800; &#0; &#x110000;"), ("<a>&#x1F600;&#0000000065;</a>", "😀A"),
    ("<a>p&lt;<![CDATA[q&lt;]]>r&gt;<b/>s<![CDATA[t]]></a>", "p<q&lt;r>"), ("<a>x<b><![CDATA[t]]></b></a>", "x"),
    ("<a><![CDATA[open", "open"), ("<a>" + "t&amp;<![CDATA[<&]]>" * 2000 + "</a>", "t&<&" * 2000), ("<a " + "b" * 300_000 + ">k</a>", "k"),
    ("<a>" + "&lt;" * 100_000 + "</a>", "<" * 100_000), ("<a/><a><![CDATA[later]]></a>", None),
], ids=lambda value: str(value)[:20])
def test_tag_text(spark, xml, text):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(xml,)], "x string")
    assert df.select(assessor_xml.tag_text(F.col("x"), "a").alias("t")).first().t == text


def test_out_of_scope_futures_are_not_broken(spark, tmp_path):
    """Only lines in scope are judged: a short line of another code is left out in silence."""
    bad = FUTURES + "OT;x;y\nPR;x;EEX TTF Natural Gas Month Futures\n"
    (tmp_path / "GasFutureMarketResults_TTF_20211026.csv").write_text(bad)
    judged = N.judged_futures(exchange_files.read_exchange_futures(spark, str(tmp_path)))
    assert sorted(str(r.reason) for r in judged.collect()) == [
        "None", "line", "no price", "out of scope", "out of scope", "out of scope", "out of scope"
    ]
    assert [r.source_line for r in N.unreadable(judged).collect()] == ["PR;x;EEX TTF Natural Gas Month Futures"]


def test_landed_files_and_feeds(spark, tmp_path):
    from quotebridge.operators import coverage

    folder = tmp_path / "ingest_date=2021-10-27" / "source=exchange"
    folder.mkdir(parents=True)
    for name in ("GasSpotMarketResults_TTF_20211026.csv", "GasFutureMarketResults_TTF_20211026.csv", "GasSpotMarketResults_x.csv", "other.csv"):
        (folder / name).write_text("12345")
    files = landing.landed_files(spark, str(tmp_path))
    assert {(r.file_name, r.file_bytes, str(r.ingest_date), r.source) for r in files.collect()} >= {("other.csv", 5, "2021-10-27", "exchange")}
    feeds = coverage.landed_exchange_feeds(landing.landed_files(spark, str(tmp_path), "exchange"))
    assert sorted((str(r.pub_date), r.hub, r["product"]) for r in feeds.collect()) == [
        ("2021-10-26", "ttf", "derivatives"), ("2021-10-26", "ttf", "spot")
    ]
    assert landing.landing_paths("/l", "s", date(2021, 1, 31), date(2021, 2, 1)) == [
        "/l/ingest_date=2021-01-31/source=s", "/l/ingest_date=2021-02-01/source=s"
    ]


def test_tag_texts_search_a_document_once(spark):
    """One search finds all tags; documents whose sections hold tags, or come one after the other, are read as before."""
    from pyspark.sql import functions as F

    texts = assessor_xml.tag_texts(F.col("x"), ["a", "b.c", "e"])
    plan = spark.createDataFrame([("",)], "x string").select(texts.alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(x") == 1
    documents = {
        "<a>1</a><bxc>0</bxc><b.c x='/'>2</b.c><e/><e>3</e>": ["1", "2", None],
        "<a><![CDATA[<e>in</e>]]> &amp; <![CDATA[&amp;]]>x</a><b.c>]]><![CDATA[y]]></b.c>": ["<e>in</e> & &amp;x", "]]>y", "in"],
        "<a><![CDATA[ 2 < 3 <![CDATA[4]]>&#65;<b.c>5": ["2 < 3 4A", "5", None],
        "<a x='<e>'>1<e> 2 </e><a>3</a>": ["'>1", None, "'>1"],
        "<a><![CDATA[open <b.c>": ["open <b.c>", None, None],
    }
    df = spark.createDataFrame([(x,) for x in documents], "x string")
    assert {r.x: r.t for r in df.select("x", texts.alias("t")).collect()} == documents


def lineitem_folder(spark, tmp_path, rows=60) -> str:
    """A folder with a ``lineitem`` table of its own: three months, one row without a day, one row twice."""
    from datetime import datetime

    days = [datetime(1995, 1 + i % 3, 1 + i % 28) for i in range(rows)]
    lines = [(i, 7 * i, 5 * i, 1 + i % 7, "O", "N", day) for i, day in enumerate(days)]
    lines += [lines[0], (rows, 1, 1, 1, "O", "N", None)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_linestatus string, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, schema).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_documents_lie_in_folders_that_go(spark, tmp_path):
    """Documents are written some at a time, each whole, and go when they have been read; together they are all documents."""
    from pathlib import Path

    from checks import file_feeds

    sf_dir = lineitem_folder(spark, tmp_path)
    every = Path(file_feeds.write_assessor_files(spark, sf_dir, "assessments"))
    wanted = {f.name: sorted(f.read_text().splitlines()) for f in every.glob("*.xml")}
    seen, folders = {}, []
    for folder in file_feeds.assessor_batches(spark, sf_dir, "assessments", 25):
        assert not any(Path(f).exists() for f in folders)
        folders.append(folder)
        seen |= {f.name: sorted(f.read_text().splitlines()) for f in Path(folder).glob("*.xml")}
    assert seen == wanted and len(wanted) == 3
    assert len(folders) == 3 and not any(Path(f).exists() for f in folders)


def test_feeds_of_one_reader_are_not_landed(spark, tmp_path):
    """A supplier's quotes are made straight from the table, with the rows of the landed feed; its tasks' rows are not moved first."""
    from checks import feeds, queries

    sf_dir = lineitem_folder(spark, tmp_path)
    stored = queries.internal_table(spark, sf_dir).collect(), queries.exchange_table(spark, sf_dir).collect()
    assert not any(key[1] == sf_dir for key in feeds._LANDED)
    for name in ("raw_internal", "raw_spot", "raw_futures"):
        direct = feeds.feed_once(spark, sf_dir, name).collect()
        assert sorted(map(str, direct)) == sorted(map(str, feeds.feed(spark, sf_dir, name).collect())) and len(direct) == 62
    landed = queries.internal_quotes(spark, sf_dir).collect(), queries.exchange_quotes(spark, sf_dir).collect()
    assert [sorted(map(str, rows)) for rows in stored] == [sorted(map(str, rows)) for rows in landed] and all(stored)
    cores = spark.sparkContext.defaultParallelism
    assert feeds._spread(spark.range(cores * 2)).rdd.getNumPartitions() == cores and feeds._spread(spark.range(0, 9, 1, 1)).rdd.getNumPartitions() == cores
    assert "Exchange" not in feeds._spread(spark.range(0, 9, 1, cores // 2))._jdf.queryExecution().executedPlan().toString()


def test_accepted_lines_are_not_stored_with_their_text(spark, folder, tmp_path, monkeypatch):
    """The stage between reading and quotes holds file and line of what is set aside only; the quarantine has them as before."""
    from quotebridge.plans import jobs
    from quotebridge.sinks import tables

    warehouse, seen = jobs.Warehouse(str(tmp_path / "silver"), str(tmp_path / "gold")), []
    judge = jobs.shaping.quarantine
    monkeypatch.setattr(jobs.shaping, "quarantine", lambda rows: (seen.extend(rows.select("source_line", jobs.shaping.is_valid().alias("ok")).collect()), judge(rows))[1])
    (tmp_path / "in").mkdir()
    spot = "ST;2021-10-26;2021-10-26 18:00:00\nSP;TTF;TTF DAY AHEAD;2021-10-27;2021-10-28;84,1234;EUR/MWh\nSP;T/F;TTF DAY AHEAD;2021-10-27;2021-10-28;84,1;EUR/MWh\nSP;PEG\n"
    (tmp_path / "in" / "GasSpotMarketResults_TTF_1.csv").write_text(spot)
    jobs.load_exchange(spark, str(tmp_path / "in"), warehouse, "X")
    assert sorted((r.ok, r.source_line is None) for r in seen) == [(False, False), (True, True)]
    rejected = tables.read_table(spark, warehouse.quarantine("exchange")).collect()
    assert len(rejected) == 2 and all(r.source_line.startswith("SP;") and r.source_file.endswith("TTF_1.csv") for r in rejected)
