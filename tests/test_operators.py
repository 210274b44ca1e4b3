"""Merge laws, skewed keys, physical plans and the jobs end to end."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import queries as Q
from checks.feeds import feed
from quotebridge.operators import coverage, merge, reconcile, report, shaping
from quotebridge.operators.dedupe import dedupe_quotes
from quotebridge.operators.skew import flag_duplicates, salted_join
from quotebridge.plans import jobs
from quotebridge.plans import normalize as N
from quotebridge.schema import REPORT
from quotebridge.sinks import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def small(spark):
    schema = "price_uk string, price_mid int, src_last_update int"
    target = spark.createDataFrame([("a", 1, 10), ("b", 1, 10), ("c", 1, 10)], schema)
    source = spark.createDataFrame([("a", 2, 9), ("b", 2, 10), ("c", 2, 11), ("d", 2, 1)], schema)
    return target, source


@pytest.mark.parametrize(
    ("mode", "want"),
    [
        ("newer_wins", [("a", 1, 10), ("b", 1, 10), ("c", 2, 11), ("d", 2, 1)]),
        ("update_all", [("a", 2, 9), ("b", 2, 10), ("c", 2, 11), ("d", 2, 1)]),
        ("insert_only", [("a", 1, 10), ("b", 1, 10), ("c", 1, 10), ("d", 2, 1)]),
    ],
)
def test_merge_modes_and_idempotence(small, mode, want):
    target, source = small
    once = merge.merge_rows(target, source, ["price_uk"], mode)
    assert rows(once) == want
    assert rows(merge.merge_rows(once, source, ["price_uk"], mode)) == want


def test_merge_refuses_repeated_source_keys(small):
    target, source = small
    with pytest.raises(Exception, match="more than one source row"):
        merge.merge_rows(target, source.unionAll(source), ["price_uk"]).collect()


def test_unknown_mode(small):
    with pytest.raises(ValueError, match="unknown merge mode"):
        merge.merge_rows(*small, ["price_uk"], "other")


def test_hot_key_join_and_flags(spark):
    """One key holds most rows, many of them identical."""
    hot = spark.range(0, 5000, 1, 6).select(
        F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("v"),
    )
    names = hot.select("k").distinct().withColumn("name", F.concat(F.lit("n"), "k"))
    assert rows(salted_join(hot, names, ["k"], salts=4)) == rows(hot.join(names, "k"))
    odd = names.filter("k % 2 <> 0").select("k")
    for how in ("left_semi", "left_anti"):
        assert rows(salted_join(hot, odd, ["k"], how, 4)) == rows(hot.join(odd, "k", how))
    flagged = flag_duplicates(hot, ["k"], [F.col("v")], salts=4)
    hot.createOrReplaceTempView("hot")
    want = spark.sql(
        "SELECT k, v, count(*) OVER (PARTITION BY k) > 1 AS is_duplicate, "
        "row_number() OVER (PARTITION BY k ORDER BY v) > 1 AS is_repeat FROM hot"
    )
    assert rows(flagged) == rows(want)


def test_dedupe_drops_copies_before_the_shuffle(spark):
    quotes = dedupe_quotes(Q.exchange_rows(spark, SF))
    text = plan(quotes)
    assert text.count("WindowGroupLimit") == 2  # before and after the exchange


def test_reconcile_is_one_join_without_python(spark):
    compared = reconcile.reconcile(Q.internal_table(spark, SF), Q.published_table(spark, SF))
    text = plan(compared)
    assert text.count("Join") == 1
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
    assert "HashAggregate" not in text  # pairs are unique by construction


def test_normalizers_stay_in_the_jvm(spark):
    for df in (Q.internal_quotes(spark, SF), Q.exchange_quotes(spark, SF), Q.assessor_quotes(spark, SF)):
        text = plan(df)
        assert "Python" not in text and "Cartesian" not in text


def test_conflict_search_scans_once(spark):
    from quotebridge.operators import quality

    df = quality.conflicting_curves(Q.internal_valid(spark, SF))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_window_filters_reach_the_scan(spark):
    compared = reconcile.reconcile(
        Q.internal_table(spark, SF), Q.published_table(spark, SF), date(1997, 1, 1), date(1997, 12, 31)
    )
    assert plan(compared).count("GreaterThanOrEqual(pub_date,1997-01-01)") == 3


def test_pairs_are_unique_and_general_wins(spark):
    compared = reconcile.reconcile(
        Q.internal_table(spark, SF), Q.published_table(spark, SF), with_rule=True
    )
    pairs = compared.count()
    assert pairs == compared.select("endur_price_uk", "ext_price_uk").distinct().count() > 0
    same = compared.filter("endur_price_uk = ext_price_uk").select("rule").distinct().collect()
    assert [r.rule for r in same] == ["general"]


def test_date_range_is_inclusive(spark):
    days = coverage.date_range(spark, date(2021, 2, 27), date(2021, 3, 1))
    assert [r.pub_date for r in days.collect()] == [date(2021, 2, 27), date(2021, 2, 28), date(2021, 3, 1)]


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 300, 1, 6).select(
        F.lit("1998-01-01").cast("date").alias("pub_date"), F.col("id").cast("string").alias("price_uk"),
        F.lit("TTF").alias("location_name"),
    )
    df.write.partitionBy("pub_date").parquet(path)
    before = rows(spark.read.parquet(path))
    files = len(spark.read.parquet(path).inputFiles())
    tables.compact(spark, path, [date(1998, 1, 1)])
    spark.catalog.clearCache()
    after = spark.read.parquet(path)
    assert rows(after) == before and len(after.inputFiles()) < files


def test_untouched_partitions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "price_uk string, price_mid int, src_last_update int, pub_date string"
    first = spark.createDataFrame([("a", 1, 1, "d1"), ("b", 1, 1, "d2")], schema)
    tables.merge_into(spark, path, first, ["price_uk"])
    kept = [f for f in spark.read.parquet(path).inputFiles() if "pub_date=d1" in f]
    tables.merge_into(spark, path, spark.createDataFrame([("b", 2, 2, "d2"), ("c", 2, 2, "d2")], schema), ["price_uk"])
    table = spark.read.parquet(path)
    assert rows(table.select("price_uk", "price_mid")) == [("a", 1), ("b", 2), ("c", 2)]
    assert [f for f in table.inputFiles() if "pub_date=d1" in f] == kept


def test_namespace(spark, tmp_path):
    description = tables.ensure_namespace(spark, "quotes_check", str(tmp_path / "db"))
    assert any("quotes_check" in str(r) for r in description.collect())


def test_only_the_report_is_one_file(spark, tmp_path):
    with pytest.raises(ValueError, match="single file"):
        tables.export_report(spark.range(10), str(tmp_path), "x.parquet")


def test_large_day_becomes_several_sorted_files(spark, tmp_path):
    path = str(tmp_path / "t")
    text = F.sha2(F.col("id").cast("string"), 512)
    df = spark.range(0, 60000, 1, 7).select(
        text.alias("price_uk"), F.concat(F.lit("L"), F.col("id") % 5).alias("location_name"), F.lit("1998-01-01").cast("date").alias("pub_date")
    )
    df.write.partitionBy("pub_date").parquet(path)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        tables.compact(spark, path, [date(1998, 1, 1)])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).inputFiles()
    assert 1 < len(files) < 7
    for file in files:
        found = [(r.location_name, r.price_uk) for r in spark.read.parquet(file).collect()]
        assert found == sorted(found)


def test_only_partitions_with_small_files_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    days = F.when(F.col("id") % 2 == 0, "1998-01-01").otherwise("1998-01-02")
    spark.range(0, 50, 1, 5).select("id", days.alias("pub_date")).filter("pub_date = '1998-01-01' OR id = 7").write.partitionBy("pub_date").parquet(path)
    found = tables.small_file_partitions(spark, path).collect()
    assert [(str(r.pub_date), r.files) for r in found] == [("1998-01-01", 5)]


def test_merge_raises_when_a_key_leaves_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "price_uk string, price_mid int, src_last_update int, pub_date string"
    day = F.substring("price_uk", 1, 2)
    tables.merge_into(spark, path, spark.createDataFrame([("d1/a", 1, 1, "d1")], schema), ["price_uk"], key_partition=day)
    with pytest.raises(Exception, match="leaves its partition"):
        tables.merge_into(spark, path, spark.createDataFrame([("d1/a", 1, 2, "d2")], schema), ["price_uk"], key_partition=day)
    assert rows(spark.read.parquet(path).select("price_uk", "price_mid")) == [("d1/a", 1)]


def test_jobs_refuse_another_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            jobs.require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_older_comparison_is_one_join(spark):
    text = plan(reconcile.reconcile_all_generic(Q.every_quote(spark, SF)))
    assert text.split("== Initial Plan ==")[0].count("SortMergeJoin") + text.split("== Initial Plan ==")[0].count("HashJoin") == 1


def test_extract_internal(spark, tmp_path):
    T1 = "id_number int, name string"
    relations = {
        "definitions": spark.createDataFrame(
            [(1, 1, 1, "NG_PNX_A", 7, 3, 5), (1, 2, 1, "NG_PNX_A", 7, 3, 5), (2, 1, 0, "NG_PNX_B", 7, 3, 5)],
            "index_id int, index_version_id int, db_status int, index_name string, currency int, unit int, delivery_type int",
        ),
        "currencies": spark.createDataFrame([(7, "EUR")], T1),
        "units": spark.createDataFrame([(3, "MWh")], "unit_id int, unit_label string"),
        "prices": spark.createDataFrame(
            [(1, 9, date(2021, 10, d), date(2021, 10, d + 1), 80.0 + d, datetime(2021, 10, d, 17)) for d in (1, 2, 20)],
            "index_id int, ref_source int, reset_date date, start_date date, price double, last_update timestamp",
        ),
        "sources": spark.createDataFrame([(9, "PNX EOD")], T1),
        "delivery_types": spark.createDataFrame([(5, "NatGas")], T1),
    }
    counts = jobs.extract_internal(relations, str(tmp_path), date(2021, 10, 3), "internal", date(2021, 10, 1), date(2021, 10, 9))
    assert rows(counts) == [("loaded", 2)]


def test_ingestion_timestamp_and_column_order(spark):
    df = shaping.with_ingestion_ts(spark.range(1).withColumn("p", F.lit(1)))
    assert shaping.partition_last(df, "id").columns == ["p", "ingestion_date", "id"]


def test_jobs_end_to_end(spark, tmp_path):
    """Feeds of one month through every job, twice; the second run changes nothing but gold time."""
    warehouse = jobs.Warehouse(str(tmp_path / "silver"), str(tmp_path / "gold"))
    landed = str(tmp_path / "landed")
    month = feed(spark, SF, "raw_internal").filter("pub_date BETWEEN '1998-03-01' AND '1998-03-31'")
    month.withColumn("last_update", F.col("last_update").cast("timestamp")).write.parquet(landed)
    published = str(tmp_path / "files")
    (tmp_path / "files").mkdir()
    from tests.test_files import ASSESSMENTS, FUTURES, INDICES, SPOT

    (tmp_path / "files" / "GasSpotMarketResults_TTF_1.csv").write_text(SPOT)
    (tmp_path / "files" / "GasFutureMarketResults_TTF_1.csv").write_text(FUTURES)
    (tmp_path / "files" / "a_assessments.xml").write_text(ASSESSMENTS)
    (tmp_path / "files" / "a_indices.xml").write_text(INDICES)
    extra = spark.createDataFrame(
        [("NatGas", "NG_PNX_TTF.EOD", "PNX EOD", date(2021, 10, 26), date(2021, 10, 27), 85.5, "EUR", "MWh",
          datetime(2021, 10, 26, 17))],
        month.withColumn("last_update", F.col("last_update").cast("timestamp")).schema,
    )
    extra.write.mode("append").parquet(landed)
    counts = []
    for run, hour in enumerate((6, 8)):
        loads = [
            jobs.load_internal(spark, landed, warehouse), jobs.load_exchange(spark, published, warehouse, "exchange feed"),
            jobs.load_assessor(spark, published, warehouse, "assessor feed"),
        ]
        for load in loads:
            n = {r.stage: r.no_rows for r in load.collect()}
            assert n["loaded"] == n["ruled_out"] + n["quarantined"] + n["duplicates"] + n["stored"]
            assert n["stored"] > 0 and min(n.values()) >= 0
        compared = jobs.compare(spark, warehouse, datetime(2021, 10, 27, hour), version=run)
        jobs.report_day(spark, warehouse, compared)
        counts.append([tables.read_table(spark, p).count() for p in (
            warehouse.quotes("internal"), warehouse.quotes("exchange"), warehouse.quotes("assessor"),
            warehouse.compared, warehouse.report)])
    assert counts[0] == counts[1] and counts[0][1:] == [3, 3, 1, 1]
    report = spark.read.parquet(f"{warehouse.exports}/daily_price_report.parquet").collect()
    assert [(r.no_prices_compared, r.no_price_matches) for r in report] == [(1, 1)]
    jobs.compact_all(spark, warehouse)
    jobs.create_views(spark, warehouse)
    assert spark.sql("SELECT count(*) AS n FROM tprices").first().n == 1
    assert report[0].comparison_date == "2021-10-27"
    assert dict(tables.read_table(spark, warehouse.report, REPORT).dtypes)["comparison_date"] == "string"
    history = tables.read_table(spark, warehouse.history)
    assert [(r.version, r["count"]) for r in history.groupBy("version").count().collect()] == [(0, 1)]
    jobs.register_tables(spark, warehouse, "checked_processed", "checked_exposed")
    stored = spark.sql("SELECT count(*) AS n FROM checked_processed.exchange_prices").first().n
    assert stored == 3 and spark.table("checked_exposed.compared_prices").count() == 1
    assert merge.as_of(history, ["endur_price_uk", "ext_price_uk"], 0).count() == 1


def _landed(tmp_path, day="2021-10-27"):
    from tests.test_files import ASSESSMENTS, FUTURES, INDICES, SPOT

    folder = tmp_path / "landing" / f"ingest_date={day}" / "source=files"
    folder.mkdir(parents=True)
    spot = SPOT + "SP;TTF/NBP;TTF DAY AHEAD;2021-10-27;2021-10-28;80;EUR/MWh\nSP;PEG;PEG DAY AHEAD;2021-10-27;2021-10-28;n/a;EUR/MWh\nSP;PEG\n"
    stamp = day.replace("-", "")
    (folder / f"GasSpotMarketResults_TTF_{stamp}.csv").write_text(spot)
    (folder / f"GasFutureMarketResults_TTF_{stamp}.csv").write_text(FUTURES)
    (folder / "a_assessments.xml").write_text(ASSESSMENTS)
    (folder / "a_indices.xml").write_text(INDICES)
    return str(tmp_path / "landing"), folder


def test_quarantine_holds_file_line_and_reason_once(spark, tmp_path):
    """A key with '/' in a part, a text price and a short line are set aside; a repeat of the load replaces them."""
    _, folder = _landed(tmp_path)
    warehouse = jobs.Warehouse(str(tmp_path / "silver"), str(tmp_path / "gold"))
    for _ in range(2):
        counters = {r.stage: r.no_rows for r in jobs.load_exchange(spark, str(folder), warehouse, "X").collect()}
        assert counters == {"loaded": 11, "ruled_out": 5, "unreadable": 2, "quarantined": 3, "duplicates": 0, "stored": 3}
        found = tables.read_table(spark, warehouse.quarantine("exchange")).collect()
        assert sorted((r.missing_fields, r.source_line.split(";")[1]) for r in found) == [
            ("line", "PEG"), ("location_name holds /", "TTF/NBP"), ("price", "PEG")
        ]
        assert tables.read_table(spark, warehouse.quotes("exchange")).count() == 3
    (folder / "GasSpotMarketResults_TTF_20211027.csv").unlink()
    jobs.load_exchange(spark, str(folder), warehouse, "X")
    assert tables.read_table(spark, warehouse.quarantine("exchange")).count() == 0


@pytest.mark.parametrize("supplier", ["internal", "exchange", "assessor"])
def test_a_load_reads_its_feed_once(spark, tmp_path, monkeypatch, supplier):
    """The feed is deleted as soon as all of it has been stored: nothing asks for it again."""
    import shutil
    from contextlib import contextmanager

    _, folder = _landed(tmp_path)
    landed = str(folder)
    last = {"exchange": "futures-lines"}.get(supplier, f"{supplier}-rows")
    if supplier == "internal":
        landed = str(tmp_path / "internal")
        feed(spark, SF, "raw_internal").withColumn("last_update", F.col("last_update").cast("timestamp")).write.parquet(landed)
    original = jobs.stages

    @contextmanager
    def watched(session):
        with original(session) as stage:
            def stored(df, name, **options):
                found = stage(df, name, **options)
                if name == last:
                    shutil.rmtree(landed)
                return found
            yield stored

    monkeypatch.setattr(jobs, "stages", watched)
    warehouse = jobs.Warehouse(str(tmp_path / "silver"), str(tmp_path / "gold"))
    run = {
        "internal": lambda: jobs.load_internal(spark, landed, warehouse),
        "exchange": lambda: jobs.load_exchange(spark, landed, warehouse, "X"),
        "assessor": lambda: jobs.load_assessor(spark, landed, warehouse, "X"),
    }[supplier]
    n = {r.stage: r.no_rows for r in run().collect()}
    assert n["loaded"] == n["ruled_out"] + n["quarantined"] + n["duplicates"] + n["stored"] and n["stored"] > 0


def test_only_new_files_are_loaded(spark, tmp_path):
    warehouse = jobs.Warehouse(str(tmp_path / "silver"), str(tmp_path / "gold"))

    def run(supplier):
        return {r.stage: r.no_rows for r in jobs.load_new(spark, supplier, root, warehouse, "files", "X").collect()}

    root, folder = _landed(tmp_path)
    first = {s: run(s) for s in ("exchange", "assessor")}
    assert first["exchange"]["loaded"] == 11 and first["exchange"]["stored"] == 3 and first["assessor"]["loaded"] == 7
    for file in folder.iterdir():  # what was loaded is not read again
        file.unlink()
    assert run("exchange") == {} and run("assessor") == {}
    _landed(tmp_path, "2021-10-28")
    assert run("exchange")["loaded"] == 11
    assert tables.read_table(spark, warehouse.quotes("exchange")).count() == 3
    assert tables.read_table(spark, warehouse.quarantine("exchange")).groupBy("load_id").count().count() == 2
    landed = f"{root}/ingest_date=2021-10-28/source=internal"
    raw = feed(spark, SF, "raw_internal").withColumn("last_update", F.col("last_update").cast("timestamp"))
    raw.write.parquet(landed)
    counters = {r.stage: r.no_rows for r in jobs.load_new(spark, "internal", root, warehouse, "internal").collect()}
    assert counters["loaded"] == raw.count()
    assert counters["stored"] == tables.read_table(spark, warehouse.quotes("internal")).count() > 0
    with pytest.raises(ValueError, match="supplier"):
        jobs.load_new(spark, "other", root, warehouse, "files")


def test_window_ends_at_the_given_day(spark):
    days = spark.createDataFrame([("2021-10-26",), ("2021-10-25",), ("2021-10-24",), ("2021-10-28",), ("x",)], "pub_date string")
    assert sorted(r.pub_date for r in jobs.recent(days, 2, date(2021, 10, 26)).collect()) == ["2021-10-25", "2021-10-26"]
    assert jobs.recent(days, None).count() == 5


def _quotes(spark, count, day="1998-01-01", start=0):
    return spark.range(start, start + count).select(
        F.sha2(F.col("id").cast("string"), 256).alias("price_uk"), F.concat(F.lit("L"), F.col("id") % 5).alias("location_name"),
        F.lit(1).alias("price_mid"), F.lit(1).alias("src_last_update"), F.lit(day).cast("date").alias("pub_date"),
    )


def _scan_rows(df):
    """Rows that the file scan of a collected frame gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    found, open_ = [], [plan]
    while open_:
        node = open_.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if "Scan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            open_.append(node.plan())
    return sum(found)


def test_bucketed_merge_does_not_move_the_stored_side(spark, tmp_path):
    name, path = "checked_bucketed", str(tmp_path / "b")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = _quotes(spark, 900).unionByName(_quotes(spark, 900, "1998-01-02", 5000))
    tables.merge_into_bucketed(spark, name, path, first, ["price_uk"], 4)
    newer = _quotes(spark, 1000).withColumns({"price_mid": F.lit(2), "src_last_update": F.lit(2)})
    merged = tables.bucketed_merge(spark, name, newer, ["price_uk"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tables.bucketed_merge(spark, name, newer, ["price_uk"])._jdf.queryExecution().sparkPlan().toString()
        executed = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SelectedBucketsCount: 4 out of 4" in executed and "FullOuter" in plan
    lines = executed.splitlines()
    scan = next(i for i, line in enumerate(lines) if "SelectedBucketsCount" in line)
    depth = lines[scan].index("FileScan")
    above, at = [], depth
    for line in reversed(lines[:scan]):  # the ancestors of the scan, up to the join
        own = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if own < at:
            above.append(line)
            at = own
        if "FullOuter" in line:
            break
    assert "FullOuter" in above[-1] and not any("Exchange hashpartitioning(price_uk" in line for line in above)
    files = set(spark.table(name).where("pub_date = '1998-01-02'").inputFiles())
    tables.merge_into_bucketed(spark, name, path, newer, ["price_uk"], 4)
    stored = spark.table(name)
    assert stored.groupBy("pub_date", "price_mid").count().orderBy("pub_date", "price_mid").collect() == [
        (date(1998, 1, 1), 2, 1000), (date(1998, 1, 2), 1, 900)
    ]
    assert {f for f in stored.inputFiles() if "1998-01-02" in f} == {f for f in files if "1998-01-02" in f}
    assert len([f for f in stored.inputFiles() if "1998-01-01" in f]) <= 4
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("compacted", [False, True])
def test_key_lookup_skips_row_groups(spark, tmp_path, compacted):
    """Rows lie by location, so every row group spans all keys: only the bloom filter can rule it out."""
    path = str(tmp_path / "t")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(64 * 1024))
    hadoop.set("parquet.page.size.row.check.min", "100")
    try:
        tables.merge_into(spark, path, _quotes(spark, 20_000).orderBy("location_name").coalesce(1), ["price_uk"])
        if compacted:
            tables.compact(spark, path, [date(1998, 1, 1)])
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.page.size.row.check.min")
    key = tables.read_table(spark, path).where("location_name = 'L3'").first().price_uk
    found = report.lookup(tables.read_table(spark, path), ["price_uk"], price_uk=key)
    assert found.count() == 1
    looked_up = tables.read_table(spark, path).where(F.col("price_uk") == key)
    assert len(looked_up.collect()) == 1
    assert _scan_rows(looked_up) < 20_000 / 3
    absent = tables.read_table(spark, path).where(F.col("price_uk") == "7" + "0" * 63)
    assert absent.collect() == [] and _scan_rows(absent) < 20_000 / 3


def test_a_source_that_does_not_fit_is_refused_before_a_write(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_into(spark, path, _quotes(spark, 10), ["price_uk"])
    files = sorted(str(f) for f in (tmp_path / "t").rglob("*"))
    for source, problem in (
        (_quotes(spark, 10).withColumn("price_mid", F.lit("1")), "price_mid is string, not int"),
        (_quotes(spark, 10).drop("location_name"), "location_name is missing"),
        (_quotes(spark, 10).withColumn("note", F.lit("x")), "note not stored"),
    ):
        with pytest.raises(ValueError, match=problem):
            tables.merge_into(spark, path, source, ["price_uk"])
    assert sorted(str(f) for f in (tmp_path / "t").rglob("*")) == files
    noted = _quotes(spark, 5, "1998-01-03", 100).withColumn("note", F.lit("x"))
    tables.merge_into(spark, path, noted, ["price_uk"], add_columns=True)
    tables.merge_into(spark, path, _quotes(spark, 12).withColumns({"note": F.lit("y"), "src_last_update": F.lit(2)}), ["price_uk"], add_columns=True)
    stored = tables.read_evolved(spark, path)
    assert stored.groupBy("note").count().orderBy("note").collect() == [("x", 5), ("y", 12)]
    assert tables.conform(noted.drop("note"), noted.schema, "pub_date", optional=["note"]).columns == noted.columns


def test_a_second_compaction_finds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    two = _quotes(spark, 30_000).unionByName(_quotes(spark, 2000, "1998-01-02", 50_000)).repartition(6)
    two.write.partitionBy("pub_date").parquet(path)
    size = 300_000
    assert tables.small_file_partitions(spark, path, file_bytes=size).count() > 0
    for _ in range(2):  # a smaller rewrite may need one file less
        tables.compact(spark, path, file_bytes=size)
    before = sorted(spark.read.parquet(path).inputFiles())
    assert tables.small_file_partitions(spark, path, file_bytes=size).count() == 0
    tables.compact(spark, path, file_bytes=size)
    assert sorted(spark.read.parquet(path).inputFiles()) == before
    assert spark.read.parquet(path).count() == 32_000


def test_stored_counts_follow_the_touched_days(spark, tmp_path):
    warehouse = jobs.Warehouse(str(tmp_path / "silver"), str(tmp_path / "gold"))

    def compared(day, kind, keys):
        return spark.createDataFrame([(f"i{k}", f"e{k}", "P", kind, day) for k in keys], "endur_price_uk string, ext_price_uk string, publication_name string, price_match string, pub_date date")

    one, two = date(1998, 1, 1), date(1998, 1, 2)
    for rows_ in (compared(one, "True", range(5)).unionByName(compared(two, "False", range(10, 13))), compared(two, "True", range(12, 15))):
        tables.merge_into(spark, warehouse.compared, rows_, ["endur_price_uk", "ext_price_uk"], merge.UPDATE_ALL)
        jobs.update_counts(spark, warehouse, rows_)
    stored, recount = tables.read_table(spark, warehouse.counts), tables.read_table(spark, warehouse.compared)
    assert rows(report.match_stats_of_counts(stored)) == rows(report.match_stats_by_date(recount))
    assert rows(report.volume_of_counts(stored, "price_match")) == rows(report.volume_by_match(recount))
    assert rows(report.volume_of_counts(stored, "publication_name")) == rows(report.volume_by_publication(recount))
