"""One check query per operator: (spark, sf_dir) -> DataFrame over whole test tables.

Dates and timestamps are shown as text and 32-bit prices as rounded doubles, so that both
engines print the same value.
"""

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import file_feeds
from checks.feeds import feed, feed_once, table
from quotebridge import fixed_values as V
from quotebridge.functions import assessor as A
from quotebridge.functions import exchange as X
from quotebridge.functions import internal as I
from quotebridge.functions.prices import day_of, parse_price, price_key
from quotebridge.operators import coverage, quality, refdata, report, shaping
from quotebridge.operators import merge as M
from quotebridge.operators import reconcile as R
from quotebridge.operators.dedupe import dedupe_quotes, newest_first
from quotebridge.operators.skew import flag_duplicates
from quotebridge.plans import jobs
from quotebridge.plans import normalize as N
from quotebridge.schema import PAIR_KEY, QUOTE_COLUMNS
from quotebridge.sinks import tables
from quotebridge.sinks.staging import new_folder, staged
from quotebridge.sources import assessor_xml, exchange_files, landing

Query = Callable[[SparkSession, str], DataFrame]

EXCHANGE_SOURCE = "exchange feed"
ASSESSOR_SOURCE = "assessor feed"
RUN_TS = "2024-01-31 06:50:00"
WINDOW = (date(1997, 1, 1), date(1999, 12, 31))
EXTRACT_WINDOW = (date(1996, 1, 1), date(2000, 12, 31))


def shown(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, floating values rounded to 6 decimals."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = F.round(column.cast("double"), 6)
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- inputs ----------------------------------------------------------------------------------

def internal_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_internal(feed_once(spark, sf_dir, "raw_internal"))


def internal_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.valid_quotes(N.internal_rows(feed(spark, sf_dir, "raw_internal")))


def exchange_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.exchange_rows(
        spark, feed(spark, sf_dir, "raw_spot"), feed(spark, sf_dir, "raw_futures"),
        EXCHANGE_SOURCE,
    )


def exchange_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_exchange(
        spark, feed_once(spark, sf_dir, "raw_spot"), feed_once(spark, sf_dir, "raw_futures"),
        EXCHANGE_SOURCE,
    )


def assessor_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize_assessor(
        feed(spark, sf_dir, "raw_assessments"), feed(spark, sf_dir, "raw_indices"),
        ASSESSOR_SOURCE,
    )


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, build: Query) -> DataFrame:
    """Normalized quotes of one supplier as a table, written once per session and data directory.

    Comparison, reports and merges start from quote tables, as they do in daily operation.
    """
    key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
    if key not in _STORED:
        path = new_folder(spark, build.__name__)
        tables.export_files(build(spark, sf_dir), path)
        _STORED[key] = path
    return tables.read_table(spark, _STORED[key])


def internal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, internal_quotes)


def exchange_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, exchange_quotes)


def assessor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, assessor_quotes)


def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.all_quotes(exchange_table(spark, sf_dir), assessor_table(spark, sf_dir))


def every_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.all_quotes(
        internal_table(spark, sf_dir), exchange_table(spark, sf_dir),
        assessor_table(spark, sf_dir),
    )


def _run_ts():
    return F.lit(RUN_TS).cast("timestamp")


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reconcile(
        internal_table(spark, sf_dir), published_table(spark, sf_dir), run_ts=_run_ts()
    )


# --- vocabulary functions: one row per distinct input, with how often it occurs --------------

def _tally(df: DataFrame, *columns) -> DataFrame:
    return shown(df.groupBy(*columns).agg(F.count("*").alias("no_rows")))


def _prepared(spark, sf_dir):
    return N.with_texts(feed(spark, sf_dir, "raw_internal"))


def internal_location(spark, sf_dir):
    return _tally(
        _prepared(spark, sf_dir), "index_name", I.location(F.col("hub")).alias("location_name")
    )


def internal_period(spark, sf_dir):
    return _tally(
        _prepared(spark, sf_dir), "publication", "index_name",
        I.period(F.col("pub_words"), F.col("curve_words")).alias("period_duration"),
    )


def internal_publication(spark, sf_dir):
    pub, curve = F.col("pub_upper"), F.col("curve_upper")
    return _tally(
        _prepared(spark, sf_dir), "publication", "index_name",
        I.publication_name(pub, curve).alias("publication_name"),
        I.product_name(pub, curve).alias("product_name"),
        I.product_type(pub, curve).alias("product_type"),
    )


def internal_units(spark, sf_dir):
    ccy = I.currency(F.col("currency"))
    raw = feed(spark, sf_dir, "raw_internal")
    priced = raw.select(
        "index_name", "pub_date", "last_update",
        I.price_in_quoted_currency(F.col("price"), ccy).alias("price_mid"),
        ccy.alias("currency_out"), I.unit(F.col("unit")).alias("unit_out"),
    )
    return shown(priced.groupBy("index_name", "currency_out", "unit_out").agg(
        F.min("price_mid").alias("min_price"), F.max("price_mid").alias("max_price"),
        F.count("*").alias("no_rows"),
    ))


def curve_filter(spark, sf_dir):
    kept = N.drop_unquoted_curves(_prepared(spark, sf_dir))
    return _tally(kept, "index_name", "publication")


def relative_period_duration(spark, sf_dir):
    codes = feed(spark, sf_dir, "raw_assessments").select(
        A.relative_period(F.col("period_rel")).alias("period_rel")
    )
    return _tally(
        codes, "period_rel", I.period_of_relative(F.col("period_rel")).alias("duration")
    )


def month_ahead_end(spark, sf_dir):
    product = I.product_name(F.col("pub_upper"), F.col("curve_upper"))
    return _tally(
        _prepared(spark, sf_dir).withColumn("product_name", product), "product_name", "pub_date", "end_date",
        I.month_ahead_end(F.col("product_name"), F.col("pub_date"), F.col("end_date")).alias(
            "fixed_end_date"
        ),
    )


def invalid_dates(spark, sf_dir):
    return _tally(
        N.internal_rows(feed(spark, sf_dir, "raw_internal")),
        "period_duration", "pub_date", "end_date",
    )


def spot_rows(spark, sf_dir):
    return shown(N.normalize_spot(feed(spark, sf_dir, "raw_spot")))


def futures_rows(spark, sf_dir):
    return shown(N.normalize_futures(feed(spark, sf_dir, "raw_futures")))


def exchange_units(spark, sf_dir):
    unit = F.col("price_unit")
    return _tally(
        feed(spark, sf_dir, "raw_spot"), unit, X.currency(unit).alias("currency"),
        X.unit(unit).alias("unit"),
    )


def assessor_hubs(spark, sf_dir):
    return _tally(N.clean_locations(feed(spark, sf_dir, "raw_assessments")), "location_name")


def assessor_periods(spark, sf_dir):
    timeframe = F.col("period_rel")
    return _tally(
        feed(spark, sf_dir, "raw_assessments"), timeframe.alias("timeframe"),
        A.duration(timeframe).alias("period_duration"),
        A.relative_period(timeframe).alias("period_code"),
    )


def index_descriptions(spark, sf_dir):
    words = F.col("words")
    rows = shaping.with_computed(
        feed(spark, sf_dir, "raw_indices"), {"words": A.index_words(F.col("src_price_id"))}
    )
    return shown(rows.select(
        "src_price_id",
        A.index_product(words).alias("product_name"),
        A.index_duration(words).alias("period_duration"),
        A.index_period_rel(words).alias("period_rel"),
        "pub_date", "src_last_update",
    ))


def assessor_currency(spark, sf_dir):
    name = F.col("currency")
    return _tally(
        feed(spark, sf_dir, "raw_indices"), name.alias("currency_name"),
        A.currency(name).alias("currency_code"),
    )


def parsed_prices(spark, sf_dir):
    raw = feed(spark, sf_dir, "raw_assessments")
    return _tally(
        raw, "price_bid", parse_price(F.col("price_bid")).alias("bid"), "price_offer",
        parse_price(F.col("price_offer")).alias("offer"),
    )


def rolled_bom(spark, sf_dir):
    typed = feed(spark, sf_dir, "raw_assessments").withColumns({
        "pub_date": day_of(F.col("pub_date")), "end_date": day_of(F.col("end_date")),
    })
    return _tally(N.drop_rolled_bom(typed), "period_abs", "pub_date", "end_date")


# --- whole normalizers -----------------------------------------------------------------------

def price_keys(spark, sf_dir):
    return shown(N.assessor_rows(
        feed(spark, sf_dir, "raw_assessments"), feed(spark, sf_dir, "raw_indices"),
        ASSESSOR_SOURCE,
    ).select(price_key().alias("price_uk"), "src_price_id", "period_duration"))


def quarantined(spark, sf_dir):
    rows = N.assessor_rows(
        feed(spark, sf_dir, "raw_assessments"), feed(spark, sf_dir, "raw_indices"),
        ASSESSOR_SOURCE,
    )
    return shown(shaping.quarantine(rows).select(
        "src_price_id", "product_name", "location_name", "pub_date", "missing_fields"
    ))


def combined_quotes(spark, sf_dir):
    return shown(every_quote(spark, sf_dir))


def combined_quotes_distinct(spark, sf_dir):
    tables_ = (exchange_rows(spark, sf_dir), exchange_rows(spark, sf_dir))
    return shown(shaping.all_quotes(*tables_, distinct=True))


def quote_locations(spark, sf_dir):
    return shaping.distinct_values(every_quote(spark, sf_dir), "location_name")


def quotes_partition_last(spark, sf_dir):
    return shown(shaping.partition_last(exchange_quotes(spark, sf_dir), "pub_date"))


# --- duplicates and conflicts ----------------------------------------------------------------

def duplicate_flags(spark, sf_dir):
    rows = internal_valid(spark, sf_dir)
    return shown(flag_duplicates(rows, ["price_uk"], newest_first()).select(
        "price_uk", "src_price_id", "price_mid", "src_last_update", "is_duplicate", "is_repeat"
    ))


def newest_per_key(spark, sf_dir):
    return shown(dedupe_quotes(exchange_rows(spark, sf_dir)))


def inconsistent_quotes(spark, sf_dir):
    return shown(quality.inconsistent_quotes(internal_valid(spark, sf_dir)))


def inconsistent_detail(spark, sf_dir):
    return shown(quality.inconsistent_detail(internal_valid(spark, sf_dir)))


def conflicting_curves(spark, sf_dir):
    return quality.conflicting_curves(internal_valid(spark, sf_dir))


def drop_conflicting_curves(spark, sf_dir):
    kept = quality.drop_conflicting_curves(internal_valid(spark, sf_dir))
    return _tally(kept, "src_price_id", "pub_date")


def zero_prices(spark, sf_dir):
    return shown(quality.zero_prices(internal_table(spark, sf_dir)))


def price_stats(spark, sf_dir):
    return shown(quality.price_stats(internal_table(spark, sf_dir)))


# --- comparison ------------------------------------------------------------------------------

def reconcile(spark, sf_dir):
    return shown(R.reconcile(
        internal_table(spark, sf_dir), published_table(spark, sf_dir), with_rule=True
    ))


def reconcile_window(spark, sf_dir):
    return shown(R.reconcile(
        internal_table(spark, sf_dir), published_table(spark, sf_dir), *WINDOW
    ))


def reconcile_from_one_view(spark, sf_dir):
    internal, external = R.split_sides(every_quote(spark, sf_dir))
    return _tally(R.reconcile(internal, external, with_rule=True), "rule", "price_match")


def comparison_in_order(spark, sf_dir):
    return shown(R.ordered_comparison(comparison(spark, sf_dir)))


def unreconciled(spark, sf_dir):
    internal = internal_table(spark, sf_dir)
    compared = R.reconcile(internal, published_table(spark, sf_dir))
    return shown(R.unreconciled(internal, compared))


def generic_standard(spark, sf_dir):
    return shown(R.reconcile_generic(every_quote(spark, sf_dir), "standard"))


def generic_weekend(spark, sf_dir):
    return shown(R.reconcile_generic(every_quote(spark, sf_dir), "weekend"))


def generic_index(spark, sf_dir):
    return shown(R.reconcile_generic(every_quote(spark, sf_dir), "index"))


def generic_all_sorted(spark, sf_dir):
    return shown(R.reconcile_all_generic(every_quote(spark, sf_dir)))


# --- reports and lookups ---------------------------------------------------------------------

def daily_report(spark, sf_dir):
    """From the raw supplier feeds to the report, as one plan."""
    published = shaping.all_quotes(
        exchange_quotes(spark, sf_dir), assessor_quotes(spark, sf_dir)
    )
    compared = R.reconcile(internal_quotes(spark, sf_dir), published, run_ts=_run_ts())
    return report.daily_report(compared)


def match_stats_by_date(spark, sf_dir):
    return shown(report.match_stats_by_date(comparison(spark, sf_dir)))


def volume_by_publication(spark, sf_dir):
    return shown(report.volume_by_publication(comparison(spark, sf_dir)))


def volume_by_match(spark, sf_dir):
    return shown(report.volume_by_match(comparison(spark, sf_dir)))


def stage_metrics(spark, sf_dir):
    raw = feed(spark, sf_dir, "raw_internal")
    marked = N.with_texts(raw).withColumn("quoted", N.is_quoted_curve())
    passed = report.flag_metrics(marked, loaded=F.lit(True), quoted_curves=F.col("quoted"))
    keyed = staged(N.internal_rows(raw), "keyed")
    return passed.unionByName(report.stage_metrics(
        priced=keyed, stored=N.internal_quotes(shaping.valid_quotes(keyed))
    ))


def latest_pub_date(spark, sf_dir):
    return shown(report.latest_pub_date(assessor_table(spark, sf_dir)))


def latest_pub_date_quotes(spark, sf_dir):
    return shown(report.latest_pub_date_quotes(assessor_table(spark, sf_dir)))


def forward_curve(spark, sf_dir):
    return shown(report.forward_curve(assessor_table(spark, sf_dir), "NBP"))


def quotes_of_hub(spark, sf_dir):
    return shown(report.lookup(
        internal_table(spark, sf_dir), ["pub_date", "price_uk"], limit=5, location_name="NBP"
    ))


def spot_quotes_of_hub_and_day(spark, sf_dir):
    return shown(report.lookup(
        exchange_table(spark, sf_dir), ["pub_date", "price_uk"],
        location_name="TTF", product_type="Spot", pub_date=date(1998, 3, 2),
    ))


def first_quotes(spark, sf_dir):
    return shown(report.lookup(assessor_table(spark, sf_dir), ["price_uk"], limit=10))


def first_mismatches(spark, sf_dir):
    return shown(report.lookup(
        comparison(spark, sf_dir), PAIR_KEY, limit=10, price_match=V.MISMATCH
    ))


# --- upserts ---------------------------------------------------------------------------------

def merge_source(target: DataFrame) -> DataFrame:
    """Every target row again, one unit dearer: older, same age, newer or under a new key."""
    day = F.dayofmonth("pub_date")
    hours = F.make_dt_interval(F.lit(0), day % 3 - 1)
    new_key = F.concat("price_uk", F.lit("/new"))
    return target.withColumns({
        "price_mid": (F.col("price_mid") + F.lit(1).cast("float")).cast("float"),
        "src_last_update": F.col("src_last_update") + hours,
        "price_uk": F.when(day % 7 == 0, new_key).otherwise(F.col("price_uk")),
    })


def _merged(spark, sf_dir, mode):
    target = exchange_table(spark, sf_dir)
    return shown(M.merge_rows(target, merge_source(target), ["price_uk"], mode))


def merge_newer_wins(spark, sf_dir):
    return _merged(spark, sf_dir, M.NEWER_WINS)


def merge_update_all(spark, sf_dir):
    return _merged(spark, sf_dir, M.UPDATE_ALL)


def merge_insert_only(spark, sf_dir):
    return _merged(spark, sf_dir, M.INSERT_ONLY)


def merge_changes(spark, sf_dir):
    target = exchange_table(spark, sf_dir)
    return shown(M.changed_rows(target, merge_source(target), ["price_uk"]))


def history_as_of(spark, sf_dir):
    """Mismatches of an earlier version of the comparison table."""
    first = comparison(spark, sf_dir).withColumn("version", F.lit(1))
    day = F.dayofmonth("pub_date")
    second = first.withColumns({"version": F.lit(2) + day % 3, "price_match": F.lit(V.MATCH)})
    history = first.unionByName(second)
    at_three = M.as_of(history, PAIR_KEY, 3)
    return shown(at_three.filter(F.col("price_match") == V.MISMATCH))


def _by_month(df: DataFrame) -> DataFrame:
    """The test tables are thin: partition by month instead of day."""
    return df.withColumn("pub_month", F.date_format("pub_date", "yyyy-MM"))


def merge_into_table(spark, sf_dir):
    path = new_folder(spark, "quotes")
    target = _by_month(exchange_table(spark, sf_dir))
    tables.merge_into(spark, path, target, ["price_uk"], partition="pub_month")
    tables.merge_into(spark, path, merge_source(target), ["price_uk"], partition="pub_month")
    return shown(tables.read_table(spark, path).select(*QUOTE_COLUMNS))


def merge_comparison_table(spark, sf_dir):
    path = new_folder(spark, "compared")
    compared = comparison(spark, sf_dir)
    rows = _by_month(compared)
    tables.merge_into(spark, path, rows, PAIR_KEY, M.UPDATE_ALL, partition="pub_month")
    again = rows.withColumn("price_match", F.concat("price_match", F.lit(" again")))
    tables.merge_into(spark, path, again, PAIR_KEY, M.UPDATE_ALL, partition="pub_month")
    return shown(tables.read_table(spark, path).select(*compared.columns))


def merge_report_table(spark, sf_dir):
    """One report per day; a later run of the same day changes nothing."""
    path = new_folder(spark, "report")
    by_day = report.match_stats_by_date(comparison(spark, sf_dir))
    rows = _by_month(by_day)
    tables.merge_into(spark, path, rows, ["pub_date"], M.INSERT_ONLY, partition="pub_month")
    later = rows.withColumn("total_prices", F.col("total_prices") + 1)
    tables.merge_into(spark, path, later, ["pub_date"], M.INSERT_ONLY, partition="pub_month")
    return shown(tables.read_table(spark, path).select(*by_day.columns))


def merge_into_bucketed_table(spark, sf_dir):
    """The same upsert into a table whose rows lie in buckets of their key."""
    path, name = new_folder(spark, "bucketed"), f"checked_quotes_{uuid.uuid4().hex}"
    target = _by_month(exchange_table(spark, sf_dir))
    for rows in (target, merge_source(target)):
        tables.merge_into_bucketed(spark, name, path, rows, ["price_uk"], 4, partition="pub_month")
    stored = shown(tables.read_table(spark, path).select(*QUOTE_COLUMNS))
    spark.sql(f"DROP TABLE {name}")  # its files stay, as the table is external
    return stored


def match_stats_stored(spark, sf_dir):
    """Statistics from the stored counts, after a run over all days and one that changes the days of two years."""
    folder = new_folder(spark, "counts")
    warehouse = jobs.Warehouse(f"{folder}/silver", f"{folder}/gold")
    rows = _by_month(comparison(spark, sf_dir))
    later = rows.filter(F.year("pub_date").between(1994, 1995)).withColumn("price_match", F.lit(V.MATCH))
    for run in (rows, later):
        tables.merge_into(spark, warehouse.compared, run, PAIR_KEY, M.UPDATE_ALL, partition="pub_month")
        jobs.update_counts(spark, warehouse, run, "pub_month")
    return shown(report.match_stats_of_counts(tables.read_table(spark, warehouse.counts)))


def overwrite_days(spark, sf_dir):
    path = new_folder(spark, "months")
    quotes = _by_month(internal_table(spark, sf_dir))
    tables.overwrite_partition(quotes, path, "pub_month")
    first_half = quotes.filter(F.month("pub_date") <= 6).withColumn("period_rel", F.lit("new"))
    tables.overwrite_partition(first_half, path, "pub_month")
    return shown(tables.read_table(spark, path).select(*QUOTE_COLUMNS))


def compacted_table(spark, sf_dir):
    path = new_folder(spark, "compact")
    quotes = _by_month(internal_table(spark, sf_dir))
    tables.merge_into(spark, path, quotes, ["price_uk"], partition="pub_month")
    tables.compact(spark, path, partition="pub_month")
    return shown(tables.read_table(spark, path).select(*QUOTE_COLUMNS))


def exported_report(spark, sf_dir):
    folder = new_folder(spark, "export")
    tables.export_report(daily_report(spark, sf_dir), folder, "daily_price_report.parquet")
    return spark.read.parquet(f"{folder}/daily_price_report.parquet")


def exported_comparison(spark, sf_dir):
    folder = new_folder(spark, "export")
    compared = comparison(spark, sf_dir)
    tables.export_files(compared, folder)
    return shown(spark.read.parquet(folder))


# --- sources ---------------------------------------------------------------------------------

def landed_internal(spark, sf_dir):
    root = new_folder(spark, "landing")
    raw = feed(spark, sf_dir, "raw_internal")
    landing.write_landing(raw, root, "2024-01-30", "internal")
    landing.write_landing(raw, root, "2024-01-31", "internal")
    df = landing.read_landing(spark, root, ingest_date=date(2024, 1, 31), source="internal")
    return shown(df.drop("source"))


def _without_source(lines):
    return shown(lines.drop("source_file", "source_line"))


def spot_files(spark, sf_dir):
    return _without_source(exchange_files.read_exchange_spot(spark, file_feeds.write_spot_files(spark, sf_dir)))


def spot_files_by_split(spark, sf_dir):
    """The same files, each by its own path in a list."""
    path = file_feeds.write_spot_files(spark, sf_dir)
    names = landing.landed_files(spark, path).select("file_path").collect()
    return _without_source(exchange_files.read_exchange_spot(spark, [r.file_path for r in names]))


def futures_files_by_split(spark, sf_dir):
    """The same files, their lines stored before they are parsed, as a load does."""
    path = file_feeds.write_futures_files(spark, sf_dir)
    return _without_source(exchange_files.read_exchange_futures(spark, path, store=lambda df, name, **_: staged(df, name)))


def futures_files(spark, sf_dir):
    return _without_source(exchange_files.read_exchange_futures(spark, file_feeds.write_futures_files(spark, sf_dir)))


def _from_documents(spark, sf_dir, kind, read) -> DataFrame:
    """What ``read`` finds in the folders with assessor documents, stored: the documents of a folder go when they have been read."""
    path = new_folder(spark, f"{kind}-read")
    for folder in file_feeds.assessor_batches(spark, sf_dir, kind):
        read(folder).write.mode("append").parquet(path, compression="zstd")
    return spark.read.parquet(path)


def assessment_files(spark, sf_dir):
    return shown(_from_documents(spark, sf_dir, "assessments", lambda path: assessor_xml.read_assessor(spark, path, "assessments")))


def assessment_search(spark, sf_dir):
    return shown(assessor_xml.filter_assessments(
        feed(spark, sf_dir, "raw_assessments"), *WINDOW
    ))


def index_files(spark, sf_dir):
    return shown(_from_documents(spark, sf_dir, "indices", lambda path: assessor_xml.read_assessor(spark, path, "indices")))


def index_search(spark, sf_dir):
    entries = feed(spark, sf_dir, "raw_indices").withColumn(
        "quote_approach", F.when(F.col("period_abs") == "P4", "Assessment").otherwise("Index")
    )
    return shown(assessor_xml.filter_indices(entries, *WINDOW))


def entry_counts(spark, sf_dir):
    counts = _from_documents(spark, sf_dir, "indices", lambda path: assessor_xml.entry_counts(spark, path))
    month = F.regexp_extract("file_path", r"indices_(\d{4}-\d{2})\.xml", 1)
    return shown(counts.withColumn("month", month).drop("file_path"))


def all_days(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    bounds = table(spark, sf_dir, "orders").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    return shown(coverage.days_between(bounds))


def _landed(spark, sf_dir):
    return feed(spark, sf_dir, "quote_keys").select(
        "pub_date", F.lower("hub").alias("hub"),
        F.when(F.col("slot") < 5, "spot").otherwise("derivatives").alias("product"),
    )


def missing_feeds(spark, sf_dir):
    landed = _landed(spark, sf_dir)
    bounds = landed.agg(F.min("pub_date").alias("first_day"), F.max("pub_date").alias("last_day"))
    expected = coverage.expected_feeds(coverage.days_between(bounds))
    return shown(coverage.feed_coverage(expected, landed))


def missing_feed_files(spark, sf_dir):
    """Days, hubs and products without a landed file, from the files that lie in the landing folders."""
    root = new_folder(spark, "landing")
    folder = landing.landing_path(root, "2024-01-31", "exchange")
    file_feeds.write_spot_files(spark, sf_dir, f"{folder}/spot")
    file_feeds.write_futures_files(spark, sf_dir, f"{folder}/futures")
    feeds = coverage.landed_exchange_feeds(landing.landed_files(spark, root, "exchange"))
    bounds = _landed(spark, sf_dir).agg(F.min("pub_date").alias("first_day"), F.max("pub_date").alias("last_day"))
    return shown(coverage.feed_coverage(coverage.expected_feeds(coverage.days_between(bounds)), feeds))


# --- loads -----------------------------------------------------------------------------------

def _loaded(spark, name, load) -> DataFrame:
    """Counters of a repeated load, with what its tables hold after both runs."""
    folder = new_folder(spark, f"{name}-warehouse")
    warehouse = jobs.Warehouse(f"{folder}/silver", f"{folder}/gold")
    load(warehouse)
    counters = load(warehouse)
    stored = report.stage_metrics(
        table_rows=tables.read_table(spark, warehouse.quotes(name)),
        quarantine_rows=tables.read_table(spark, warehouse.quarantine(name)),
    )
    return counters.unionByName(stored)


def load_internal(spark, sf_dir):
    path = new_folder(spark, "internal-landed")
    rows = by_year_start(feed(spark, sf_dir, "raw_internal"))
    rows.withColumn("last_update", F.col("last_update").cast("timestamp")).write.parquet(path)
    return _loaded(spark, "internal", lambda warehouse: jobs.load_internal(spark, path, warehouse))


def load_exchange(spark, sf_dir):
    path = new_folder(spark, "exchange-landed")
    file_feeds.write_spot_files(spark, sf_dir, f"{path}/spot")
    file_feeds.write_futures_files(spark, sf_dir, f"{path}/futures")
    folders = [f"{path}/spot", f"{path}/futures"]
    return _loaded(spark, "exchange", lambda warehouse: jobs.load_exchange(spark, folders, warehouse, EXCHANGE_SOURCE))


def load_assessor(spark, sf_dir):
    path = new_folder(spark, "assessor-landed")
    for kind, name in (("assessments", "raw_assessments"), ("indices", "raw_indices")):
        file_feeds.write_assessor_files(spark, sf_dir, kind, f"{path}/{kind}", by_year_start(feed(spark, sf_dir, name)))
    folders = [f"{path}/assessments", f"{path}/indices"]
    return _loaded(spark, "assessor", lambda warehouse: jobs.load_assessor(spark, folders, warehouse, ASSESSOR_SOURCE))


def by_year_start(rows: DataFrame) -> DataFrame:
    """The test tables are thin: quotes are published on the first day of their year, so that tables have few partitions."""
    kind = rows.schema["pub_date"].dataType.simpleString()
    return rows.withColumn("pub_date", F.trunc(F.col("pub_date").cast("date"), "year").cast(kind))


def load_incremental(spark, sf_dir):
    """Spot files land first, futures files a day later; each run of the job loads what is new."""
    folder = new_folder(spark, "incremental")
    warehouse = jobs.Warehouse(f"{folder}/silver", f"{folder}/gold")
    for day, write in (("2024-01-30", file_feeds.write_spot_files), ("2024-01-31", file_feeds.write_futures_files)):
        write(spark, sf_dir, landing.landing_path(f"{folder}/landing", day, "exchange"))
        jobs.load_new(spark, "exchange", f"{folder}/landing", warehouse, "exchange", EXCHANGE_SOURCE)
    return shown(tables.read_table(spark, warehouse.quotes("exchange")).select(*QUOTE_COLUMNS))


def rolling_window(spark, sf_dir):
    rows = feed(spark, sf_dir, "raw_internal")
    end = report.latest_pub_date(rows).scalar()
    return shown(coverage.rolling_window(rows, end))


# --- reference-data star ---------------------------------------------------------------------

def _definitions(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(FLOOR(p_partkey / 4) AS BIGINT) AS index_id",
        "CAST(p_partkey % 4 + 1 AS INT) AS index_version_id",
        "CASE WHEN p_size % 7 = 0 THEN 0 ELSE 1 END AS db_status",
        "CASE p_size % 3 WHEN 0 THEN 'NG_PNX_' WHEN 1 THEN 'NG_Esgm_' ELSE 'NG_OTHER_' END || p_brand AS index_name",
        "CAST(p_size % 25 AS INT) AS currency", "CAST(p_size % 5 AS INT) AS unit",
        "CAST(p_partkey % 25 AS INT) AS delivery_type",
    )


def latest_version(spark, sf_dir):
    return shown(refdata.latest_version(_definitions(spark, sf_dir)))


def internal_extract(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS id_number", "n_name AS name")
    units = table(spark, sf_dir, "region").selectExpr("r_regionkey AS unit_id", "r_name AS unit_label")
    sources = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id_number", "s_name AS name")
    prices = table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(FLOOR(l_partkey / 4) AS BIGINT) AS index_id", "l_suppkey AS ref_source",
        "CAST(l_shipdate AS DATE) AS reset_date",
        "CAST(l_shipdate + INTERVAL '1' DAY AS DATE) AS start_date",
        "l_extendedprice AS price", "l_shipdate AS last_update",
    )
    return shown(refdata.internal_extract(
        _definitions(spark, sf_dir), nation, units, prices, sources, nation, *EXTRACT_WINDOW
    ))


def _shown_quotes(build: Query) -> Query:
    return lambda spark, sf_dir: shown(build(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "internal_quotes": _shown_quotes(internal_quotes),
    "exchange_quotes": _shown_quotes(exchange_quotes),
    "assessor_quotes": _shown_quotes(assessor_quotes),
    **{
        f.__name__: f
        for f in (
            internal_location, internal_period, internal_publication, internal_units,
            curve_filter, relative_period_duration, month_ahead_end, invalid_dates, spot_rows,
            futures_rows, exchange_units, assessor_hubs, assessor_periods, index_descriptions,
            assessor_currency, parsed_prices, rolled_bom, price_keys, quarantined,
            combined_quotes, combined_quotes_distinct, quote_locations, quotes_partition_last,
            duplicate_flags, newest_per_key, inconsistent_quotes, inconsistent_detail,
            conflicting_curves, drop_conflicting_curves, zero_prices, price_stats, reconcile,
            reconcile_window, reconcile_from_one_view, comparison_in_order, unreconciled,
            generic_standard, generic_weekend, generic_index, generic_all_sorted, daily_report,
            match_stats_by_date, volume_by_publication, volume_by_match, stage_metrics,
            latest_pub_date, latest_pub_date_quotes, forward_curve, quotes_of_hub,
            spot_quotes_of_hub_and_day, first_quotes, first_mismatches, merge_newer_wins,
            merge_update_all, merge_insert_only, merge_changes, history_as_of, merge_into_table,
            merge_into_bucketed_table, match_stats_stored, merge_comparison_table, merge_report_table, overwrite_days, compacted_table,
            exported_report, exported_comparison, landed_internal, spot_files,
            spot_files_by_split, futures_files, futures_files_by_split, assessment_files,
            assessment_search, index_files, index_search, entry_counts, all_days, missing_feeds,
            missing_feed_files, load_internal, load_exchange, load_assessor, load_incremental,
            rolling_window, latest_version, internal_extract,
        )
    },
}
