"""From supplier rows to canonical quotes: one lazy plan per supplier.

``*_rows`` functions return every row with its price key, complete or not, so that
``shaping.quarantine`` can show what is incomplete; ``normalize_*`` return the quotes.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotebridge import fixed_values as V
from quotebridge.functions import assessor as A
from quotebridge.functions import exchange as X
from quotebridge.functions import internal as I
from quotebridge.functions.prices import day_of, parse_price, price_key
from quotebridge.functions.text import value_map
from quotebridge.operators.dedupe import dedupe_quotes, newest_first
from quotebridge.operators.quality import drop_conflicting_curves
from quotebridge.operators.shaping import (
    to_canonical,
    union_present,
    valid_quotes,
    with_computed,
)
from quotebridge.schema import QUOTE
from quotebridge.sinks.staging import staged


def _holds(condition: Column) -> Column:
    """Condition with unknown counted as false."""
    return F.coalesce(condition, F.lit(False))


# --- trading system ------------------------------------------------------------------------

def with_texts(raw: DataFrame) -> DataFrame:
    """Raw rows with the prepared name columns of ``functions.internal.texts``."""
    return with_computed(raw, I.texts(F.col("publication"), F.col("index_name")))


def is_quoted_curve() -> Column:
    return ~I.is_unquoted_curve(F.col("curve_lower")) & ~I.is_legacy(F.col("pub_upper"))


def drop_unquoted_curves(prepared: DataFrame) -> DataFrame:
    """Drop curves that are not quoted prices and publications marked as legacy."""
    return prepared.filter(is_quoted_curve())


def internal_rows(raw: DataFrame) -> DataFrame:
    pub, curve = F.col("pub_upper"), F.col("curve_upper")
    currency = I.currency(F.col("currency"))
    repeated_day = F.col("pub_date") == F.col("end_date")
    quoted = drop_unquoted_curves(with_texts(raw))
    with_period = with_computed(
        quoted, {"period_duration": I.period(F.col("pub_words"), F.col("curve_words"))}
    ).filter(F.col("period_duration") != V.UNDETERMINED)
    described = with_computed(with_period, {
        "publication_name": I.publication_name(pub, curve),
        "product_type": I.product_type(pub, curve),
        "product_name": I.product_name(pub, curve),
        "location_name": I.location(F.col("hub")),
    })
    dated = with_computed(described, {
        "end_date": I.month_ahead_end(
            F.col("product_name"), F.col("pub_date"), F.col("end_date")
        ),
    }).filter(~_holds(repeated_day & (F.col("period_duration") != "Day")))
    quotes = dated.select(
        "publication_name",
        F.lit(V.INTERNAL_DATA_SOURCE).alias("data_source"),
        value_map(F.col("commodity"), {V.COMMODITY_RAW: V.COMMODITY}).alias("commodity_type"),
        "product_type",
        "product_name",
        "location_name",
        F.col("pub_date").cast("date").alias("pub_date"),
        F.lit("").alias("period_rel"),
        F.lit("").alias("period_abs"),
        "period_duration",
        F.lit(None).cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        F.lit(None).cast("double").alias("price_bid"),
        I.price_in_quoted_currency(F.col("price"), currency).alias("price_mid"),
        F.lit(None).cast("double").alias("price_offer"),
        currency.alias("currency"),
        I.unit(F.col("unit")).alias("unit"),
        F.col("last_update").cast("timestamp").alias("src_last_update"),
        F.col("index_name").alias("src_price_id"),
    )
    return with_computed(quotes, {"price_uk": price_key()})


def internal_quotes(quotes: DataFrame, drop_conflicts: bool = True) -> DataFrame:
    """Complete keyed rows to canonical quotes, unique on the price key.

    Conflicts are judged on the full-precision price, before it is stored in 32 bits.
    """
    if drop_conflicts:
        quotes = drop_conflicting_curves(quotes)
    return to_canonical(dedupe_quotes(quotes))


def normalize_internal(raw: DataFrame, drop_conflicts: bool = True) -> DataFrame:
    """Internal bronze rows to canonical quotes.

    The keyed rows are stored once before the conflict search, so the feed is read and its rules are
    evaluated once.
    """
    quotes = valid_quotes(internal_rows(raw))
    return internal_quotes(staged(quotes, "keyed") if drop_conflicts else quotes, drop_conflicts)


# --- exchange ------------------------------------------------------------------------------

def _exchange_dates() -> dict[str, Column]:
    return {
        "pub_date": day_of(F.col("pub_date")),
        "start_date": day_of(F.col("start_date")),
        "end_date": day_of(F.col("end_date")),
        "src_last_update": F.col("src_last_update").try_cast("timestamp"),
    }


#: What a judged line keeps of its file.
SOURCE = ["source_file", "source_line"]
OUT_OF_SCOPE, NO_PRICE, BAD_PRICE, BAD_LINE = "out of scope", "no price", "price", "line"
#: Lines that are left out in silence; the other reasons are reported.
RULED_OUT = [OUT_OF_SCOPE, NO_PRICE]


def _judged(lines: DataFrame, in_scope: Column, broken: Column) -> DataFrame:
    """Adds ``price`` and ``reason``: why a line gives no quote, null if it does."""
    priced = F.trim(F.coalesce("price_mid", F.lit(""))) != ""
    malformed = F.coalesce("malformed", F.lit(False)) if "malformed" in lines.columns else F.lit(False)
    reason = (
        F.when(~_holds(in_scope), OUT_OF_SCOPE)
        .when(priced & F.col("price").isNull(), BAD_PRICE)
        .when(broken | malformed, BAD_LINE)
        .when(~priced, NO_PRICE)
    )
    return with_computed(with_computed(lines, {"price": parse_price(F.col("price_mid"))}), {"reason": reason}).withColumns({
        c: F.lit(None).cast("string") for c in SOURCE if c not in lines.columns
    })


def judged_spot(lines: DataFrame) -> DataFrame:
    """Spot lines in exchange columns, with the reason why a line gives no quote."""
    rel = X.spot_period_rel(F.col("product_name"))
    broken = F.col("product_name").isNull() | F.col("end_date").isNull()
    return (
        _judged(lines, F.lit(True), broken)
        .withColumns(_exchange_dates())
        .select(
            F.lit(V.SPOT).alias("product_type"),
            X.spot_product(F.col("product_name")).alias("product_name"),
            "location_name",
            rel.alias("period_rel"),
            F.lit("").alias("period_abs"),
            X.spot_duration(rel).alias("period_duration"),
            "pub_date",
            "start_date",
            X.last_delivery_day(F.col("end_date")).alias("end_date"),
            F.col("price").alias("price_mid"),
            "price_unit",
            "src_last_update",
            "reason",
            *SOURCE,
        )
    )


def judged_futures(lines: DataFrame) -> DataFrame:
    """Settlement lines in exchange columns, with the reason why a line gives no quote."""
    product = F.col("product_name")
    in_scope = (
        (F.col("idx_code") == V.FUTURES_CODE)
        & ~_holds(F.lower(product).contains(V.FUTURES_OUT_OF_SCOPE))
        & ~_holds(product.startswith(V.FUTURES_REPEAT_PREFIX))
    )
    needed = [c for c in lines.columns if c not in ("price_mid", "malformed", "idx_code", *SOURCE)]
    broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in needed])
    return (
        _judged(lines, in_scope, broken)
        .withColumns(_exchange_dates())
        .select(
            F.lit(V.FUTURES).alias("product_type"),
            F.lit(V.SETTLEMENT).alias("product_name"),
            "location_name",
            F.lit("").alias("period_rel"),
            "period_abs",
            X.granularity(product).alias("period_duration"),
            "pub_date",
            "start_date",
            "end_date",
            F.col("price").alias("price_mid"),
            "price_unit",
            "src_last_update",
            "reason",
            *SOURCE,
        )
    )


def _accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).drop("reason", *SOURCE)


def normalize_spot(lines: DataFrame) -> DataFrame:
    """Priced spot lines in exchange columns; a text that is no number is no price."""
    return _accepted(judged_spot(lines))


def normalize_futures(lines: DataFrame) -> DataFrame:
    """Complete, in-scope settlement lines in exchange columns."""
    return _accepted(judged_futures(lines))


def unreadable(judged: DataFrame) -> DataFrame:
    """Judged lines in scope that hold a price text which is no number, or lack columns: file, line and reason."""
    return judged.filter(_holds(F.col("reason").isin(BAD_PRICE, BAD_LINE)))


EXCHANGE_ROW = T.StructType([
    T.StructField("product_type", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("period_rel", T.StringType()),
    T.StructField("period_abs", T.StringType()),
    T.StructField("period_duration", T.StringType()),
    T.StructField("pub_date", T.DateType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("price_mid", T.DoubleType()),
    T.StructField("price_unit", T.StringType()),
    T.StructField("src_last_update", T.TimestampType()),
])


def exchange_rows(
    spark: SparkSession, spot: DataFrame | None, futures: DataFrame | None, data_source: str
) -> DataFrame:
    """Spot and/or futures lines, whichever landed, with key and canonical columns."""
    both = union_present(
        spark,
        [
            None if spot is None else normalize_spot(spot),
            None if futures is None else normalize_futures(futures),
        ],
        EXCHANGE_ROW,
    )
    return to_canonical(_with_units(both, data_source))


def _with_units(rows: DataFrame, data_source: str) -> DataFrame:
    units = with_computed(rows, {
        "currency": X.currency(F.col("price_unit")),
        "unit": X.unit(F.col("price_unit")),
    })
    return units.withColumns({
        "publication_name": F.lit(V.EXCHANGE_PUBLICATION),
        "data_source": F.lit(data_source),
        "commodity_type": F.lit(V.COMMODITY),
        "src_price_id": F.lit(""),
    })


def judged_exchange(spot: DataFrame, futures: DataFrame, data_source: str) -> DataFrame:
    """All spot and futures lines with key and canonical columns, ``reason`` and what they came from."""
    judged = _with_units(judged_spot(spot).unionByName(judged_futures(futures)), data_source)
    return to_canonical(judged, ["reason", *SOURCE])


def normalize_exchange(
    spark: SparkSession, spot: DataFrame | None, futures: DataFrame | None, data_source: str
) -> DataFrame:
    """Exchange lines to canonical quotes, newest per price key."""
    return dedupe_quotes(valid_quotes(exchange_rows(spark, spot, futures, data_source)))


# --- price-reporting agency ----------------------------------------------------------------

def clean_locations(entries: DataFrame) -> DataFrame:
    """Short hub codes; hubs outside the list are dropped."""
    return entries.withColumn("location_name", A.hub(F.col("location_name"))).filter(
        F.col("location_name").isin(V.ASSESSOR_HUBS)
    )


def drop_rolled_bom(quotes: DataFrame) -> DataFrame:
    return quotes.filter(
        ~_holds(
            A.is_rolled_balance_of_month(
                F.col("period_abs"), F.col("pub_date"), F.col("end_date")
            )
        )
    )


def normalize_assessments(entries: DataFrame) -> DataFrame:
    timeframe = F.col("period_rel")
    approach = F.col("quote_approach")
    return clean_locations(entries).withColumns({
        "product_type": F.col("transaction_type"),
        "product_name": F.when(approach.contains("Assessment"), V.ASSESSMENTS).otherwise(approach),
        "period_duration": A.duration(timeframe),
        "period_rel": A.relative_period(timeframe),
        "kind": F.lit(0),
    }).drop("transaction_type", "quote_approach", "methodology")


def normalize_indices(entries: DataFrame) -> DataFrame:
    words = F.col("index_words")
    described = with_computed(
        clean_locations(entries), {"index_words": A.index_words(F.col("src_price_id"))}
    )
    return described.withColumns({
        "product_type": F.lit(V.SPOT),
        "product_name": A.index_product(words),
        "period_duration": A.index_duration(words),
        "period_rel": A.index_period_rel(words),
        "price_bid": F.lit(None).cast("string"),
        "price_offer": F.lit(None).cast("string"),
        "kind": F.lit(1),
    }).drop("index_words")


def assessor_rows(assessments: DataFrame, indices: DataFrame, data_source: str) -> DataFrame:
    both = normalize_assessments(assessments).unionByName(
        normalize_indices(indices), allowMissingColumns=True
    )
    typed = with_computed(both, {
        "price_bid": parse_price(F.col("price_bid")),
        "price_mid": parse_price(F.col("price_mid")),
        "price_offer": parse_price(F.col("price_offer")),
        "currency": A.currency(F.col("currency")),
        "pub_date": day_of(F.col("pub_date")),
        "start_date": day_of(F.col("start_date")),
        "end_date": day_of(F.col("end_date")),
        "src_last_update": F.col("src_last_update").try_cast("timestamp"),
        "data_source": F.lit(data_source),
    })
    return with_computed(drop_rolled_bom(typed), {"price_uk": price_key()})


def assessor_quotes(quotes: DataFrame) -> DataFrame:
    """Complete keyed rows to canonical quotes, one per key."""
    return to_canonical(dedupe_quotes(quotes, order=[F.col("kind").asc(), *newest_first()]))


def normalize_assessor(assessments: DataFrame, indices: DataFrame, data_source: str) -> DataFrame:
    """Assessor entries to canonical quotes.

    One quote per key: assessments before indices, then newest, then smallest source id.
    """
    return assessor_quotes(valid_quotes(assessor_rows(assessments, indices, data_source)))


def empty_quotes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], QUOTE)
