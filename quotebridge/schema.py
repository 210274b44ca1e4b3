"""Schemas of the three layers and the column lists derived from them.

Column names and order are the required output of the tables.
"""

from pyspark.sql import types as T

RAW_INTERNAL = T.StructType([
    T.StructField("commodity", T.StringType(), False),
    T.StructField("index_name", T.StringType(), False),
    T.StructField("publication", T.StringType(), False),
    T.StructField("pub_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), False),
    T.StructField("price", T.DoubleType(), False),
    T.StructField("currency", T.StringType(), False),
    T.StructField("unit", T.StringType(), False),
    T.StructField("last_update", T.TimestampType(), False),
])

QUOTE = T.StructType([
    T.StructField("price_uk", T.StringType(), False),
    T.StructField("publication_name", T.StringType(), False),
    T.StructField("data_source", T.StringType(), False),
    T.StructField("commodity_type", T.StringType(), False),
    T.StructField("product_type", T.StringType(), False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("location_name", T.StringType(), False),
    T.StructField("pub_date", T.DateType(), False),
    T.StructField("period_rel", T.StringType(), True),
    T.StructField("period_abs", T.StringType(), True),
    T.StructField("period_duration", T.StringType(), True),
    T.StructField("start_date", T.DateType(), True),
    T.StructField("end_date", T.DateType(), False),
    T.StructField("price_bid", T.FloatType(), True),
    T.StructField("price_mid", T.FloatType(), True),
    T.StructField("price_offer", T.FloatType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("unit", T.StringType(), True),
    T.StructField("src_last_update", T.TimestampType(), False),
    T.StructField("src_price_id", T.StringType(), True),
])

QUOTE_COLUMNS = QUOTE.fieldNames()
REQUIRED_QUOTE_COLUMNS = [f.name for f in QUOTE if not f.nullable]

# The ten parts of the unique price key, in key order.
KEY_PARTS = [
    "publication_name", "commodity_type", "product_type", "product_name", "location_name",
    "pub_date", "period_duration", "end_date", "currency", "unit",
]

COMPARISON_COLUMNS = [
    "pub_date", "publication_name", "commodity_type", "product_type", "product_name",
    "location_name", "period_duration", "price_end_date", "endur_mid_price", "ext_mid_price",
    "mid_price_diff", "price_match", "endur_curve", "unit", "currency", "endur_price_uk",
    "ext_price_uk",
]
PAIR_KEY = ["endur_price_uk", "ext_price_uk"]

# The report's day is a text, as in the exported file; a declared schema keeps it one.
REPORT = T.StructType([
    T.StructField("no_prices_compared", T.LongType()),
    T.StructField("no_price_matches", T.LongType()),
    T.StructField("no_price_matches_with_rounding_diff", T.LongType()),
    T.StructField("no_price_mismatches", T.LongType()),
    T.StructField("comparison_date", T.StringType()),
])
