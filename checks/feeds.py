"""Supplier feeds derived from ``lineitem`` in SQL that Spark and DuckDB both run.

Every feed uses every row of the table: rows differ in what they say, none is left out. Prices
are whole ten-thousandths, so no rounding rule of either engine meets a tie.
"""

from pyspark.sql import DataFrame, SparkSession

from quotebridge.sinks.staging import new_folder

QUOTE_KEYS = """
SELECT k.*,
  CASE hub_ix WHEN 0 THEN 'NBP' WHEN 1 THEN 'TTF' WHEN 2 THEN 'PEG' WHEN 3 THEN 'ZEE' WHEN 4 THEN 'GPL' ELSE 'ZTP' END AS hub,
  CAST((1000 + (day_ix % 97) * 10 + hub_ix * 37) * 100 AS INT) AS base_e4,
  CASE l_orderkey % 20 WHEN 1 THEN 3 WHEN 2 THEN 500 ELSE 0 END AS shift_e4
FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_returnflag, l_shipdate,
    CAST(l_shipdate AS DATE) AS pub_date,
    CAST(l_suppkey % 6 AS INT) AS hub_ix, CAST(l_partkey % 10 AS INT) AS slot,
    CAST(EXTRACT(YEAR FROM l_shipdate) * 372 + EXTRACT(MONTH FROM l_shipdate) * 31 + EXTRACT(DAY FROM l_shipdate) AS INT) AS day_ix
  FROM {lineitem}
) k
"""

# Internal bronze rows. Hub 0 is quoted in pounds. Slot 8 holds curves to be removed, slot 6
# repeats the publication day as delivery end, hubs 3 to 5 of slots 3 and 6 carry conflicts; some
# prices are zero.
RAW_INTERNAL = """
SELECT commodity, index_name, publication, pub_date, end_date,
  CASE WHEN hub_ix = 0 THEN CAST(price_e4 AS DOUBLE) / CAST(1000000 AS DOUBLE) ELSE CAST(price_e4 AS DOUBLE) / CAST(10000 AS DOUBLE) END AS price,
  CASE WHEN hub_ix = 0 THEN 'GBP' ELSE 'EUR' END AS currency,
  CASE WHEN hub_ix = 0 THEN 'Therms' ELSE 'MWh' END AS unit,
  l_shipdate + INTERVAL '1' HOUR * l_linenumber AS last_update
FROM (
  SELECT k.*, 'NatGas' AS commodity,
    CASE slot WHEN 0 THEN 'NG_PNX_' || curve_hub || '.EOD' WHEN 1 THEN 'NG_PNX_' || curve_hub || '.EGSI'
      WHEN 2 THEN 'NG_PNX_' || curve_hub || '.FM' WHEN 3 THEN 'NG_PNX_' || curve_hub || '.QAH'
      WHEN 4 THEN 'NG_ESGM_' || curve_hub || CASE WHEN l_orderkey % 31 = 0 THEN '_CONT_DA' ELSE '_DA' END
      WHEN 5 THEN 'NG_ESGM_' || curve_hub || CASE WHEN l_orderkey % 29 = 0 THEN '_IND_DA+WI' ELSE '_IND_DA+WSI' END
      WHEN 6 THEN 'NG_ESGM_' || curve_hub || '_IND_D_MAH'
      WHEN 7 THEN 'NG_ESGM_' || curve_hub || CASE l_orderkey % 5 WHEN 1 THEN '_IND_MONTHLY' WHEN 2 THEN '_IND_OTHER' ELSE '_IND_MONTHCUM' END
      WHEN 8 THEN 'NG_ESGM_' || curve_hub || CASE l_orderkey % 3 WHEN 0 THEN '_BID' WHEN 1 THEN '_Avg' ELSE '_WIN21' END
      ELSE 'NG_ESGM_' || curve_hub || '_WKD' END AS index_name,
    CASE slot WHEN 0 THEN CASE WHEN l_orderkey % 37 = 0 THEN 'PNX EOD Legacy' ELSE 'PNX EOD' END WHEN 1 THEN 'EEX EGSI'
      WHEN 2 THEN CASE WHEN l_orderkey % 41 = 0 THEN 'Powernext Other' WHEN l_orderkey % 7 = 1 THEN 'PNX Season' WHEN l_orderkey % 7 = 2 THEN 'PNX Year'
        WHEN l_orderkey % 7 = 3 THEN 'PNX Gasyear' ELSE 'PNX Month' END WHEN 3 THEN 'PNX Quarter'
      WHEN 6 THEN 'Heren Monthly' WHEN 7 THEN 'Heren_Month' WHEN 9 THEN CASE WHEN l_orderkey % 43 = 0 THEN 'Heren BOW' ELSE 'Heren Weekend' END
      ELSE 'Heren Fin' END AS publication,
    CASE WHEN slot = 6 THEN pub_date ELSE CAST(pub_date + INTERVAL '1' DAY AS DATE) END AS end_date,
    CASE WHEN l_orderkey % 71 = 5 AND slot NOT IN (3, 6) THEN 0 ELSE base_e4 + slot * 1100 + CASE WHEN slot IN (3, 6) AND hub_ix < 3 THEN 0 ELSE shift_e4 END END AS price_e4
  FROM (
    SELECT k.*, CASE hub_ix WHEN 2 THEN 'PEG NORD' WHEN 3 THEN CASE WHEN slot < 4 THEN 'ZBH' ELSE 'ZEEHUB' END WHEN 4 THEN 'GASPOOL' ELSE hub END AS curve_hub
    FROM quote_keys k
  ) k
) r
"""

_COMMA_PRICE = (
    "CAST(CAST(FLOOR(price_e4 / 10000) AS INT) AS STRING) || '{sep}' ||"
    " LPAD(CAST(price_e4 % 10000 AS STRING), 4, '0')"
)

# Spot lines: some hubs hold the '/' that parts the key, some prices are no number.
# Published hub: every fifth key is quoted for another hub, so both sides keep unmatched rows.
_PUBLISHED_HUB = "CASE WHEN (day_ix + hub_ix + slot) % 5 = 0 THEN 'THE' ELSE hub END"

RAW_SPOT = f"""
SELECT CASE WHEN day_ix % 2 = 0 THEN 'SP' ELSE 'IL' END AS idx_code, location_name, product_name,
  CAST(CAST(pub_date + INTERVAL '1' DAY AS DATE) AS STRING) AS start_date,
  CAST(CAST(pub_date + INTERVAL '2' DAY AS DATE) AS STRING) AS end_date,
  CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 73 = 0 THEN 'n/a' ELSE {_COMMA_PRICE.format(sep=',')} END AS price_mid,
  CASE WHEN hub_ix <> 0 THEN 'EUR/MWh' WHEN day_ix % 2 = 0 THEN 'GBP/thm' ELSE 'p/thm' END AS price_unit,
  CAST(pub_date AS STRING) AS pub_date,
  CAST(pub_date AS STRING) || ' 1' || CAST(l_linenumber AS STRING) || ':30:00' AS src_last_update
FROM (
  SELECT k.*, CASE WHEN l_orderkey % 59 = 0 THEN hub || '/X' ELSE {_PUBLISHED_HUB} END AS location_name,
    CASE slot % 4 WHEN 0 THEN hub || ' DAY AHEAD' WHEN 1 THEN hub || ' WEEKEND' WHEN 2 THEN 'EGSI ' || hub || ' DAY AHEAD' ELSE 'EGSI WEEKEND' END AS product_name,
    base_e4 + CASE WHEN slot % 4 >= 2 THEN 1100 ELSE 0 END + CASE WHEN l_orderkey % 61 = 0 THEN 7 ELSE 0 END AS price_e4
  FROM quote_keys k
) r
"""

RAW_FUTURES = f"""
SELECT CASE WHEN l_orderkey % 19 = 0 THEN 'OT' ELSE 'PR' END AS idx_code,
  CASE WHEN l_orderkey % 47 = 0 THEN 'EEX OTF ' || location_name || ' ' || gran || ' Futures'
    WHEN l_orderkey % 53 = 0 THEN 'NR EEX ' || location_name || ' ' || gran || ' Futures'
    ELSE 'EEX ' || location_name || ' Natural Gas ' || gran || ' Futures' END AS product_name,
  SUBSTRING(CAST(pub_date AS STRING), 1, 7) AS period_abs,
  CAST(pub_date AS STRING) AS start_date,
  CAST(CAST(pub_date + INTERVAL '1' DAY AS DATE) AS STRING) AS end_date,
  CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE {_COMMA_PRICE.format(sep=',')} END AS price_mid,
  CASE WHEN hub_ix <> 0 THEN 'EUR/MWh' ELSE 'GBP/thm' END AS price_unit,
  CAST(pub_date AS STRING) AS pub_date,
  CAST(pub_date AS STRING) || ' 1' || CAST(l_linenumber AS STRING) || ':45:00' AS src_last_update,
  location_name
FROM (
  SELECT k.*, {_PUBLISHED_HUB} AS location_name,
    CASE slot % 4 WHEN 0 THEN 'Month' WHEN 1 THEN 'Quarter' WHEN 2 THEN 'Season' ELSE 'Year' END AS gran,
    base_e4 + 2200 + (slot % 4) * 1100 + CASE WHEN l_orderkey % 61 = 0 THEN 7 ELSE 0 END AS price_e4
  FROM quote_keys k
) r
"""

_ASSESSOR_HUB = (
    "CASE WHEN (day_ix + hub_ix + slot) % 5 = 0 THEN CASE day_ix % 3 WHEN 0 THEN 'Germany' WHEN 1 THEN 'Slovakia' ELSE 'THE' END"
    " WHEN hub = 'ZEE' THEN 'Zeebrugge' WHEN hub = 'GPL' THEN 'Gaspool' ELSE hub END"
)

RAW_ASSESSMENTS = f"""
SELECT 'Natural Gas' AS commodity_type,
  CAST(pub_date AS STRING) || 'T1' || CAST(l_linenumber AS STRING) || ':00:00Z' AS src_last_update,
  CAST(pub_date AS STRING) AS pub_date,
  {_COMMA_PRICE.format(sep='.')} AS price_mid,
  {_COMMA_PRICE.format(sep='.').replace('price_e4', '(price_e4 + 250)')} AS price_offer,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE {_COMMA_PRICE.format(sep='.').replace('price_e4', '(price_e4 - 250)')} END AS price_bid,
  CAST(CAST(pub_date + INTERVAL '1' DAY AS DATE) AS STRING) AS start_date,
  CAST(CASE WHEN slot <> 3 THEN CAST(pub_date + INTERVAL '1' DAY AS DATE)
    WHEN l_orderkey % 4 = 0 THEN last_day(CAST(pub_date + INTERVAL '1' MONTH AS DATE)) ELSE last_day(pub_date) END AS STRING) AS end_date,
  CASE WHEN slot = 3 THEN 'BOM' ELSE 'P' || CAST(slot AS STRING) END AS period_abs,
  CASE slot WHEN 0 THEN 'Day-Ahead' WHEN 1 THEN 'Weekend' WHEN 2 THEN 'Month +1' WHEN 3 THEN 'BOM' WHEN 4 THEN 'Day-Ahead'
    WHEN 5 THEN 'WDNW' WHEN 6 THEN 'Quarter +2' WHEN 7 THEN 'Season +1' WHEN 8 THEN 'Month +10' ELSE 'Gasyear +1' END AS period_rel,
  CASE WHEN hub_ix = 0 THEN 'Pence Sterling' ELSE 'Euro' END AS currency,
  CASE WHEN hub_ix = 0 THEN 'therm' ELSE 'MWh' END AS unit,
  {_ASSESSOR_HUB} AS location_name,
  'European Spot Gas Markets' AS publication_name,
  'Price Assessment' AS methodology,
  CASE WHEN l_orderkey % 67 = 0 THEN 'Midpoint' ELSE 'Assessment' END AS quote_approach,
  'Spot' AS transaction_type,
  'http://quotes/item/' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) ||
    CASE l_orderkey % 11 WHEN 0 THEN '?a=1&b=<2>' WHEN 1 THEN '&lt;&#38;&#9999999;' WHEN 2 THEN ']] ünd €' ELSE '' END AS src_price_id
FROM (
  SELECT k.*, base_e4 + CASE WHEN slot IN (0, 4) THEN 4400 WHEN slot = 1 THEN 9900 ELSE slot * 1100 END AS price_e4
  FROM quote_keys k
) r
"""

RAW_INDICES = f"""
SELECT 'Natural Gas' AS commodity_type,
  CAST(pub_date AS STRING) || 'T1' || CAST(l_linenumber AS STRING) || ':15:00Z' AS src_last_update,
  CAST(pub_date AS STRING) AS pub_date,
  {_COMMA_PRICE.format(sep='.')} AS price_mid,
  CAST(CAST(pub_date + INTERVAL '1' DAY AS DATE) AS STRING) AS start_date,
  CAST(CASE WHEN slot IN (2, 7) THEN last_day(CAST(pub_date + INTERVAL '1' MONTH AS DATE)) ELSE CAST(pub_date + INTERVAL '1' DAY AS DATE) END AS STRING) AS end_date,
  'P' || CAST(slot AS STRING) AS period_abs,
  CASE WHEN hub_ix = 0 THEN 'Pence Sterling' ELSE 'Euro' END AS currency,
  CASE WHEN hub_ix = 0 THEN 'therm' ELSE 'MWh' END AS unit,
  {_ASSESSOR_HUB} AS location_name,
  'European Spot Gas Markets' AS publication_name,
  'http://quotes/index/' || CAST(l_orderkey AS STRING) || '/' || lower(hub) || CASE slot WHEN 0 THEN '-day-ahead-index' WHEN 1 THEN '-weekend-spot-index'
    WHEN 2 THEN '-daily-month-ahead-index' WHEN 3 THEN '-monthly-cumulative-index' WHEN 4 THEN '-within-day-index' WHEN 5 THEN '-day-ahead-index'
    WHEN 6 THEN '-weekend-spot-index' WHEN 7 THEN '-daily-month-ahead-index' WHEN 8 THEN '-monthly-cumulative-index' ELSE '-daily-index' END AS src_price_id
FROM (
  SELECT k.*, base_e4 + CASE WHEN slot IN (0, 1, 5, 6) THEN 5500 WHEN slot IN (2, 7) THEN 6600 WHEN slot IN (3, 8) THEN 7700 ELSE slot * 1100 END AS price_e4
  FROM quote_keys k
) r
"""

FEEDS = {
    "quote_keys": QUOTE_KEYS,
    "raw_internal": RAW_INTERNAL,
    "raw_spot": RAW_SPOT,
    "raw_futures": RAW_FUTURES,
    "raw_assessments": RAW_ASSESSMENTS,
    "raw_indices": RAW_INDICES,
}


_LANDED: dict[tuple[str, str, str], str] = {}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived feed as a plan over the whole ``lineitem`` table."""
    keys = spark.sql(QUOTE_KEYS, lineitem=table(spark, sf_dir, "lineitem"))
    if name == "quote_keys":
        return keys
    return spark.sql(f"WITH quote_keys AS (SELECT * FROM {{keys}}) {FEEDS[name]}", keys=keys)


def _spread(rows: DataFrame) -> DataFrame:
    """One small test file would be read by one task; rows that more tasks read are not moved."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if 2 * rows._jdf.queryExecution().toRdd().getNumPartitions() < cores else rows


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return (spark.sparkContext.applicationId, sf_dir, name)


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived feed as landed parquet, written once per session and data directory.

    The pipelines start from landed files, so their scans show real pruning and pushdown.
    """
    key = _key(spark, sf_dir, name)
    if key not in _LANDED:
        path = new_folder(spark, name)
        _spread(derived(spark, sf_dir, name)).write.parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def feed_once(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same rows for a plan that reads them once: as landed, or else straight from the table, so that nothing is written first."""
    return feed(spark, sf_dir, name) if _key(spark, sf_dir, name) in _LANDED else _spread(derived(spark, sf_dir, name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
