"""Fixed values.

Everything in this module is a constant that has to be exactly as it is for the
results to be right: vocabulary of the quote suppliers, word lists, labels and
thresholds. No logic lives here.
"""

# --- labels stored in the canonical quote table -----------------------------
COMMODITY_RAW = "NatGas"
COMMODITY = "Natural Gas"
SPOT = "Spot"
FUTURES = "Futures"
EXCHANGE_PUBLICATION = "EEX"
ASSESSOR_PUBLICATION = "European Spot Gas Markets"
INTERNAL_DATA_SOURCE = "Endur Historical"
INTERNAL_SOURCE_MARK = "endur"  # lower-case mark inside data_source of internal quotes

# --- curves that are not quoted prices (matched anywhere in the name, any case)
UNQUOTED_CURVE_FRAGMENTS = [
    "Q1", "Q2", "Q3", "Q4", "avg", "av", "bid", "offer", "reu", "ecb", "4Q",
    "3Q", "2Q", "1Q", "legacy", "zzz", "r1", "r2", "r3", "r4", "r5", "r6", "r7",
    "2sah", "off", "s1", "s2", "s3", "s4", "sum", "win", "xng", "hols",
    "spread", "daily",
]
LEGACY_MARK = "legacy"

# --- delivery period words ---------------------------------------------------
WEEK_WORDS = ["bow", "wdnw"]
MONTH_WORDS = ["mah", "month", "months", "fm", "monthly"]
QUARTER_WORDS = ["quarter", "quarters", "qah", "q1", "q2", "q3", "q4"]
SEASON_WORDS = ["season", "seasons", "sah", "summer", "winter"]
GASYEAR_WORDS = ["gah", "gyah", "gasyear", "gy", "yearsgas", "gasyears"]
CALYEAR_WORDS = ["cal", "calyear", "year", "years", "yah", "calyears"]
DAY_WORDS = ["daily", "dah", "day", "days", "da", "eod", "egsi"]
WEEKEND_WORDS = ["weekend", "wsi", "wi", "wkd", "we", "wknd"]
GENERAL_PUBLICATION = "heren fin"
UNDETERMINED = "NA"

# --- relative period prefix -> duration --------------------------------------
RELATIVE_PERIOD_PREFIXES = [
    ("M", "Month"),
    ("Q", "Quarter"),
    ("S", "Season"),
    ("Y", "Year"),
    ("G", "Gasyear"),
    ("WKD", "Weekend"),
    ("D", "Day"),
]

# --- publications ------------------------------------------------------------
EXCHANGE_PUBLICATION_MARKS = ["PNX", "EEX", "POWERNEXT"]
ASSESSOR_PUBLICATION_MARK = "HEREN"
ASSESSOR_CURVE_MARK = "ESGM"
INDEX_CURVE_MARK = "_IND_"
INDEX_PRODUCTS = [
    ("MONTHCUM", "Monthly Cumulative Index"),
    ("D_MAH", "Daily Month Ahead Index"),
    ("MONTHLY", "Monthly Index"),
    ("DA+WSI", "Day Ahead Index and Weekend Spot Index"),
    ("DA+WI", "Day Ahead Index and Weekend Index"),
]
UNKNOWN_INDEX = "Non-identified Index"
CONTINENTAL_MARK = "CONT"
CONTINENTAL_ASSESSMENTS = "Continental Price Assessments"
ASSESSMENTS = "Price Assessments"
SETTLEMENT = "Settlement"
MONTH_AHEAD_INDEX = "Daily Month Ahead Index"
CONFLICT_CURVE_MARKS = ["MAH", "SAH", "QAH", "YAH"]
SOURCE_CURVE_MARKS = ["pnx", "esgm"]

# --- exchange files ----------------------------------------------------------
SPOT_FILE_PATTERN = "GasSpotMarketResults"
FUTURES_FILE_PATTERN = "GasFutureMarketResults"
RESULT_FILE_MARK = "MarketResults"
SPOT_CODES = ["ST", "SP", "IL"]
SPOT_HEADER_CODE = "ST"
FUTURES_CODE = "PR"
FUTURES_HEADER_LINE = 7  # zero-based physical line
FUTURES_OUT_OF_SCOPE = "otf"
FUTURES_REPEAT_PREFIX = "NR"
EXCHANGE_HUBS = ["the", "nbp", "peg", "ttf", "zee", "ztp"]
EXCHANGE_PRODUCTS = ["spot", "derivatives"]
PENCE_UNITS = ["GBP/thm", "p/thm"]
PENCE_UNIT = "GBp/therm"

# --- assessor files ----------------------------------------------------------
ASSESSMENT_FILE_MARK = "assessments"
INDEX_FILE_MARK = "indices"
ANNOUNCED_COUNT_TAG = "returned-count"
REQUEST_ROW_CAP = 100_000
ASSESSMENT_TAGS = {
    "commodity_type": "c_series.commodity.name",
    "src_last_update": "updated",
    "pub_date": "c_series-order",
    "price_mid": "mid",
    "price_offer": "assessment-high",
    "price_bid": "assessment-low",
    "start_date": "start-date",
    "end_date": "end-date",
    "period_abs": "period-label",
    "period_rel": "c_series.timeframe.name",
    "currency": "c_series.currency.name",
    "unit": "c_series.size-unit.name",
    "location_name": "c_series.location.name",
    "publication_name": "c_series.publication.name",
    "methodology": "c_series.methodology.name",
    "quote_approach": "c_series.quote-approach.name",
    "transaction_type": "c_series.transaction-type.name",
    "src_price_id": "id",
}
INDEX_TAGS = {
    "commodity_type": "c_series.commodity.name",
    "src_last_update": "updated",
    "pub_date": "c_series-order",
    "price_mid": "mid",
    "start_date": "start-date",
    "end_date": "end-date",
    "period_abs": "period-label",
    "currency": "c_series.currency.name",
    "unit": "c_series.size-unit.name",
    "location_name": "c_series.location.name",
    "publication_name": "c_series.publication.name",
    "src_price_id": "id",
}
ASSESSOR_HUB_NAMES = {
    "Zeebrugge": "ZEE",
    "Gaspool": "GPL",
    "Germany": "GER",
    "Slovakia": "SLO",
}
ASSESSOR_HUBS = [
    "AOC", "GPL", "NBP", "NCG", "PEG", "PSV", "SLO", "TTF", "VTP", "ZEE", "ZTP", "THE",
]
RELATIVE_PERIOD_CODES = [
    (" ", ""),
    ("+", "0"),
    ("Day-Ahead", "D01"),
    ("Weekend", "WKD"),
    ("Month", "M"),
    ("Quarter", "Q"),
    ("Season", "S"),
    ("Gasyear", "GY"),
    ("Year", "Y"),
]
INDEX_ID_WORDS = [
    "daily", "monthly", "cumulative", "index", "spot", "weekend", "day", "within",
    "ahead", "month",
]
INDEX_TYPE_WORDS = ["Spot", "Index", "Cumulative"]

# --- comparison --------------------------------------------------------------
MATCH = "True"
ROUNDING_MATCH = "True (rounding diff)"
MISMATCH = "False"
MATCH_DECIMALS = 6
MATCH_THRESHOLD = 0.00051
OLD_MATCH = "Match"
OLD_MISMATCH = "Mismatch"
OLD_MATCH_DECIMALS = 10
OLD_MATCH_THRESHOLD = 0.0005
DA_WSI_PRODUCT = "day ahead index and weekend spot index"
DA_WSI_PARTS = ["day ahead index", "weekend spot index"]

# --- retrieval ---------------------------------------------------------------
DAYS_TO_RETRIEVE = 20
