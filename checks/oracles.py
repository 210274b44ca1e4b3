"""The same results in plain SQL for DuckDB, written without looking at the Spark plans.

Building blocks are named sub-selects; ``_sql`` puts the ones a query needs in front of it.
"""

import re

from checks.feeds import FEEDS
from checks.queries import ASSESSOR_SOURCE, EXCHANGE_SOURCE, EXTRACT_WINDOW, RUN_TS, WINDOW
from quotebridge import fixed_values as V
from quotebridge.schema import QUOTE_COLUMNS


def _list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _in(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_KEY = (
    "publication_name || '/' || commodity_type || '/' || product_type || '/' || product_name || '/' || location_name || '/' ||"
    " CAST(pub_date AS VARCHAR) || '/' || period_duration || '/' || CAST(end_date AS VARCHAR) || '/' || currency || '/' || unit"
)
_NEWEST = ", ".join(
    ["src_last_update DESC NULLS LAST"]
    + [f"{c} ASC NULLS FIRST" for c in ("src_price_id", "price_mid", "start_date", "period_rel", "period_abs", "price_bid", "price_offer", "data_source")]
)
_REQUIRED = [
    "price_uk", "publication_name", "data_source", "commodity_type", "product_type", "product_name",
    "location_name", "pub_date", "end_date", "src_last_update",
]
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _REQUIRED)

# --- vocabulary ------------------------------------------------------------------------------


def _location(curve):
    hub = f"string_split(string_split({curve}, '_')[3], '.')[1]"
    return (
        f"CASE WHEN upper({hub}) IN ('ZBH', 'ZEEHUB') THEN 'ZEE' WHEN upper({hub}) = 'GASPOOL' THEN 'GPL'"
        f" WHEN length({hub}) > 3 AND upper({hub}) LIKE '%PEG%' THEN 'PEG' ELSE {hub} END"
    )


def _words(text):
    return f"string_split(regexp_replace(lower({text}), '[_+.-]', ' ', 'g'), ' ')"


def _period(pub, curve):
    long = [
        ("Week", V.WEEK_WORDS), ("Month", V.MONTH_WORDS), ("Quarter", V.QUARTER_WORDS),
        ("Season", V.SEASON_WORDS), ("Gasyear", V.GASYEAR_WORDS), ("Year", V.CALYEAR_WORDS),
    ]
    short = [("Day", V.DAY_WORDS), ("Weekend", V.WEEKEND_WORDS)]

    def cases(text, pairs, default):
        whens = " ".join(f"WHEN list_has_any({_words(text)}, {_list(w)}) THEN '{p}'" for p, w in pairs)
        return f"CASE {whens} ELSE '{default}' END"

    return (
        f"CASE WHEN regexp_replace(lower({pub}), '[_+.-]', ' ', 'g') LIKE '%heren fin%'"
        f" THEN {cases(curve, long, 'Day')} ELSE {cases(pub, long + short, 'NA')} END"
    )


_EXCH = "(upper({p}) LIKE '%PNX%' OR upper({p}) LIKE '%EEX%' OR upper({p}) LIKE '%POWERNEXT%')"
_ASSR = "(upper({p}) LIKE '%HEREN%' OR upper({c}) LIKE '%ESGM%')"


def _pub_name(p, c):
    return f"CASE WHEN {_EXCH.format(p=p)} THEN 'EEX' WHEN {_ASSR.format(p=p, c=c)} THEN 'European Spot Gas Markets' END"


def _prod_name(p, c):
    return (
        f"CASE WHEN {_EXCH.format(p=p)} THEN CASE WHEN upper({p}) LIKE '%EOD%' THEN 'EOD' WHEN upper({p}) LIKE '%EGSI%' THEN 'EGSI' ELSE 'Settlement' END"
        f" WHEN {_ASSR.format(p=p, c=c)} THEN CASE WHEN contains(upper({c}), '_IND_') THEN"
        f" CASE WHEN contains(upper({c}), 'MONTHCUM') THEN 'Monthly Cumulative Index' WHEN contains(upper({c}), 'D_MAH') THEN 'Daily Month Ahead Index'"
        f" WHEN contains(upper({c}), 'MONTHLY') THEN 'Monthly Index' WHEN contains(upper({c}), 'DA+WSI') THEN 'Day Ahead Index and Weekend Spot Index'"
        f" WHEN contains(upper({c}), 'DA+WI') THEN 'Day Ahead Index and Weekend Index' ELSE 'Non-identified Index' END"
        f" WHEN contains(upper({c}), 'CONT') THEN 'Continental Price Assessments' ELSE 'Price Assessments' END END"
    )


def _prod_type(p, c):
    return (
        f"CASE WHEN {_EXCH.format(p=p)} THEN CASE WHEN upper({p}) LIKE '%EOD%' OR upper({p}) LIKE '%EGSI%' THEN 'Spot' ELSE 'Futures' END"
        f" WHEN {_ASSR.format(p=p, c=c)} THEN 'Spot' END"
    )


_UNQUOTED = " OR ".join(f"contains(lower(index_name), '{f.lower()}')" for f in V.UNQUOTED_CURVE_FRAGMENTS)
_NEXT_MONTH_END = "last_day(CAST({d} + INTERVAL 1 MONTH AS DATE))"


def _fixed_end(product):
    return f"CASE WHEN contains({product}, 'Daily Month Ahead Index') AND pub_date = end_date THEN {_NEXT_MONTH_END.format(d='pub_date')} ELSE end_date END"


def _number(text):
    return f"round_even(TRY_CAST(replace({text}, ',', '.') AS DOUBLE), 4)"


_RELATIVE = (
    "regexp_replace(CASE WHEN contains({t}, 'BOM') THEN 'M00' ELSE"
    " replace(replace(replace(replace(replace(replace(replace(replace(replace({t}, ' ', ''), '+', '0'), 'Day-Ahead', 'D01'), 'Weekend', 'WKD'),"
    " 'Month', 'M'), 'Quarter', 'Q'), 'Season', 'S'), 'Gasyear', 'GY'), 'Year', 'Y') END, '0(..)$', '\\1')"
)
_DURATION = "CASE WHEN contains({t}, 'Month') THEN 'Month' WHEN contains({t}, 'WDNW') THEN 'Week' ELSE string_split(string_split({t}, ' ')[1], '-')[1] END"
_INDEX_WORDS = (
    "list_transform(list_filter(string_split(string_split(src_price_id, '/')[-1], '-'), lambda w: list_contains("
    + _list(V.INDEX_ID_WORDS) + ", w)), lambda w: upper(w[1]) || w[2:])"
)
_INDEX_NAME = (
    "array_to_string(list_filter(words, lambda w: w NOT IN ('Spot', 'Index', 'Cumulative')), ' ') || ' ' ||"
    " CASE WHEN list_contains(words, 'Spot') THEN 'Spot Index' WHEN list_contains(words, 'Cumulative') THEN 'Cumulative Index' ELSE 'Index' END"
)
_TEXT = "array_to_string(words, ' ')"
_INDEX_DURATION = f"CASE WHEN contains({_TEXT}, 'Month') THEN 'Month' WHEN contains({_TEXT}, 'Weekend') THEN 'Weekend' WHEN contains({_TEXT}, 'Day') THEN 'Day' END"
_INDEX_REL = (
    f"CASE WHEN contains({_TEXT}, 'Month') THEN 'M01' WHEN contains({_TEXT}, 'Weekend') THEN 'WKD' WHEN contains({_TEXT}, 'Day')"
    f" THEN CASE WHEN contains({_TEXT}, 'Within') THEN 'D00' ELSE 'D01' END END"
)
_HUB = "CASE location_name WHEN 'Zeebrugge' THEN 'ZEE' WHEN 'Gaspool' THEN 'GPL' WHEN 'Germany' THEN 'GER' WHEN 'Slovakia' THEN 'SLO' ELSE location_name END"
_CCY = "CASE WHEN contains(currency, 'Pence') THEN 'GBp' WHEN contains(currency, 'Euro') THEN 'EUR' ELSE currency END"
_EXCH_UNIT = "CASE WHEN price_unit IN ('GBP/thm', 'p/thm') THEN 'GBp/therm' ELSE price_unit END"

_FLOAT = "CAST({c} AS FLOAT) AS {c}"
_QUOTE = ", ".join(_FLOAT.format(c=c) if c in ("price_bid", "price_mid", "price_offer") else c for c in QUOTE_COLUMNS)

_PARTS = {name: sql.format(lineitem="lineitem") for name, sql in FEEDS.items()}
_PARTS |= {
    "internal_kept": f"SELECT * FROM raw_internal WHERE NOT ({_UNQUOTED}) AND NOT contains(lower(publication), 'legacy')",
    "internal_named": f"""
        SELECT {_pub_name('publication', 'index_name')} AS publication_name, 'Endur Historical' AS data_source,
          CASE commodity WHEN 'NatGas' THEN 'Natural Gas' ELSE commodity END AS commodity_type,
          {_prod_type('publication', 'index_name')} AS product_type, {_prod_name('publication', 'index_name')} AS product_name,
          {_location('index_name')} AS location_name, pub_date, '' AS period_rel, '' AS period_abs,
          {_period('publication', 'index_name')} AS period_duration, CAST(NULL AS DATE) AS start_date, end_date,
          CAST(NULL AS DOUBLE) AS price_bid, CASE WHEN currency LIKE '%GBP%' OR currency = 'GBp' THEN price * 100 ELSE price END AS price_mid,
          CAST(NULL AS DOUBLE) AS price_offer, CASE WHEN currency LIKE '%GBP%' THEN 'GBp' ELSE currency END AS currency,
          CASE WHEN lower(unit) LIKE '%therm%' THEN 'therm' ELSE unit END AS unit, last_update AS src_last_update, index_name AS src_price_id
        FROM internal_kept""",
    "internal_rows": f"""
        SELECT *, {_KEY} AS price_uk FROM (SELECT * REPLACE ({_fixed_end('product_name')} AS end_date) FROM internal_named WHERE period_duration <> 'NA')
        WHERE NOT (pub_date = end_date AND period_duration <> 'Day')""",
    "internal_valid": f"SELECT * FROM internal_rows WHERE {_COMPLETE}",
    "conflict_keys": "SELECT price_uk FROM internal_valid GROUP BY price_uk HAVING count(*) > 1 AND min(price_mid) <> max(price_mid)",
    "conflict_curves": """
        SELECT DISTINCT src_price_id FROM internal_valid
        WHERE price_uk IN (SELECT price_uk FROM conflict_keys) AND (src_price_id LIKE '%MAH%' OR src_price_id LIKE '%SAH%' OR src_price_id LIKE '%QAH%' OR src_price_id LIKE '%YAH%')""",
    "internal_quotes": f"""
        SELECT {_QUOTE} FROM internal_valid WHERE src_price_id NOT IN (SELECT src_price_id FROM conflict_curves)
        QUALIFY row_number() OVER (PARTITION BY price_uk ORDER BY {_NEWEST}) = 1""",
    "spot_rows": f"""
        SELECT 'Spot' AS product_type, CASE WHEN product_name LIKE '%EGSI%' THEN 'EGSI' ELSE 'EOD' END AS product_name, location_name,
          CASE WHEN product_name LIKE '%WEEKEND%' THEN 'WKD' ELSE 'DA01' END AS period_rel, '' AS period_abs,
          CASE WHEN product_name LIKE '%WEEKEND%' THEN 'Weekend' ELSE 'Day' END AS period_duration,
          CAST(pub_date AS DATE) AS pub_date, CAST(start_date AS DATE) AS start_date, CAST(CAST(end_date AS DATE) - INTERVAL 1 DAY AS DATE) AS end_date,
          {_number('price_mid')} AS price_mid, price_unit, CAST(src_last_update AS TIMESTAMP) AS src_last_update
        FROM raw_spot WHERE {_number('price_mid')} IS NOT NULL""",
    "futures_rows": f"""
        SELECT 'Futures' AS product_type, 'Settlement' AS product_name, location_name, '' AS period_rel, period_abs,
          string_split(product_name, ' ')[-2] AS period_duration,
          CAST(pub_date AS DATE) AS pub_date, CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date,
          {_number('price_mid')} AS price_mid, price_unit, CAST(src_last_update AS TIMESTAMP) AS src_last_update
        FROM raw_futures WHERE price_mid IS NOT NULL AND idx_code = 'PR' AND NOT contains(lower(product_name), 'otf') AND NOT starts_with(product_name, 'NR')""",
    "exchange_rows": f"""
        SELECT {_QUOTE} FROM (SELECT *, {_KEY} AS price_uk FROM (
          SELECT *, 'EEX' AS publication_name, '{EXCHANGE_SOURCE}' AS data_source, 'Natural Gas' AS commodity_type, NULL AS price_bid, NULL AS price_offer, '' AS src_price_id,
            string_split({_EXCH_UNIT}, '/')[1] AS currency, string_split({_EXCH_UNIT}, '/')[2] AS unit
          FROM (SELECT * FROM spot_rows UNION ALL BY NAME SELECT * FROM futures_rows)))""",
    "exchange_valid": f"SELECT * FROM exchange_rows WHERE {_COMPLETE} AND NOT contains(location_name, '/')",
    "exchange_quotes": f"SELECT * FROM exchange_valid QUALIFY row_number() OVER (PARTITION BY price_uk ORDER BY {_NEWEST}) = 1",
    "exchange_newest": f"SELECT * FROM exchange_rows QUALIFY row_number() OVER (PARTITION BY price_uk ORDER BY {_NEWEST}) = 1",
    "assessment_rows": f"""
        SELECT commodity_type, src_last_update, pub_date, price_mid, price_offer, price_bid, start_date, end_date, period_abs, {_RELATIVE.format(t='period_rel')} AS period_rel,
          currency, unit, {_HUB} AS location_name, publication_name, src_price_id, transaction_type AS product_type,
          CASE WHEN contains(quote_approach, 'Assessment') THEN 'Price Assessments' ELSE quote_approach END AS product_name, {_DURATION.format(t='period_rel')} AS period_duration, 0 AS kind
        FROM raw_assessments""",
    "index_rows": f"""
        SELECT commodity_type, src_last_update, pub_date, price_mid, CAST(NULL AS VARCHAR) AS price_offer, CAST(NULL AS VARCHAR) AS price_bid, start_date, end_date, period_abs, {_INDEX_REL} AS period_rel,
          currency, unit, {_HUB} AS location_name, publication_name, src_price_id, 'Spot' AS product_type, {_INDEX_NAME} AS product_name, {_INDEX_DURATION} AS period_duration, 1 AS kind
        FROM (SELECT *, {_INDEX_WORDS} AS words FROM raw_indices)""",
    "assessor_rows": f"""
        SELECT *, {_KEY} AS price_uk FROM (
          SELECT * REPLACE (CAST(replace(replace(src_last_update, 'T', ' '), 'Z', '') AS TIMESTAMP) AS src_last_update, CAST(pub_date AS DATE) AS pub_date, CAST(start_date AS DATE) AS start_date,
            CAST(end_date AS DATE) AS end_date, {_number('price_mid')} AS price_mid, {_number('price_offer')} AS price_offer, {_number('price_bid')} AS price_bid, {_CCY} AS currency),
            '{ASSESSOR_SOURCE}' AS data_source
          FROM (SELECT * FROM assessment_rows UNION ALL BY NAME SELECT * FROM index_rows) WHERE location_name IN {_in(V.ASSESSOR_HUBS)})
        WHERE NOT (period_abs = 'BOM' AND date_trunc('month', pub_date) < date_trunc('month', end_date))""",
    "assessor_valid": f"SELECT * FROM assessor_rows WHERE {_COMPLETE}",
    "assessor_quotes": f"SELECT {_QUOTE} FROM assessor_valid QUALIFY row_number() OVER (PARTITION BY price_uk ORDER BY kind, {_NEWEST}) = 1",
    "published": "SELECT * FROM exchange_quotes UNION ALL BY NAME SELECT * FROM assessor_quotes",
    "every_quote": "SELECT * FROM internal_quotes UNION ALL BY NAME SELECT * FROM published",
}



def _over(prefix: str, raw: dict[str, str]) -> None:
    """The same parts over other raw feeds: each part that depends on one of them, again under a prefix."""
    changed = dict(raw)
    again = True
    while again:
        again = False
        for name, sql in list(_PARTS.items()):
            if name not in changed and any(re.search(rf"\b(FROM|JOIN)\s+{c}\b", sql) for c in changed):
                changed[name] = sql
                again = True
    for name, sql in changed.items():
        if name not in raw:
            sql = re.sub(r"\b(FROM|JOIN)(\s+)(\w+)\b", lambda m: f"{m[1]}{m[2]}{prefix}{m[3]}" if m[3] in changed else m[0], sql)
        _PARTS[prefix + name] = sql


_YEAR_START = "substring(CAST(pub_date AS VARCHAR), 1, 4) || '-01-01'"
# As files: what a file says of itself holds for its lines, which are those of one year.
_over("f_", {
    "raw_spot": f"SELECT * REPLACE ({_YEAR_START} AS pub_date, {_YEAR_START} || ' 18:00:00' AS src_last_update) FROM raw_spot",
    "raw_futures": f"SELECT * REPLACE ({_YEAR_START} AS pub_date, {_YEAR_START} || ' 18:45:00' AS src_last_update) FROM raw_futures",
})
# As loads: published on the first day of the year.
_over("l_", {
    "raw_internal": f"SELECT * REPLACE (CAST({_YEAR_START} AS DATE) AS pub_date) FROM raw_internal",
    "raw_assessments": f"SELECT * REPLACE ({_YEAR_START} AS pub_date) FROM raw_assessments",
    "raw_indices": f"SELECT * REPLACE ({_YEAR_START} AS pub_date) FROM raw_indices",
})
_PARTS["short_lines"] = (
    f"SELECT DISTINCT 'SP' AS idx_code, 'short' AS location_name, {_YEAR_START} AS pub_date, {_YEAR_START} || ' 18:00:00' AS src_last_update,"
    " replace(location_name, '/', '-') AS hub, 1 AS malformed FROM raw_spot"
)

# --- comparison: the three joins written out, then one row per pair -----------------------------

_CLASS = (
    "CASE WHEN round(abs(CAST(i.price_mid AS DOUBLE) - CAST(x.price_mid AS DOUBLE)), 6) = 0 THEN 'True'"
    " WHEN round(abs(CAST(i.price_mid AS DOUBLE) - CAST(x.price_mid AS DOUBLE)), 6) <= CAST(0.00051 AS DOUBLE) THEN 'True (rounding diff)' ELSE 'False' END"
)


def _rule_select(rule, rank, decimals):
    return (
        "SELECT i.pub_date, i.publication_name, i.commodity_type, i.product_type, i.product_name, i.location_name, i.period_duration, i.end_date AS price_end_date,"
        " round(CAST(i.price_mid AS DOUBLE), 6) AS endur_mid_price, x.price_mid AS ext_mid_price,"
        f" round(abs(CAST(i.price_mid AS DOUBLE) - CAST(x.price_mid AS DOUBLE)), {decimals}) AS mid_price_diff, {_CLASS} AS price_match,"
        f" i.src_price_id AS endur_curve, i.unit, i.currency, i.price_uk AS endur_price_uk, x.price_uk AS ext_price_uk, '{rule}' AS rule, {rank} AS rule_rank"
        " FROM every_quote i JOIN every_quote x"
    )


_SIDES = "lower(i.data_source) LIKE '%endur%' AND lower(x.data_source) NOT LIKE '%endur%'"
_EIGHT = " AND ".join(f"i.{c} = x.{c}" for c in (
    "pub_date", "publication_name", "commodity_type", "product_type", "location_name", "unit", "currency", "end_date"))
_PARTS |= {
    "rule_general": f"{_rule_select('general', 1, 5)} ON i.price_uk = x.price_uk WHERE {_SIDES}",
    "rule_weekend": f"{_rule_select('weekend', 2, 6)} ON {_EIGHT} AND i.product_name = x.product_name WHERE {_SIDES} AND lower(i.period_duration) IN ('day', 'weekend') AND lower(x.period_duration) = 'weekend'",
    "rule_da_wsi": f"{_rule_select('da_wsi', 3, 6)} ON {_EIGHT} WHERE {_SIDES} AND lower(i.product_name) = 'day ahead index and weekend spot index' AND lower(x.product_name) IN ('day ahead index', 'weekend spot index')",
    "compared": """
        SELECT * EXCLUDE (rule_rank) FROM (SELECT * FROM rule_general UNION ALL SELECT * FROM rule_weekend UNION ALL SELECT * FROM rule_da_wsi)
        QUALIFY row_number() OVER (PARTITION BY endur_price_uk, ext_price_uk ORDER BY rule_rank) = 1""",
    "compared_run": f"SELECT * EXCLUDE (rule), CAST('{RUN_TS}' AS TIMESTAMP) AS comparison_date FROM compared",
}

_GENERIC_NINE = " AND ".join(f"a.{c} = b.{c}" for c in (
    "publication_name", "pub_date", "commodity_type", "product_type", "product_name", "location_name", "end_date", "unit", "currency"))


def _generic(extra):
    return (
        "SELECT a.pub_date, a.publication_name, a.commodity_type, a.product_type, a.product_name, a.location_name, a.period_duration, a.end_date,"
        " b.price_mid AS endur_price_mid, a.price_mid AS ext_price_mid, round(abs(CAST(a.price_mid AS DOUBLE) - CAST(b.price_mid AS DOUBLE)), 10) AS price_mid_diff_abs,"
        " b.src_price_id AS endur_curve, a.data_source AS ds_ext, b.data_source AS ds_int, a.price_uk AS ext_price_uk, b.price_uk AS endur_price_uk,"
        " CASE WHEN round(abs(CAST(a.price_mid AS DOUBLE) - CAST(b.price_mid AS DOUBLE)), 10) > CAST(0.0005 AS DOUBLE) THEN 'Mismatch' ELSE 'Match' END AS price_comparison"
        f" FROM every_quote a JOIN every_quote b ON {_GENERIC_NINE} AND a.data_source NOT LIKE b.data_source WHERE lower(a.data_source) NOT LIKE '%endur%' AND {extra}"
    )


_PARTS |= {
    "generic_standard": _generic("a.period_duration = b.period_duration AND lower(a.period_duration) NOT LIKE 'weekend'"),
    "generic_weekend": _generic("lower(a.period_duration) LIKE 'weekend' AND lower(b.period_duration) LIKE 'day'"),
    "generic_index": _generic("lower(a.product_name) LIKE '%index%'"),
    "generic_all": "SELECT * FROM generic_standard UNION ALL SELECT * FROM generic_weekend UNION ALL SELECT * FROM generic_index",
}

# --- upserts ---------------------------------------------------------------------------------

_PARTS |= {
    "merge_target": "SELECT * FROM exchange_quotes",
    "merge_source": """
        SELECT * REPLACE (CAST(price_mid + CAST(1 AS FLOAT) AS FLOAT) AS price_mid, src_last_update + INTERVAL 1 HOUR * (day(pub_date) % 3 - 1) AS src_last_update,
          CASE WHEN day(pub_date) % 7 = 0 THEN price_uk || '/new' ELSE price_uk END AS price_uk) FROM merge_target""",
}


def _merged(take_source):
    columns = ", ".join(f"CASE WHEN {take_source} THEN s.{c} ELSE t.{c} END AS {c}" for c in QUOTE_COLUMNS)
    return f"SELECT {columns} FROM merge_target t FULL OUTER JOIN merge_source s ON t.price_uk = s.price_uk"


_PARTS |= {
    "merged_newer": _merged("t.price_uk IS NULL OR (s.price_uk IS NOT NULL AND t.src_last_update < s.src_last_update)"),
    "merged_all": _merged("s.price_uk IS NOT NULL"),
    "merged_insert": _merged("t.price_uk IS NULL"),
    "definitions": """
        SELECT CAST(floor(p_partkey / 4) AS BIGINT) AS index_id, CAST(p_partkey % 4 + 1 AS INT) AS index_version_id, CASE WHEN p_size % 7 = 0 THEN 0 ELSE 1 END AS db_status,
          CASE p_size % 3 WHEN 0 THEN 'NG_PNX_' WHEN 1 THEN 'NG_Esgm_' ELSE 'NG_OTHER_' END || p_brand AS index_name,
          CAST(p_size % 25 AS INT) AS currency, CAST(p_size % 5 AS INT) AS unit, CAST(p_partkey % 25 AS INT) AS delivery_type FROM part""",
    "landed_feeds": "SELECT DISTINCT pub_date, lower(hub) AS hub, CASE WHEN slot < 5 THEN 'spot' ELSE 'derivatives' END AS product FROM quote_keys",
}


def _sql(select):
    """Prefix a select with the parts it uses, directly or through other parts."""
    needed: list[str] = []

    def visit(text):
        for name in _PARTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(_PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_PARTS[n]})" for n in needed) + f"\n{select}"


def _shown(source, dates=(), stamps=(), floats=(), flags=(), columns="*"):
    """Dates and timestamps as text, floating values as rounded doubles."""
    changed = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    changed += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in stamps]
    changed += [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in floats]
    changed += [f"CAST({c} AS INT) AS {c}" for c in flags]
    return _sql(f"SELECT {columns} REPLACE ({', '.join(changed)}) FROM {source}")


_QUOTE_SHOWN = {
    "dates": ("pub_date", "start_date", "end_date"),
    "stamps": ("src_last_update",),
    "floats": ("price_bid", "price_mid", "price_offer"),
}


def _quotes(source):
    return _shown(source, **_QUOTE_SHOWN)


_COMPARED_SHOWN = {
    "dates": ("pub_date", "price_end_date"),
    "floats": ("endur_mid_price", "ext_mid_price", "mid_price_diff"),
}
_GENERIC_SHOWN = {
    "dates": ("pub_date", "end_date"),
    "floats": ("endur_price_mid", "ext_price_mid", "price_mid_diff_abs"),
}
_EXCHANGE_SHOWN = {
    "dates": ("pub_date", "start_date", "end_date"), "stamps": ("src_last_update",), "floats": ("price_mid",),
}
_COUNTS = (
    "CAST(count(*) AS BIGINT) AS {total}, count(*) FILTER (price_match = 'True') AS {match}, count(*) FILTER (price_match = 'True (rounding diff)') AS {rounding},"
    " count(*) FILTER (price_match = 'False') AS {mismatch}"
)


def _tally(select, group):
    return _sql(f"SELECT {select}, count(*) AS no_rows {group}")


_REPORT = _sql(
    "SELECT strftime(max(comparison_date), '%Y-%m-%d') AS comparison_date, "
    + _COUNTS.format(total="no_prices_compared", match="no_price_matches", rounding="no_price_matches_with_rounding_diff", mismatch="no_price_mismatches")
    + " FROM compared_run HAVING count(*) > 0"
)
_BY_DATE = (
    "SELECT CAST(pub_date AS VARCHAR) AS pub_date, "
    + _COUNTS.format(total="total_prices", match="price_match", rounding="price_rounding_diff", mismatch="price_mismatch")
    + " FROM compared GROUP BY compared.pub_date"
)
_WINDOW = f"BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'"
_CODE = _RELATIVE.format(t="period_rel")
_SPOT_FILES = _sql(
    "SELECT *, 0 AS malformed FROM f_raw_spot UNION ALL BY NAME SELECT * EXCLUDE (hub), NULL AS product_name, NULL AS start_date, NULL AS end_date, NULL AS price_mid,"
    " NULL AS price_unit FROM short_lines"
)
_FUTURES_FILES = _sql("SELECT *, 0 AS malformed FROM f_raw_futures")


def _counters(loaded: str, unreadable: str, rows: str, valid: str, stored: str) -> str:
    """Rows of each step, and from them the counters of a load; what is unreadable is part of what is quarantined."""
    return _sql(
        f"SELECT unnest(['loaded', 'ruled_out', 'unreadable', 'quarantined', 'duplicates', 'stored', 'table_rows', 'quarantine_rows']) AS stage,"
        " unnest([loaded, loaded - unreadable - rows, unreadable, unreadable + rows - valid, valid - stored, stored, stored, unreadable + rows - valid]) AS no_rows"
        f" FROM (SELECT ({loaded})::BIGINT AS loaded, ({unreadable})::BIGINT AS unreadable, (SELECT count(*) FROM {rows}) AS rows,"
        f" (SELECT count(*) FROM {valid}) AS valid, (SELECT count(*) FROM {stored}) AS stored)"
    )


ORACLES = {
    "internal_quotes": _quotes("internal_quotes"),
    "exchange_quotes": _quotes("exchange_quotes"),
    "assessor_quotes": _quotes("assessor_quotes"),
    "internal_location": _tally(f"index_name, {_location('index_name')} AS location_name", "FROM raw_internal GROUP BY ALL"),
    "internal_period": _tally(f"publication, index_name, {_period('publication', 'index_name')} AS period_duration", "FROM raw_internal GROUP BY ALL"),
    "internal_publication": _tally(
        f"publication, index_name, {_pub_name('publication', 'index_name')} AS publication_name, {_prod_name('publication', 'index_name')} AS product_name,"
        f" {_prod_type('publication', 'index_name')} AS product_type", "FROM raw_internal GROUP BY ALL"),
    "internal_units": _sql(
        "SELECT index_name, currency_out, unit_out, round(min(price_mid), 6) AS min_price, round(max(price_mid), 6) AS max_price, count(*) AS no_rows FROM ("
        "SELECT index_name, CASE WHEN contains(currency, 'GBP') THEN 'GBp' ELSE currency END AS currency_out, CASE WHEN contains(lower(unit), 'therm') THEN 'therm' ELSE unit END AS unit_out,"
        " CASE WHEN contains(currency, 'GBP') THEN price * 100 ELSE price END AS price_mid FROM raw_internal) GROUP BY ALL"),
    "curve_filter": _tally("index_name, publication", "FROM internal_kept GROUP BY ALL"),
    "relative_period_duration": _sql(
        "SELECT period_rel, CASE WHEN starts_with(period_rel, 'M') THEN 'Month' WHEN starts_with(period_rel, 'Q') THEN 'Quarter' WHEN starts_with(period_rel, 'S') THEN 'Season'"
        " WHEN starts_with(period_rel, 'Y') THEN 'Year' WHEN starts_with(period_rel, 'G') THEN 'Gasyear' WHEN starts_with(period_rel, 'WKD') THEN 'Weekend'"
        f" WHEN starts_with(period_rel, 'D') THEN 'Day' ELSE period_rel END AS duration, count(*) AS no_rows FROM (SELECT {_CODE} AS period_rel FROM raw_assessments) GROUP BY ALL"),
    "month_ahead_end": _sql(
        f"SELECT product_name, CAST(pub_date AS VARCHAR) AS pub_date, CAST(end_date AS VARCHAR) AS end_date, CAST({_fixed_end('product_name')} AS VARCHAR) AS fixed_end_date, count(*) AS no_rows"
        f" FROM (SELECT {_prod_name('publication', 'index_name')} AS product_name, pub_date, end_date FROM raw_internal) t GROUP BY t.product_name, t.pub_date, t.end_date"),
    "invalid_dates": _sql("SELECT period_duration, CAST(pub_date AS VARCHAR) AS pub_date, CAST(end_date AS VARCHAR) AS end_date, count(*) AS no_rows FROM internal_rows GROUP BY ALL"),
    "spot_rows": _shown("spot_rows", **_EXCHANGE_SHOWN),
    "futures_rows": _shown("futures_rows", **_EXCHANGE_SHOWN),
    "exchange_units": _tally(f"price_unit, string_split({_EXCH_UNIT}, '/')[1] AS currency, string_split({_EXCH_UNIT}, '/')[2] AS unit", "FROM raw_spot GROUP BY ALL"),
    "assessor_hubs": _sql(f"SELECT location_name, count(*) AS no_rows FROM (SELECT {_HUB} AS location_name FROM raw_assessments) WHERE location_name IN {_in(V.ASSESSOR_HUBS)} GROUP BY ALL"),
    "assessor_periods": _tally(f"period_rel AS timeframe, {_DURATION.format(t='period_rel')} AS period_duration, {_CODE} AS period_code", "FROM raw_assessments GROUP BY ALL"),
    "index_descriptions": _sql(
        f"SELECT src_price_id, {_INDEX_NAME} AS product_name, {_INDEX_DURATION} AS period_duration, {_INDEX_REL} AS period_rel, pub_date, src_last_update"
        f" FROM (SELECT *, {_INDEX_WORDS} AS words FROM raw_indices)"),
    "assessor_currency": _tally(f"currency AS currency_name, {_CCY} AS currency_code", "FROM raw_indices GROUP BY ALL"),
    "parsed_prices": _tally(f"price_bid, round({_number('price_bid')}, 6) AS bid, price_offer, round({_number('price_offer')}, 6) AS offer", "FROM raw_assessments GROUP BY ALL"),
    "rolled_bom": _tally(
        "period_abs, pub_date, end_date",
        "FROM raw_assessments WHERE NOT (period_abs = 'BOM' AND substring(pub_date, 1, 7) < substring(end_date, 1, 7)) GROUP BY ALL"),
    "price_keys": _sql("SELECT price_uk, src_price_id, period_duration FROM assessor_rows"),
    "quarantined": _sql(
        "SELECT src_price_id, product_name, location_name, CAST(pub_date AS VARCHAR) AS pub_date, concat_ws(',', "
        + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _REQUIRED) + f") AS missing_fields FROM assessor_rows WHERE NOT ({_COMPLETE})"),
    "combined_quotes": _quotes("every_quote"),
    "combined_quotes_distinct": _quotes("(SELECT * FROM exchange_rows UNION SELECT * FROM exchange_rows)"),
    "quote_locations": _sql("SELECT DISTINCT location_name FROM every_quote"),
    "quotes_partition_last": _quotes("exchange_quotes"),
    "duplicate_flags": _sql(
        "SELECT price_uk, src_price_id, round(price_mid, 6) AS price_mid, strftime(src_last_update, '%Y-%m-%d %H:%M:%S') AS src_last_update,"
        f" CASE WHEN count(*) OVER (PARTITION BY price_uk) > 1 THEN 1 ELSE 0 END AS is_duplicate, CASE WHEN row_number() OVER (PARTITION BY price_uk ORDER BY {_NEWEST}) > 1 THEN 1 ELSE 0 END AS is_repeat"
        " FROM internal_valid"),
    "newest_per_key": _quotes("exchange_newest"),
    "inconsistent_quotes": _sql(
        "SELECT price_uk, round(min(price_mid), 6) AS min_price, round(max(price_mid), 6) AS max_price, count(*) AS no_prices FROM internal_valid"
        " GROUP BY price_uk HAVING count(*) > 1 AND min(internal_valid.price_mid) <> max(internal_valid.price_mid)"),
    "inconsistent_detail": _sql(
        "SELECT price_uk, src_price_id, product_name, CAST(pub_date AS VARCHAR) AS pub_date, CAST(end_date AS VARCHAR) AS end_date, round(t.price_mid, 6) AS price_mid, count(*) AS no_prices"
        " FROM internal_valid t WHERE price_uk IN (SELECT price_uk FROM conflict_keys) GROUP BY price_uk, src_price_id, product_name, t.pub_date, t.end_date, t.price_mid"),
    "conflicting_curves": _sql("SELECT src_price_id FROM conflict_curves"),
    "drop_conflicting_curves": _sql(
        "SELECT src_price_id, CAST(pub_date AS VARCHAR) AS pub_date, count(*) AS no_rows FROM internal_valid"
        " WHERE src_price_id NOT IN (SELECT src_price_id FROM conflict_curves) GROUP BY ALL"),
    "zero_prices": _sql("SELECT price_uk, src_price_id FROM internal_quotes WHERE price_mid = 0 ORDER BY src_price_id, price_uk"),
    "price_stats": _sql(
        "SELECT currency, unit, round(CAST(min(price_mid) AS DOUBLE), 6) AS min_price, round(CAST(max(price_mid) AS DOUBLE), 6) AS max_price, round(avg(CAST(price_mid AS DOUBLE)), 6) AS avg_price"
        " FROM internal_quotes GROUP BY ALL"),
    "reconcile": _shown("compared", **_COMPARED_SHOWN),
    "reconcile_window": _shown(f"compared WHERE pub_date {_WINDOW}", columns="* EXCLUDE (rule)", **_COMPARED_SHOWN),
    "reconcile_from_one_view": _tally("rule, price_match", "FROM compared GROUP BY ALL"),
    "comparison_in_order": _shown("compared_run", stamps=("comparison_date",), **_COMPARED_SHOWN),
    "unreconciled": _quotes("internal_quotes WHERE price_uk NOT IN (SELECT endur_price_uk FROM compared)"),
    "generic_standard": _shown("generic_standard", **_GENERIC_SHOWN),
    "generic_weekend": _shown("generic_weekend", **_GENERIC_SHOWN),
    "generic_index": _shown("generic_index", **_GENERIC_SHOWN),
    "generic_all_sorted": _shown("generic_all", **_GENERIC_SHOWN),
    "daily_report": _REPORT,
    "match_stats_by_date": _sql(_BY_DATE),
    "volume_by_publication": _sql(
        "SELECT CAST(pub_date AS VARCHAR) AS publication_date, publication_name, count(*) AS number_of_prices FROM compared GROUP BY ALL ORDER BY publication_date, publication_name"),
    "volume_by_match": _sql("SELECT CAST(pub_date AS VARCHAR) AS publication_date, price_match, count(*) AS number_of_prices FROM compared GROUP BY ALL"),
    "stage_metrics": _sql(
        "SELECT 'loaded' AS stage, count(*) AS no_rows FROM raw_internal UNION ALL SELECT 'quoted_curves', count(*) FROM internal_kept"
        " UNION ALL SELECT 'priced', count(*) FROM internal_rows UNION ALL SELECT 'stored', count(*) FROM internal_quotes"),
    "latest_pub_date": _sql("SELECT CAST(max(pub_date) AS VARCHAR) AS pub_date FROM assessor_quotes"),
    "latest_pub_date_quotes": _quotes("assessor_quotes WHERE pub_date = (SELECT max(pub_date) FROM assessor_quotes)"),
    "forward_curve": _sql(
        "SELECT location_name, period_rel, CAST(end_date AS VARCHAR) AS end_date, round(avg(CAST(price_mid AS DOUBLE)), 6) AS avg_price FROM assessor_quotes"
        " WHERE pub_date = (SELECT max(pub_date) FROM assessor_quotes) GROUP BY location_name, period_rel, assessor_quotes.end_date HAVING location_name = 'NBP'"),
    "quotes_of_hub": _quotes("internal_quotes WHERE location_name = 'NBP' ORDER BY internal_quotes.pub_date, price_uk LIMIT 5"),
    "spot_quotes_of_hub_and_day": _quotes("exchange_quotes WHERE location_name = 'TTF' AND product_type = 'Spot' AND exchange_quotes.pub_date = DATE '1998-03-02'"),
    "first_quotes": _quotes("assessor_quotes ORDER BY price_uk LIMIT 10"),
    "first_mismatches": _shown(
        "compared_run WHERE price_match = 'False' ORDER BY endur_price_uk, ext_price_uk LIMIT 10", stamps=("comparison_date",), **_COMPARED_SHOWN),
    "merge_newer_wins": _quotes("merged_newer"),
    "merge_update_all": _quotes("merged_all"),
    "merge_insert_only": _quotes("merged_insert"),
    "merge_changes": _quotes(
        "(SELECT s.* FROM merge_source s LEFT JOIN merge_target t ON t.price_uk = s.price_uk WHERE t.price_uk IS NULL OR t.src_last_update < s.src_last_update)"),
    "history_as_of": _shown(
        "(SELECT * EXCLUDE (version) FROM (SELECT *, 1 AS version FROM compared_run UNION ALL SELECT * REPLACE ('True' AS price_match), 2 + day(pub_date) % 3 AS version FROM compared_run)"
        " WHERE version <= 3 QUALIFY row_number() OVER (PARTITION BY endur_price_uk, ext_price_uk ORDER BY version DESC) = 1) h WHERE price_match = 'False'",
        stamps=("comparison_date",), **_COMPARED_SHOWN),
    "merge_into_table": _quotes("merged_newer"),
    "merge_into_bucketed_table": _quotes("merged_newer"),
    "match_stats_stored": _sql(_BY_DATE.replace(
        "FROM compared ", "FROM (SELECT * REPLACE (CASE WHEN year(pub_date) BETWEEN 1994 AND 1995 THEN 'True' ELSE price_match END AS price_match) FROM compared) AS compared ")),
    "merge_comparison_table": _shown("(SELECT * REPLACE (price_match || ' again' AS price_match) FROM compared_run)", stamps=("comparison_date",), **_COMPARED_SHOWN),
    "merge_report_table": _sql(_BY_DATE),
    "overwrite_days": _quotes("(SELECT * REPLACE (CASE WHEN month(pub_date) <= 6 THEN 'new' ELSE period_rel END AS period_rel) FROM internal_quotes)"),
    "compacted_table": _quotes("internal_quotes"),
    "exported_report": _REPORT,
    "exported_comparison": _shown("compared_run", stamps=("comparison_date",), **_COMPARED_SHOWN),
    "landed_internal": _sql(
        "SELECT commodity, index_name, publication, CAST(pub_date AS VARCHAR) AS pub_date, CAST(end_date AS VARCHAR) AS end_date, round(price, 6) AS price, currency, unit,"
        " strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update, '2024-01-31' AS ingest_date FROM raw_internal"),
    "spot_files": _SPOT_FILES,
    "spot_files_by_split": _SPOT_FILES,
    "futures_files": _FUTURES_FILES,
    "futures_files_by_split": _FUTURES_FILES,
    "assessment_files": _sql("SELECT * FROM raw_assessments"),
    "assessment_search": _sql(f"SELECT * FROM raw_assessments WHERE CAST(pub_date AS DATE) {_WINDOW} AND quote_approach LIKE '%Assessment%' AND methodology LIKE '%Assessment%'"),
    "index_files": _sql("SELECT * FROM raw_indices"),
    "index_search": _sql(f"SELECT *, 'Index' AS quote_approach FROM raw_indices WHERE CAST(pub_date AS DATE) {_WINDOW} AND period_abs <> 'P4'"),
    "entry_counts": _sql("SELECT substring(pub_date, 1, 7) AS month, count(*) AS announced, count(*) AS parsed, CASE WHEN count(*) >= 100000 THEN 1 ELSE 0 END AS at_cap FROM raw_indices GROUP BY substring(pub_date, 1, 7)"),
    "all_days": "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS pub_date FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)",
    "missing_feeds": _sql(
        "SELECT CAST(e.pub_date AS VARCHAR) AS pub_date, e.hub, e.product FROM (SELECT CAST(d AS DATE) AS pub_date, hub, product FROM"
        " (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem)"
        f" CROSS JOIN (SELECT unnest({_list(V.EXCHANGE_HUBS)}) AS hub) CROSS JOIN (SELECT unnest({_list(V.EXCHANGE_PRODUCTS)}) AS product)) e"
        " LEFT JOIN landed_feeds l ON l.pub_date = e.pub_date AND l.hub = e.hub AND l.product = e.product WHERE l.hub IS NULL"),
    "missing_feed_files": _sql(
        "SELECT CAST(e.pub_date AS VARCHAR) AS pub_date, e.hub, e.product FROM (SELECT CAST(d AS DATE) AS pub_date, hub, product FROM"
        " (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem)"
        f" CROSS JOIN (SELECT unnest({_list(V.EXCHANGE_HUBS)}) AS hub) CROSS JOIN (SELECT unnest({_list(V.EXCHANGE_PRODUCTS)}) AS product)) e"
        " LEFT JOIN (SELECT DISTINCT CAST(pub_date AS DATE) AS pub_date, lower(location_name) AS hub, 'spot' AS product FROM f_raw_spot"
        "   UNION ALL SELECT DISTINCT CAST(pub_date AS DATE), lower(location_name), 'derivatives' FROM f_raw_futures) l"
        " ON l.pub_date = e.pub_date AND l.hub = e.hub AND l.product = e.product WHERE l.hub IS NULL"),
    "load_internal": _counters("SELECT count(*) FROM l_raw_internal", "0", "l_internal_rows", "l_internal_valid", "l_internal_quotes"),
    "load_exchange": _counters(
        "SELECT (SELECT count(*) FROM f_raw_spot) + (SELECT count(*) FROM f_raw_futures) + (SELECT count(*) FROM short_lines)",
        "SELECT (SELECT count(*) FROM f_raw_spot WHERE price_mid = 'n/a') + (SELECT count(*) FROM short_lines)",
        "f_exchange_rows", "f_exchange_valid", "f_exchange_quotes"),
    "load_assessor": _counters(
        "SELECT (SELECT count(*) FROM l_raw_assessments) + (SELECT count(*) FROM l_raw_indices)", "0", "l_assessor_rows", "l_assessor_valid", "l_assessor_quotes"),
    "load_incremental": _quotes("f_exchange_quotes"),
    "rolling_window": _sql(
        "SELECT commodity, index_name, publication, CAST(t.pub_date AS VARCHAR) AS pub_date, CAST(end_date AS VARCHAR) AS end_date, round(price, 6) AS price, currency, unit,"
        " strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update FROM raw_internal t"
        " WHERE t.pub_date BETWEEN (SELECT CAST(max(pub_date) - INTERVAL 20 DAY AS DATE) FROM raw_internal) AND (SELECT max(pub_date) FROM raw_internal)"),
    "latest_version": _sql("SELECT d.* FROM definitions d WHERE index_version_id = (SELECT max(index_version_id) FROM definitions e WHERE e.index_id = d.index_id)"),
    "internal_extract": _sql(f"""
        SELECT comm.n_name AS commodity, idx.index_name, ref.s_name AS publication, CAST(CAST(hist.l_shipdate AS DATE) AS VARCHAR) AS pub_date,
          CAST(CAST(hist.l_shipdate + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS end_date, round(hist.l_extendedprice, 6) AS price, ccy.n_name AS currency, un.r_name AS unit,
          strftime(hist.l_shipdate, '%Y-%m-%d %H:%M:%S') AS last_update
        FROM definitions idx JOIN nation ccy ON idx.currency = ccy.n_nationkey JOIN region un ON idx.unit = un.r_regionkey
          JOIN lineitem hist ON idx.index_id = CAST(floor(hist.l_partkey / 4) AS BIGINT) JOIN supplier ref ON hist.l_suppkey = ref.s_suppkey JOIN nation comm ON idx.delivery_type = comm.n_nationkey
        WHERE idx.db_status = 1 AND idx.index_version_id = (SELECT max(index_version_id) FROM definitions i2 WHERE i2.index_id = idx.index_id)
          AND (lower(index_name) LIKE '%pnx%' OR lower(index_name) LIKE '%esgm%') AND CAST(hist.l_shipdate AS DATE) BETWEEN DATE '{EXTRACT_WINDOW[0]}' AND DATE '{EXTRACT_WINDOW[1]}'"""),
}
