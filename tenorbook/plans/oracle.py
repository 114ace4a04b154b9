"""The same queries as plain SQL for an independent engine.

Written from the business rules, not from the Spark code: deals are cross joined
with the as-of dates and dimensions are joined row by row.
"""

from __future__ import annotations

from tenorbook import fixed_values


def _values(rows) -> str:
    def quoted(value) -> str:
        return "'" + str(value).replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)


_REGIONS = [
    (country, region)
    for region, countries in fixed_values.REGION_COUNTRIES.items()
    for country in countries
]

_SOURCES = """
src_deals AS (
  SELECT
    'FIN-' || strftime(d, '%Y%m') || '-'
      || lpad(k::varchar, greatest(10, length(k::varchar))::int, '0') AS deal_id,
    deal_type,
    'CP_' || lpad(o_custkey::varchar, greatest(10, length(o_custkey::varchar))::int, '0')
      AS cpty_code,
    c_name AS cpty_name,
    list_extract(['ZA','US','CN','DE','SA','NG','BR','JP','FR','AE','EG','MX','IN','GB',
      'KW','KE','CA','KR','CH','QA','XX','EU','SG','IT','ZZ'], n_nationkey + 1)
      AS cpty_country,
    strftime(d, '%Y-%m-%d') AS trade_date,
    CASE WHEN k % 1499 = 0 THEN '2000-13-01' ELSE strftime(d + 2, '%Y-%m-%d') END
      AS value_date,
    CASE deal_type
      WHEN 'SIGHT_DEP' THEN ''
      WHEN 'NOTICE_DEP'
        THEN strftime(d + 2 + list_extract([30,60,90,180], k % 4 + 1)::int, '%Y-%m-%d')
      WHEN 'MTI_DEP' THEN strftime(d + 2 + (365 * (1 + k % 7))::int, '%Y-%m-%d')
      ELSE strftime(d + 2 + list_extract([30,60,90,120,180,270,365,540,730],
        k % 9 + 1)::int, '%Y-%m-%d')
    END AS maturity_date,
    list_extract(['USD','EUR','GBP','JPY','CNY','CHF','AUD','CAD','SGD','KRW'],
      o_custkey % 10 + 1) AS currency,
    o_totalprice::decimal(20,2)::varchar AS nominal_amount,
    CASE WHEN k % 997 = 0 THEN 'n/a'
      ELSE ((k % 600)::decimal(5,0) * 0.01::decimal(3,2))::decimal(10,4)::varchar END
      AS rate_pct,
    CASE WHEN k % 50 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'MATURED'
      ELSE 'VALIDATED' END AS deal_status,
    list_extract(['TRSRY-EMEA','TRSRY-AMER','TRSRY-APAC','TRSRY-EMEA','TRSRY-INTL'],
      r_regionkey + 1) AS portfolio,
    'BK-' || lpad((o_custkey % 10 + 1)::varchar, 3, '0') AS book,
    booked AS created_dt,
    booked AS last_modified_dt
  FROM (
    SELECT *, o_orderkey AS k, o_orderdate::date AS d,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'SIGHT_DEP' WHEN '2-HIGH' THEN 'NOTICE_DEP'
        WHEN '3-MEDIUM' THEN 'MTI_DEP' ELSE 'FIXBIS_DEP' END AS deal_type,
      strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad((7 + o_orderkey % 11)::varchar, 2, '0')
        || ':' || lpad((o_orderkey % 60)::varchar, 2, '0')
        || ':' || lpad(((7 * o_orderkey) % 60)::varchar, 2, '0') AS booked
    FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
  )
),
month_ends AS (
  SELECT n, last_day((SELECT date_trunc('month', min(o_orderdate))::date FROM orders) + to_months(n)) AS month_end
  FROM (SELECT unnest(generate_series(0, (
    SELECT date_diff('month', min(o_orderdate), max(o_orderdate)) FROM orders
  )))::int AS n)
),
base_rates(currency_code, base) AS (VALUES @BASE_RATES@),
src_fx_rates AS (
  SELECT
    strftime(month_end, '%Y-%m-%d') AS rate_date,
    currency_code,
    (base::decimal(7,6) * (100 + (year(month_end) * 12 + month(month_end) - 1) % 7 - 3)::decimal(5,0) * 0.01::decimal(3,2))
      ::decimal(12,6)::varchar AS sdr_per_unit
  FROM month_ends, base_rates
)"""

_MODELS = """
stg_deals AS (
  SELECT deal_id, deal_type, cpty_code, cpty_name, cpty_country,
    try_strptime(trade_date, '%Y-%m-%d')::date AS trade_date,
    try_strptime(value_date, '%Y-%m-%d')::date AS value_date,
    try_strptime(maturity_date, '%Y-%m-%d')::date AS maturity_date,
    currency,
    try_cast(nominal_amount AS decimal(20,2)) AS nominal_amount,
    try_cast(rate_pct AS decimal(10,6)) AS rate_pct,
    (try_cast(rate_pct AS decimal(10,6)) * 0.01)::decimal(16,11) AS rate_decimal,
    deal_status, portfolio, book,
    try_strptime(created_dt, '%Y-%m-%d %H:%M:%S') AS created_dt,
    try_strptime(last_modified_dt, '%Y-%m-%d %H:%M:%S') AS last_modified_dt
  FROM src_deals
),
stg_fx_rates AS (
  SELECT try_strptime(rate_date, '%Y-%m-%d')::date AS rate_date, currency_code,
    try_cast(sdr_per_unit AS decimal(12,6)) AS sdr_per_unit
  FROM src_fx_rates
),
int_deals_with_sdr AS (
  SELECT d.* EXCLUDE (created_dt, last_modified_dt),
    fx.rate_date AS fx_rate_date,
    fx.sdr_per_unit,
    (d.nominal_amount * fx.sdr_per_unit)::decimal(33,8) AS nominal_amount_sdr,
    d.created_dt, d.last_modified_dt
  FROM stg_deals d
  LEFT JOIN stg_fx_rates fx
    ON d.currency = fx.currency_code
    AND date_trunc('month', d.value_date)::date - 1 = fx.rate_date
),
fct_currency_deposits AS (
  SELECT deal_id, deal_type, cpty_code, currency,
    strftime(trade_date, '%Y%m%d')::int AS trade_date_key,
    strftime(value_date, '%Y%m%d')::int AS value_date_key,
    strftime(maturity_date, '%Y%m%d')::int AS maturity_date_key,
    nominal_amount, nominal_amount_sdr, rate_pct, rate_decimal, deal_status, portfolio,
    book, fx_rate_date, sdr_per_unit, created_dt, last_modified_dt
  FROM int_deals_with_sdr
),
region_map(country, region_name) AS (VALUES @REGIONS@),
dim_counterparty AS (
  SELECT p.*, coalesce(region_name, 'Other') AS region
  FROM (SELECT DISTINCT cpty_code, cpty_name, cpty_country FROM int_deals_with_sdr) p
  LEFT JOIN region_map ON country = cpty_country
),
named AS (
  SELECT * FROM dim_counterparty QUALIFY row_number() OVER (PARTITION BY cpty_code
    ORDER BY cpty_name DESC NULLS LAST, cpty_country DESC NULLS LAST) = 1
),
currencies(currency, currency_name, is_sdr_basket) AS (VALUES @CURRENCIES@),
products(deal_type, product_name, product_description) AS (VALUES @PRODUCTS@),
covered_days AS (
  SELECT unnest(generate_series(min(trade_date), max(maturity_date), INTERVAL 1 DAY))::date
    AS full_date
  FROM stg_deals
),
calendar_days AS (
  SELECT unnest(generate_series((SELECT make_date(year(min(o_orderdate)), 1, 1) FROM orders),
    (SELECT make_date(year(max(o_orderdate)::date + 2557), 12, 31) FROM orders), INTERVAL 1 DAY))::date
    AS full_date
),
fiscal_years AS (
  SELECT make_date(y, 4, 1) AS first_day, make_date(y + 1, 3, 31) AS final_day,
    printf('FY%d-%02d', y, (y + 1) % 100) AS fiscal_year
  FROM range(1980, 2030) t(y)
),
fiscal_days AS (
  SELECT strftime(full_date, '%Y%m%d')::int AS date_key, full_date, fiscal_year
  FROM calendar_days JOIN fiscal_years ON full_date BETWEEN first_day AND final_day
),
active AS (
  SELECT deal_id, deal_type, nominal_amount_sdr, maturity_date_key,
    strptime(maturity_date_key::varchar, '%Y%m%d')::date AS maturity_date
  FROM fct_currency_deposits WHERE deal_status = 'VALIDATED'
),
term_buckets(above, up_to, label) AS (VALUES (0, 7, '2. <= 1 Week'),
  (7, 30, '3. <= 1 Month'), (30, 90, '4. <= 3 Months'), (90, 180, '5. <= 6 Months'),
  (180, 365, '6. <= 1 Year'), (365, 99999999, '7. > 1 Year')),
as_of_dates AS (
  SELECT last_day((SELECT date_trunc('month', min(o_orderdate))::date FROM orders) + to_months(i::int)) AS as_of_date
  FROM range((SELECT date_diff('month', min(o_orderdate), max(o_orderdate)) + 1 FROM orders)) t(i)
),
exposed AS (
  SELECT a.*, as_of_date, (maturity_date - as_of_date)::int AS days_to_maturity,
    '1. Overnight' AS maturity_bucket
  FROM active a CROSS JOIN as_of_dates WHERE deal_type = 'SIGHT_DEP'
  UNION ALL
  SELECT a.*, as_of_date, (maturity_date - as_of_date)::int, label
  FROM active a CROSS JOIN as_of_dates
  JOIN term_buckets ON maturity_date - as_of_date > above
    AND maturity_date - as_of_date <= up_to
  WHERE deal_type <> 'SIGHT_DEP'
),
ladder AS (
  SELECT as_of_date, maturity_bucket, count(*) AS deal_count,
    sum(nominal_amount_sdr) AS total_sdr
  FROM exposed GROUP BY as_of_date, maturity_bucket
),
book AS (SELECT * FROM fct_currency_deposits WHERE deal_status = 'VALIDATED'),
region_totals AS (
  SELECT region, count(*) AS deal_count, sum(nominal_amount_sdr) AS total_sdr
  FROM book LEFT JOIN named USING (cpty_code) GROUP BY region
),
counterparty_totals AS (
  SELECT cpty_code, cpty_name, cpty_country, region, count(*) AS deal_count,
    sum(nominal_amount_sdr) AS total_sdr
  FROM book LEFT JOIN named USING (cpty_code)
  GROUP BY ALL
)"""


def _prelude() -> str:
    text = "WITH" + _SOURCES + "," + _MODELS
    for mark, rows in {
        "@BASE_RATES@": fixed_values.BASE_RATES,
        "@REGIONS@": _REGIONS,
        "@CURRENCIES@": fixed_values.CURRENCIES,
        "@PRODUCTS@": fixed_values.PRODUCTS,
    }.items():
        text = text.replace(mark, _values(rows))
    return text


def _digits(number: str) -> str:
    """A decimal without its point: the whole number of its smallest units."""
    return f"replace(({number})::varchar, '.', '')::hugeint"


def _quotient(above: str, below: str, places: int) -> str:
    """Whole numbers, not negative: `above` over `below` in units of 10^-places, halves up."""
    units = f"((2 * {above} + {below}) // (2 * {below}))"
    return (
        f"(({units} // {10**places})::varchar || '.'"
        f" || lpad(({units} % {10**places})::varchar, {places}, '0'))"
    )


def _by_fiscal_year(role: str) -> str:
    return f"""
      SELECT fiscal_year, product_name, count(*) AS deal_count,
        sum(nominal_amount_sdr) AS total_sdr
      FROM book
      LEFT JOIN fiscal_days ON date_key = {role}_date_key
      LEFT JOIN products USING (deal_type)
      GROUP BY fiscal_year, product_name"""


def _grain(relation: str, source: str, *keys: str) -> str:
    columns = ", ".join(keys)
    return f"""
      SELECT '{relation}' AS relation, '{columns}' AS grain, count(*) AS duplicate_keys,
        coalesce(sum(n - 1), 0)::bigint AS excess_rows
      FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns}) WHERE n > 1"""


def _orphans(foreign_key: str, known: str) -> str:
    return f"""
      SELECT '{foreign_key}' AS foreign_key, {foreign_key}::varchar AS key_value,
        count(*) AS deal_count
      FROM fct_currency_deposits
      WHERE {foreign_key} IS NOT NULL AND {foreign_key} NOT IN ({known})
      GROUP BY {foreign_key}"""


def _domain(column: str, accepted: tuple[str, ...]) -> str:
    values = ", ".join(f"'{v}'" for v in accepted)
    return f"""
      SELECT '{column}' AS column_name, {column} AS value,
        coalesce({column} IN ({values}), false) AS is_accepted, count(*) AS deal_count
      FROM stg_deals GROUP BY {column}"""


def _cast_failure(column: str) -> str:
    return f"""
      SELECT r.deal_id, '{column}' AS column_name, r.{column} AS raw_value
      FROM src_deals r JOIN stg_deals s USING (deal_id)
      WHERE trim(r.{column}) <> '' AND s.{column} IS NULL"""


_CALENDAR_KEYS = "SELECT date_key FROM fiscal_days WHERE full_date <= (SELECT last_day(max(o_orderdate)::date) FROM orders)"

_BROKEN = "(regexp_extract(deal_id, '([0-9]+)$', 1)::bigint % 211 = 0 OR regexp_extract(deal_id, '([0-9]+)$', 1)::bigint % 223 = 0)"

_DEAL_COLUMNS = (
    "deal_id", "deal_type", "cpty_code", "cpty_name", "cpty_country", "trade_date", "value_date", "maturity_date", "currency",
    "nominal_amount", "rate_pct", "deal_status", "portfolio", "book", "created_dt", "last_modified_dt",
)


def _line(columns: tuple[str, ...]) -> str:
    return " || ',' || ".join(f"coalesce({c}, '')" for c in columns)


_LIVE = """
  SELECT d AS full_date, count(deal_id) AS deal_count, coalesce(sum(nominal_amount_sdr), 0)::decimal(38,8) AS total_sdr
  FROM (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate))::timestamp FROM orders),
      (SELECT last_day(max(o_orderdate)::date)::timestamp FROM orders), INTERVAL 1 DAY))::date AS d)
  LEFT JOIN (SELECT deal_id, nominal_amount_sdr, deal_type, strptime(value_date_key::varchar, '%Y%m%d')::date AS v,
      strptime(maturity_date_key::varchar, '%Y%m%d')::date AS m FROM book WHERE value_date_key IS NOT NULL)
    ON v <= d AND (deal_type = 'SIGHT_DEP' OR m > d)
  GROUP BY d"""

#: Columns of the published views, written down from the data model.
_COLUMNS = {
    "int_deals_with_sdr": "deal_id string, deal_type string, cpty_code string, cpty_name string, cpty_country string, trade_date date, value_date date,"
    " maturity_date date, currency string, nominal_amount decimal(20,2), rate_pct decimal(10,6), rate_decimal decimal(16,11), deal_status string,"
    " portfolio string, book string, fx_rate_date date, sdr_per_unit decimal(12,6), nominal_amount_sdr decimal(33,8), created_dt timestamp_ntz,"
    " last_modified_dt timestamp_ntz",
    "dim_counterparty": "cpty_code string, cpty_name string, cpty_country string, region string",
    "dim_currency": "currency string, currency_name string, is_sdr_basket string",
    "dim_date": "date_key int, full_date date, year int, month_num int, month_name string, quarter int, fiscal_year string, fiscal_quarter string",
    "dim_product": "deal_type string, product_name string, product_description string",
    "fct_currency_deposits": "deal_id string, deal_type string, cpty_code string, currency string, trade_date_key int, value_date_key int,"
    " maturity_date_key int, nominal_amount decimal(20,2), nominal_amount_sdr decimal(33,8), rate_pct decimal(10,6), rate_decimal decimal(16,11),"
    " deal_status string, portfolio string, book string, fx_rate_date date, sdr_per_unit decimal(12,6), created_dt timestamp_ntz,"
    " last_modified_dt timestamp_ntz",
    "mart_maturity_ladder": "maturity_bucket string, deal_count bigint, total_sdr decimal(38,8), as_of_date date",
}
_COUNTED = {"dim_currency": "currencies", "dim_product": "products", "dim_date": "calendar_days", "mart_maturity_ladder": "ladder"}


def _columns() -> str:
    rows = ", ".join(
        f"('{name}', {n}, '{field.split(' ')[0]}', '{field.split(' ')[1]}')"
        for name, fields in _COLUMNS.items()
        for n, field in enumerate(fields.split(", "), 1)
    )
    counts = " UNION ALL ".join(f"SELECT '{n}' AS relation, count(*) AS row_count FROM {_COUNTED.get(n, n)}" for n in _COLUMNS)
    return f"SELECT relation, position::bigint AS position, column_name, data_type, row_count FROM (VALUES {rows}) t(relation, position, column_name, data_type) JOIN ({counts}) USING (relation)"


_QUERIES = {
    "src_deals": "SELECT * FROM src_deals",
    "src_fx_rates": "SELECT * FROM src_fx_rates",
    "stg_deals": "SELECT * FROM stg_deals",
    "stg_fx_rates": "SELECT * FROM stg_fx_rates",
    "int_deals_with_sdr": "SELECT * FROM int_deals_with_sdr",
    "date_spine": "SELECT full_date FROM covered_days",
    "month_end_spine": "SELECT month_end AS as_of_date FROM month_ends",
    "dim_date": """
      SELECT strftime(full_date, '%Y%m%d')::int AS date_key,
        full_date,
        date_part('year', full_date)::int AS year,
        date_part('month', full_date)::int AS month_num,
        strftime(full_date, '%B') AS month_name,
        date_part('quarter', full_date)::int AS quarter,
        fiscal_year,
        'FQ' || (date_diff('month', first_day, full_date) // 3 + 1) AS fiscal_quarter
      FROM covered_days JOIN fiscal_years ON full_date BETWEEN first_day AND final_day""",
    "dim_currency": """
      SELECT c.*, count(deal_id) AS deal_count
      FROM currencies c LEFT JOIN fct_currency_deposits f USING (currency) GROUP BY ALL""",
    "dim_product": """
      SELECT p.*, count(deal_id) AS deal_count
      FROM products p LEFT JOIN fct_currency_deposits f USING (deal_type) GROUP BY ALL""",
    "dim_counterparty": "SELECT * FROM dim_counterparty",
    "fct_currency_deposits": "SELECT * FROM fct_currency_deposits",
    "star_deposits": """
      SELECT f.*, cpty_name, cpty_country, region, product_name, product_description,
        currency_name, is_sdr_basket
      FROM fct_currency_deposits f
      LEFT JOIN named USING (cpty_code)
      LEFT JOIN products USING (deal_type)
      LEFT JOIN currencies USING (currency)""",
    "active_deals": "SELECT * FROM active",
    "mart_maturity_ladder": "SELECT * FROM ladder",
    "ladder_exposed_rows": """
      SELECT as_of_date, deal_type = 'SIGHT_DEP' AS is_sight, maturity_date,
        days_to_maturity, maturity_bucket, count(*) AS deal_count,
        sum(nominal_amount_sdr) AS total_sdr
      FROM exposed GROUP BY ALL""",
    "ladder_at_date": "SELECT * FROM ladder WHERE as_of_date = DATE '2000-06-30'",
    "ladder_deals_at_date": """
      SELECT as_of_date, deal_id, deal_type, maturity_date, days_to_maturity,
        maturity_bucket, nominal_amount_sdr
      FROM exposed WHERE as_of_date = DATE '2000-06-30'""",
    "avg_active_book": f"""
      SELECT count(*) AS as_of_dates, sum(n)::bigint AS sum_deal_count,
        sum(s) AS sum_total_sdr,
        {_quotient(_digits('sum(s)'), '(1000000 * count(s))', 2)}::decimal(38,2) AS average_sdr
      FROM (SELECT count(*) AS n, sum(nominal_amount_sdr) AS s FROM exposed
        GROUP BY as_of_date)""",
    "point_in_time_ladder": """
      SELECT as_of_date, maturity_bucket, count(*) AS deal_count, sum(e.nominal_amount_sdr) AS total_sdr
      FROM exposed e JOIN fct_currency_deposits f USING (deal_id)
      WHERE f.value_date_key <= strftime(as_of_date, '%Y%m%d')::int
      GROUP BY as_of_date, maturity_bucket""",
    "daily_book": _LIVE,
    "monthly_average_book": f"""
      SELECT last_day(full_date) AS month_end, count(*) AS days, sum(deal_count)::bigint AS deal_days,
        sum(total_sdr) AS sdr_days,
        {_quotient(_digits('sum(total_sdr)'), '(1000000 * count(*))', 2)}::decimal(38,2) AS average_sdr
      FROM ({_LIVE}) GROUP BY last_day(full_date)""",
    "loaded_deals": f"SELECT * FROM stg_deals WHERE NOT {_BROKEN}",
    "rejected_lines": f"""
      SELECT 'first' AS batch, CASE WHEN regexp_extract(deal_id, '([0-9]+)$', 1)::bigint % 211 = 0
        THEN {_line(_DEAL_COLUMNS[:-1])} ELSE {_line(_DEAL_COLUMNS)} || ',extra' END AS malformed_line
      FROM src_deals WHERE {_BROKEN}""",
    "stored_fx_rates": "SELECT * FROM stg_fx_rates",
    "published_columns": _columns(),
    "exposure_by_region": "SELECT * FROM region_totals",
    "exposure_by_region_sliced": """
      SELECT region, count(*) AS deal_count, sum(nominal_amount_sdr) AS total_sdr
      FROM book
      LEFT JOIN named USING (cpty_code)
      JOIN fiscal_days ON date_key = value_date_key
      WHERE fiscal_year = 'FY1999-00' AND currency = 'USD'
      GROUP BY region""",
    "region_share": f"""
      SELECT region, total_sdr, grand_total_sdr,
        {_quotient(f"(1000000 * {_digits('total_sdr')})", _digits('grand_total_sdr'), 6)}::decimal(18,6)
          AS share
      FROM (SELECT *, sum(total_sdr) OVER () AS grand_total_sdr FROM region_totals)""",
    "exposure_by_currency": """
      SELECT currency, currency_name, is_sdr_basket, count(*) AS deal_count,
        sum(nominal_amount_sdr) AS total_sdr
      FROM book LEFT JOIN currencies USING (currency) GROUP BY ALL""",
    "exposure_by_product": """
      SELECT deal_type, product_name, count(*) AS deal_count,
        sum(nominal_amount_sdr) AS total_sdr
      FROM book LEFT JOIN products USING (deal_type) GROUP BY ALL""",
    "exposure_by_portfolio": """
      SELECT portfolio, count(*) AS deal_count, sum(nominal_amount_sdr) AS total_sdr
      FROM book GROUP BY portfolio""",
    "exposure_by_counterparty": "SELECT * FROM counterparty_totals",
    "top_counterparties": """
      SELECT * FROM counterparty_totals
      ORDER BY total_sdr DESC NULLS LAST, cpty_code LIMIT 10""",
    "exposure_sdr_basket": """
      SELECT sum(CASE WHEN basket THEN 1 END)::bigint AS basket_deals,
        sum(CASE WHEN basket THEN nominal_amount_sdr END) AS basket_sdr,
        sum(CASE WHEN NOT basket THEN 1 END)::bigint AS other_deals,
        sum(CASE WHEN NOT basket THEN nominal_amount_sdr END) AS other_sdr
      FROM (SELECT nominal_amount_sdr, coalesce(is_sdr_basket = 'Y', false) AS basket
        FROM book LEFT JOIN currencies USING (currency))""",
    "cost_of_funds_by_currency": f"""
      SELECT currency, count(*) AS deal_count,
        sum(rate_pct * weight) AS rate_times_sdr,
        sum(weight) AS weight_sdr,
        {_quotient(_digits('sum(rate_pct * weight)'), _digits('nullif(sum(weight), 0)'), 6)}
          ::decimal(18,6) AS weighted_rate_pct,
        {_quotient(_digits('sum(rate_pct)'), 'nullif(count(rate_pct), 0)', 6)}::decimal(18,6)
          AS mean_rate_pct
      FROM (SELECT currency, rate_pct,
          CASE WHEN rate_pct IS NOT NULL THEN nominal_amount_sdr::decimal(27,8) END AS weight
        FROM book)
      GROUP BY currency""",
    "deposits_by_value_fy": _by_fiscal_year("value"),
    "deposits_by_trade_fy": _by_fiscal_year("trade"),
    "deposits_by_maturity_fy": _by_fiscal_year("maturity"),
    "dq_grain": " UNION ALL ".join(
        [
            _grain("fct_currency_deposits", "fct_currency_deposits", "deal_id"),
            _grain("dim_counterparty", "dim_counterparty", "cpty_code"),
            _grain("dim_currency", "currencies", "currency"),
            _grain("dim_product", "products", "deal_type"),
            _grain("dim_date", "calendar_days", "full_date"),
            _grain("mart_maturity_ladder", "ladder", "as_of_date", "maturity_bucket"),
            _grain("stg_fx_rates", "stg_fx_rates", "rate_date", "currency_code"),
            _grain("customer", "customer", "c_custkey"),
        ]
    ),
    "dq_orphans": " UNION ALL ".join(
        [
            _orphans("cpty_code", "SELECT cpty_code FROM dim_counterparty"),
            _orphans("deal_type", "SELECT deal_type FROM products"),
            _orphans("currency", "SELECT currency FROM currencies"),
            _orphans("trade_date_key", _CALENDAR_KEYS),
            _orphans("value_date_key", _CALENDAR_KEYS),
            _orphans("maturity_date_key", _CALENDAR_KEYS),
        ]
    ),
    "dq_region_coverage": """
      SELECT region, count(*) AS counterparty_count FROM dim_counterparty
      GROUP BY region ORDER BY counterparty_count DESC, region""",
    "dq_missing_fx": """
      SELECT currency, year(value_date)::int AS value_year, month(value_date)::int
        AS value_month, count(*) AS deal_count,
        sum(nominal_amount)::decimal(30,2) AS total_nominal
      FROM int_deals_with_sdr WHERE sdr_per_unit IS NULL GROUP BY ALL""",
    "dq_domains": " UNION ALL ".join(
        [
            _domain("deal_status", fixed_values.DEAL_STATUSES),
            _domain("deal_type", fixed_values.DEAL_TYPES),
        ]
    ),
    "dq_cast_failures": " UNION ALL ".join(
        _cast_failure(column)
        for column in (
            "trade_date",
            "value_date",
            "maturity_date",
            "nominal_amount",
            "rate_pct",
            "created_dt",
            "last_modified_dt",
        )
    ),
    "dq_maturity_rule": """
      SELECT deal_type, count(*) AS deal_count, count(maturity_date) AS with_maturity,
        count(*) FILTER ((deal_type = 'SIGHT_DEP') <> (maturity_date IS NULL)) AS violations
      FROM stg_deals GROUP BY deal_type""",
    "dq_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS relation, count(*) AS row_count FROM {name}"
        for name in (
            "src_deals",
            "stg_deals",
            "int_deals_with_sdr",
            "fct_currency_deposits",
        )
    ),
}


_QUERIES["bucketed_grain"] = _grain("fct_currency_deposits", "fct_currency_deposits", "deal_id")
_QUERIES["bucketed_names"] = "SELECT deal_id, cpty_name, cpty_country, nominal_amount_sdr FROM int_deals_with_sdr"
_QUERIES["published_row_counts"] = _QUERIES["dq_row_counts"]
_QUERIES["published_exposure_sliced"] = _QUERIES["exposure_by_region_sliced"]


def oracle_sql() -> dict[str, str]:
    prelude = _prelude()
    return {name: f"{prelude}\n{body}" for name, body in _QUERIES.items()}
