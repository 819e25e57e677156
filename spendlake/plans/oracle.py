"""Plain SQL for the queries of :mod:`spendlake.plans.catalog`, written independently of them.

The texts run on DuckDB over the test tables. Money is summed as decimals, and a tiny addend
before ``round`` makes exact halves go up, as Spark rounds them.
"""

from __future__ import annotations

from spendlake.schemas import ASSETS, CARD_PRODUCTS, DISCRETIONARY_CATEGORIES


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


LINES = """lines AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   strftime(l_shipdate, '%Y%m%d')) AS id,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date,
         strftime(o_orderdate, '%Y-%m') AS txn_month,
         CAST(o_custkey AS VARCHAR) AS client_id,
         o_orderpriority AS card_id, l_tax, l_returnflag,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END
           * round(l_extendedprice * (1 - l_discount) / 100 + 1e-7, 2) AS amount,
         'Chip Transaction' AS use_chip,
         CAST(l_suppkey AS VARCHAR) AS merchant_id,
         'City ' || CAST(l_suppkey % 50 AS VARCHAR) AS merchant_city,
         'S' || CAST(l_suppkey % 20 AS VARCHAR) AS merchant_state,
         lpad(CAST(l_suppkey % 100000 AS VARCHAR), 5, '0') AS zip,
         p_type AS mcc,
         CAST(NULL AS VARCHAR) AS errors,
         CASE p_type WHEN 'ECONOMY' THEN 'DISCOUNT STORES'
                     WHEN 'SMALL' THEN 'FAST FOOD RESTAURANTS'
                     WHEN 'MEDIUM' THEN 'DEPARTMENT STORES'
                     WHEN 'LARGE' THEN 'INDUSTRIAL SUPPLIES'
                     WHEN 'STANDARD' THEN 'GROCERY STORES'
                     ELSE 'UNKNOWN' END AS category_name
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey)"""

USERS = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id,
         CAST(23 + c_custkey % 60 AS INTEGER) AS current_age,
         CAST(55 + c_nationkey % 20 AS INTEGER) AS retirement_age,
         CAST(2024 - 23 - c_custkey % 60 AS INTEGER) AS birth_year,
         CAST(1 + c_custkey % 12 AS INTEGER) AS birth_month,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         c_name AS address,
         CAST(c_custkey % 90 AS REAL) AS latitude,
         CAST(-(c_custkey % 180) AS REAL) AS longitude,
         CAST((c_custkey % 300) * 100 AS DOUBLE) AS per_capita_income,
         CAST(CAST((c_acctbal + 1000) * 5 AS DECIMAL(18,2)) AS DOUBLE) AS yearly_income,
         CAST((c_custkey % 97) * 500 AS DOUBLE) AS total_debt,
         CAST(488 + (c_custkey * 37) % 363 AS INTEGER) AS credit_score,
         CAST(1 + c_custkey % 9 AS INTEGER) AS num_credit_cards
  FROM customer)"""

# What cleaning drops of the dirty raw files, and what a too long CSV line drops besides.
_KEPT = (
    "l_tax <> 0.07 AND NOT (l_tax = 0.06 AND l_returnflag = 'A') "
    "AND NOT (l_tax = 0.05 AND l_returnflag = 'N') AND NOT (l_tax = 0.04 AND l_returnflag = 'R')"
)
DIRTY_USERS = """dirty_users AS (
  SELECT * FROM users WHERE retirement_age - current_age NOT IN (3, 5, 7))"""

MONTHS = f"""months AS (
  SELECT client_id, txn_month,
         sum(CAST(abs(amount) AS DECIMAL(18,2))) AS spend,
         sum(CASE WHEN category_name IN ({_quoted(DISCRETIONARY_CATEGORIES)})
                  THEN CAST(abs(amount) AS DECIMAL(18,2)) ELSE 0 END) AS discretionary
  FROM lines WHERE amount < 0 GROUP BY 1, 2)"""


def _half_up(value: str, digits: int, nudge: str = "1e-7") -> str:
    # Adding zero turns the negative zero of a small negative value into zero.
    return f"(round({value} + sign({value}) * {nudge}, {digits}) + 0.0)"


_MEAN_BEFORE = "CAST(sum(spend) OVER before AS DOUBLE) / count(spend) OVER before"
_MEAN_RECENT = "CAST(sum(spend) OVER recent AS DOUBLE) / count(spend) OVER recent"

SERIES = f"""series AS (
  SELECT client_id, txn_month,
         CAST(spend AS DOUBLE) AS current_month_spend,
         CAST(lag(spend, 1) OVER w AS DOUBLE) AS spend_1_month_ago,
         CAST(lag(spend, 2) OVER w AS DOUBLE) AS spend_2_months_ago,
         CAST(lag(spend, 3) OVER w AS DOUBLE) AS spend_3_months_ago,
         {_half_up(_MEAN_BEFORE, 2)} AS avg_spend_last_3_months,
         {_half_up(_MEAN_RECENT, 2)} AS smoothed_target_spend,
         row_number() OVER w AS position,
         row_number() OVER (PARTITION BY client_id ORDER BY txn_month DESC) AS age
  FROM months
  WINDOW w AS (PARTITION BY client_id ORDER BY txn_month),
         before AS (PARTITION BY client_id ORDER BY txn_month
                    ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
         recent AS (PARTITION BY client_id ORDER BY txn_month
                    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""

TOTALS = """totals AS (
  SELECT client_id, CAST(sum(spend) AS DOUBLE) AS total_expenses,
         CAST(sum(discretionary) AS DOUBLE) AS discretionary_spending,
         count(DISTINCT txn_month) AS active_months
  FROM months GROUP BY 1)"""

FEATURES = f"""basics AS (
  SELECT users.*, client_id,
         total_expenses / active_months AS avg_monthly_spend,
         discretionary_spending / active_months AS avg_monthly_discretionary,
         yearly_income / 12 AS monthly_income,
         retirement_age - current_age AS investment_horizon,
         {_half_up("(total_debt / nullif(yearly_income, 0))", 4, "1e-9")}
           AS credit_utilization_ratio
  FROM users JOIN totals ON id = client_id),
disposable AS (
  SELECT *, {_half_up("(monthly_income - avg_monthly_spend)", 0, "1e-9")}
           AS monthly_disposable_income
  FROM basics),
features AS (
  SELECT *,
         {_half_up("(monthly_disposable_income / nullif(monthly_income, 0))", 4, "1e-9")}
           AS savings_rate,
         {_half_up("(avg_monthly_discretionary / nullif(avg_monthly_spend, 0))", 4, "1e-9")}
           AS discretionary_spend_ratio,
         CAST(greatest(1, least(10, 5
           + CASE WHEN investment_horizon > 20 THEN 2 ELSE 0 END
           - CASE WHEN investment_horizon < 10 THEN 2 ELSE 0 END
           + CASE WHEN credit_score > 750 THEN 1 ELSE 0 END
           - CASE WHEN credit_utilization_ratio > 0.4 THEN 2 ELSE 0 END)) AS INTEGER)
           AS risk_tolerance_score
  FROM disposable)"""

GOLD = (LINES, USERS, MONTHS, TOTALS, FEATURES)

_ASSET_ROWS = ", ".join(
    f"('{a.name}', {a.annual_return}, {a.risk}, {-1000000 if a.min_horizon is None else a.min_horizon})"
    for a in ASSETS
)
_AMOUNTS = ",\n         ".join(
    f"""CASE WHEN budget <= 0 THEN 0.0 WHEN lo IS NOT NULL THEN
           {_half_up(f"(budget * (CASE WHEN lo = '{a.name}' THEN 1 - share WHEN hi = '{a.name}' THEN share ELSE 0 END))", 2)}
         END AS {a.name}"""
    for a in ASSETS
)

# All basic solutions of the linear program: one asset, or two whose mix meets the risk limit.
ALLOCATION = f"""assets(asset, ret, risk, min_horizon) AS (VALUES {_ASSET_ROWS}),
vertices AS (
  SELECT asset AS lo, asset AS hi, risk AS lo_risk, risk AS hi_risk, ret AS lo_ret, ret AS hi_ret,
         min_horizon FROM assets
  UNION ALL
  SELECT a.asset, b.asset, a.risk, b.risk, a.ret, b.ret, greatest(a.min_horizon, b.min_horizon)
  FROM assets a JOIN assets b ON a.risk < b.risk),
choices AS (
  SELECT asks.*, vertices.*,
         CASE WHEN lo = hi THEN 0.0
              ELSE (asks.risk - lo_risk) / CAST(hi_risk - lo_risk AS DOUBLE) END AS share
  FROM asks JOIN vertices
    ON asks.horizon >= min_horizon
   AND ((lo = hi AND lo_risk <= asks.risk) OR (lo <> hi AND lo_risk < asks.risk AND asks.risk < hi_risk))),
best AS (
  SELECT client_id, lo, hi, share FROM (
    SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY
                round((1 - share) * lo_ret + share * hi_ret, 9) DESC,
                (1 - share) * lo_risk + share * hi_risk, lo, hi) AS place FROM choices)
  WHERE place = 1),
plan AS (
  SELECT asks.*,
         CASE WHEN budget <= 0 THEN 'NO_BUDGET'
              WHEN budget IS NULL OR asks.risk IS NULL OR horizon IS NULL THEN 'MISSING_INPUT'
              WHEN lo IS NULL THEN 'INFEASIBLE' ELSE 'OPTIMAL' END AS status,
         {_AMOUNTS}
  FROM asks LEFT JOIN best USING (client_id))"""


def _weighted(field: str) -> str:
    total = "(" + " + ".join(f"{a.name} * {getattr(a, field)}" for a in ASSETS) + ")"
    return _half_up(total, 2)


ASKS_OF_FEATURES = """asks AS (
  SELECT client_id, monthly_disposable_income AS budget, risk_tolerance_score AS risk,
         investment_horizon AS horizon FROM features)"""

REQUESTS = """requests AS (
  SELECT client_id, monthly_income, risk_tolerance_score AS risk_score, investment_horizon,
         current_month_spend, spend_1_month_ago, spend_2_months_ago, smoothed_target_spend
  FROM series JOIN features USING (client_id) WHERE age = 1)"""

ASKS_OF_REQUESTS = """asks AS (
  SELECT client_id, monthly_income, smoothed_target_spend AS predicted_expense,
         monthly_income - smoothed_target_spend AS budget, risk_score AS risk,
         investment_horizon AS horizon FROM requests)"""

REQUESTS_ASKED = """asks AS (
  SELECT CAST(c_custkey AS VARCHAR) AS client_id,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS budget,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_nationkey % 12
              WHEN c_nationkey < 20 THEN c_nationkey % 4 END AS risk,
         CASE WHEN c_nationkey <> 13 THEN c_custkey % 11 END AS horizon
  FROM customer)"""

# All basic solutions over the assets that are rows; of equal ones that of the widest mix, as the hull has it.
ANY_ASSETS = f"""any_assets AS (
  SELECT p_brand || '/' || p_type || '/' || (p_size % 3) AS asset, (sum(p_partkey) % 997) / 1000.0::DOUBLE AS ret,
         (sum(p_size) % 97) / 8.0::DOUBLE AS risk,
         CASE WHEN sum(p_size) % 10 = 0 THEN -1 ELSE sum(p_size) % 10 END AS min_horizon
  FROM part GROUP BY p_brand, p_type, p_size % 3 HAVING sum(p_partkey) % 11 <> 0),
pairs AS (
  SELECT asset AS lo, asset AS hi, risk AS lo_risk, risk AS hi_risk, ret AS lo_ret, ret AS hi_ret, min_horizon FROM any_assets
  UNION ALL
  SELECT a.asset, b.asset, a.risk, b.risk, a.ret, b.ret, greatest(a.min_horizon, b.min_horizon)
  FROM any_assets a JOIN any_assets b ON a.risk < b.risk AND a.ret < b.ret),
kinds AS (SELECT DISTINCT risk, horizon FROM asks WHERE risk IS NOT NULL AND horizon IS NOT NULL),
mixes AS (
  SELECT kinds.risk, horizon, pairs.* EXCLUDE (min_horizon),
         CASE WHEN lo = hi THEN 0.0 ELSE (kinds.risk - lo_risk) / (hi_risk - lo_risk) END AS share
  FROM kinds JOIN pairs ON horizon >= min_horizon
   AND ((lo = hi AND lo_risk <= kinds.risk) OR (lo <> hi AND lo_risk < kinds.risk AND kinds.risk < hi_risk))),
chosen AS (
  SELECT * FROM mixes QUALIFY row_number() OVER (PARTITION BY risk, horizon ORDER BY
    round((1 - share) * lo_ret + share * hi_ret, 9) DESC, lo_risk, hi_risk DESC, lo, hi) = 1),
held AS (
  SELECT client_id, budget, share, lo, hi, lo_risk, hi_risk, lo_ret, hi_ret,
         CASE WHEN budget <= 0 THEN 'NO_BUDGET'
              WHEN budget IS NULL OR asks.risk IS NULL OR asks.horizon IS NULL THEN 'MISSING_INPUT'
              WHEN lo IS NULL THEN 'INFEASIBLE' ELSE 'OPTIMAL' END AS status,
         {_half_up("(budget * (1 - share))", 2)} AS lo_amount, {_half_up("(budget * share)", 2)} AS hi_amount
  FROM asks LEFT JOIN chosen ON chosen.risk = asks.risk AND chosen.horizon = asks.horizon)"""

RECOMMENDED = (*GOLD, ASKS_OF_FEATURES, ALLOCATION)
ADVISED = (*GOLD, SERIES, REQUESTS, ASKS_OF_REQUESTS, ALLOCATION)
_PORTFOLIO = f"""budget AS monthly_disposable_income, risk AS risk_tolerance_score,
       horizon AS investment_horizon, status, Savings, Bonds, ETFs, Crypto,
       {_weighted("annual_return")} AS expected_annual_return,
       {_weighted("risk")} AS expected_annual_risk"""
_RECOMMENDATION = f"SELECT client_id, {_PORTFOLIO} FROM plan"
_LONG = " UNION ALL ".join(
    f"SELECT client_id, '{a.name}' AS asset, {a.name} AS amount FROM plan" for a in ASSETS
)
_BUDGET_LEFT = _half_up("budget", 2, "1e-9")

# Subsets of at most two products, without the excluded pair.
BUNDLES = f"""products(n, product, revenue, risk_cost) AS (VALUES {", ".join(
    f"({i}, '{p.name}', {p.revenue}, {p.risk_cost})" for i, p in enumerate(CARD_PRODUCTS))}),
bundles AS (
  SELECT '' AS bundle, 0 AS revenue, 0 AS risk_cost
  UNION ALL SELECT product, revenue, risk_cost FROM products
  UNION ALL SELECT a.product || '+' || b.product, a.revenue + b.revenue, a.risk_cost + b.risk_cost
  FROM products a JOIN products b ON a.n < b.n
  WHERE NOT (a.product = 'Basic_Debit' AND b.product = 'Platinum_Travel'))"""

ROWS = """labelled AS (
  SELECT client_id, txn_month, current_month_spend,
         coalesce(spend_1_month_ago, 0) AS spend_1_month_ago,
         coalesce(spend_2_months_ago, 0) AS spend_2_months_ago,
         coalesce(spend_3_months_ago, 0) AS spend_3_months_ago,
         coalesce(avg_spend_last_3_months, 0) AS avg_spend_last_3_months,
         smoothed_target_spend,
         lead(smoothed_target_spend) OVER (PARTITION BY client_id ORDER BY txn_month)
           AS next_smoothed_spend,
         age <= 2 AS is_test,
         age BETWEEN 2 AND 3 AS is_test_next
  FROM series)"""

TRAINING = (LINES, MONTHS, SERIES, ROWS)

CONTRACT = """records AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id,
         CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'no date'
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS date,
         CAST(o_totalprice * 4 AS DECIMAL(18,2)) AS amount,
         upper(o_orderpriority) AS merchant_name,
         CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus ELSE 'Uncategorized' END AS category
  FROM orders),
judged AS (
  SELECT *, concat_ws('; ',
           CASE WHEN transaction_id IS NULL THEN 'missing transaction_id' END,
           CASE WHEN date = 'no date' THEN 'invalid date' END,
           CASE WHEN amount > 1000000 OR amount < -1000000 THEN 'amount out of range' END) AS reason
  FROM records)"""


# The first reason for which cleaning drops a raw row, in the order in which they are asked.
JUDGED = """judged_lines AS (
  SELECT date, card_id,
         CASE WHEN l_tax = 0.08 THEN 'malformed line'
              WHEN l_tax = 0.05 AND l_returnflag = 'N' THEN 'missing id'
              WHEN l_tax = 0.04 AND l_returnflag = 'R' THEN 'missing client'
              WHEN l_tax = 0.07 THEN 'amount is no number'
              WHEN l_tax = 0.06 AND l_returnflag = 'A' THEN 'amount out of bounds'
              WHEN abs(amount) >= 1000000 THEN 'amount out of bounds' END AS reason
  FROM lines)"""
JUDGED_USERS = """judged_users AS (
  SELECT address,
         CASE retirement_age - current_age WHEN 3 THEN 'mistyped field' WHEN 7 THEN 'missing id'
              WHEN 5 THEN 'yearly income is no number' END AS reason
  FROM users)"""


def _query(ctes: tuple[str, ...], body: str) -> str:
    return f"WITH {', '.join(ctes)}\n{body}"


_SERIES_COLUMNS = (
    "client_id, txn_month, current_month_spend, spend_1_month_ago, spend_2_months_ago, "
    "spend_3_months_ago, avg_spend_last_3_months"
)
_CITY = "merchant_city || CASE WHEN l_tax = 0.08 THEN ', West' ELSE '' END AS merchant_city"
_SILVER_COLUMNS = (
    "mcc, id, date, client_id, card_id, amount, use_chip, merchant_id, merchant_city, "
    "merchant_state, zip, errors, category_name"
)
_CLEANED = _query(
    (LINES,),
    f"SELECT {_SILVER_COLUMNS.replace('merchant_city', _CITY)} FROM lines WHERE abs(amount) < 1000000 AND {_KEPT}",
)
_SILVER = _query(
    (LINES,), f"SELECT {_SILVER_COLUMNS} FROM lines WHERE abs(amount) < 1000000 AND {_KEPT} AND l_tax <> 0.08"
)
_TIME_SERIES = _query((LINES, MONTHS, SERIES), f"SELECT {_SERIES_COLUMNS} FROM series")
_MONTHLY = _query(
    (LINES, MONTHS),
    "SELECT client_id, txn_month, CAST(spend AS DOUBLE) AS current_month_spend FROM months",
)
_WITH_USERS = _query(
    (LINES, USERS, DIRTY_USERS),
    f"SELECT lines.{_SILVER_COLUMNS.replace(' id,', ' lines.id AS transaction_id,')}, "
    "current_age, retirement_age, birth_year, birth_month, gender, address, latitude, longitude, "
    "per_capita_income, yearly_income, total_debt, credit_score, num_credit_cards "
    "FROM lines LEFT JOIN dirty_users ON client_id = dirty_users.id",
)
_SNAPSHOTS = _query(
    (*GOLD, SERIES, REQUESTS),
    "SELECT client_id, round(monthly_income, 6) AS monthly_income, risk_score, "
    "investment_horizon, current_month_spend, spend_1_month_ago, spend_2_months_ago FROM requests",
)


def _calendar(gap: str, mean: str) -> str:
    """Features by the calendar from a self-join of the months on their numbers."""
    ago = ", ".join(
        f"CAST(coalesce(max(spend) FILTER (back = {n}), {gap}) AS DOUBLE) AS {name}"
        for n, name in ((1, "spend_1_month_ago"), (2, "spend_2_months_ago"), (3, "spend_3_months_ago"))
    )
    value = f"coalesce(CAST({mean} AS DOUBLE), {gap})"
    return _query(
        (
            LINES,
            MONTHS,
            "placed AS (SELECT *, CAST(substr(txn_month, 1, 4) AS INTEGER) * 12 + CAST(substr(txn_month, 6) AS INTEGER) AS place "
            "FROM months)",
            "pairs AS (SELECT a.client_id, a.txn_month, a.spend AS own, a.place - b.place AS back, b.spend FROM placed a "
            "LEFT JOIN placed b ON a.client_id = b.client_id AND a.place - b.place BETWEEN 1 AND 3)",
        ),
        f"SELECT client_id, txn_month, CAST(own AS DOUBLE) AS current_month_spend, {ago}, "
        f"{_half_up(value, 2)} AS avg_spend_last_3_months FROM pairs GROUP BY client_id, txn_month, own",
    )


def _supervised(features: str, naive: str, label: str, flag: str) -> str:
    return _query(
        TRAINING,
        f"SELECT client_id, txn_month, {features}, {naive} AS naive, {label} AS label, "
        f"{flag} AS is_test FROM labelled WHERE {label} IS NOT NULL",
    )


def _naive(target: str, naive: str, label: str, flag: str) -> str:
    error = f"abs({label} - {naive})"
    return (
        f"SELECT '{target}' AS target, count(*) AS rows, round(avg({error}), 6) AS mae, "
        f"round(avg({error} / greatest(abs({label}), 2.220446049250313e-16)), 6) AS mape "
        f"FROM labelled WHERE {flag} AND {label} IS NOT NULL"
    )


def _report(target: str, naive: str, label: str, flag: str) -> str:
    return (
        f"SELECT '{target}' AS target, count(*) FILTER (NOT {flag}) AS train_rows, "
        f"count(*) FILTER ({flag}) AS test_rows, "
        f"round(avg(abs({label} - {naive})) FILTER ({flag}), 6) AS naive_mae, TRUE AS beats_naive "
        f"FROM labelled WHERE {label} IS NOT NULL"
    )


_TARGETS = (
    ("raw", "spend_1_month_ago", "current_month_spend", "is_test"),
    ("smoothed", "spend_1_month_ago", "smoothed_target_spend", "is_test"),
    ("next", "smoothed_target_spend", "next_smoothed_spend", "is_test_next"),
)
_RECENT_FEATURES = "current_month_spend, spend_1_month_ago, spend_2_months_ago"
_LAG_FEATURES = (
    "spend_1_month_ago, spend_2_months_ago, spend_3_months_ago, avg_spend_last_3_months"
)

ORACLE: dict[str, str] = {
    "financial_overview": _query(
        (*RECOMMENDED, SERIES),
        f"SELECT client_id, round(avg_monthly_spend, 6) AS avg_monthly_spend, "
        "round(avg_monthly_discretionary, 6) AS avg_monthly_discretionary, "
        f"discretionary_spend_ratio, current_month_spend, spend_1_month_ago, spend_2_months_ago, "
        f"{_PORTFOLIO} FROM plan JOIN features USING (client_id) JOIN series USING (client_id) "
        "WHERE age = 1",
    ),
    "csv_transactions": _query(
        (LINES,),
        "SELECT CASE WHEN l_tax = 0.05 AND l_returnflag = 'N' THEN NULL ELSE id END AS id, date, "
        "CASE WHEN l_tax = 0.04 AND l_returnflag = 'R' THEN NULL ELSE client_id END AS client_id, card_id, "
        "CASE WHEN l_tax = 0.07 THEN 'n/a' WHEN l_tax = 0.06 AND l_returnflag = 'A' THEN '$1000000.00' "
        "ELSE '$' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) END AS amount, use_chip, merchant_id, "
        "merchant_city, merchant_state, zip, mcc, errors FROM lines WHERE l_tax <> 0.08",
    ),
    "csv_users": _query((USERS, DIRTY_USERS), "SELECT * FROM dirty_users"),
    "csv_inferred": _query(
        (USERS,),
        "SELECT CAST(id AS INTEGER) AS id, current_age, retirement_age, birth_year, birth_month, gender, "
        "address, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
        + ", ".join(
            f"'$' || CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR) AS {c}"
            for c in ("per_capita_income", "yearly_income", "total_debt")
        )
        + ", credit_score, num_credit_cards FROM users",
    ),
    "rejected_transactions": _query(
        (LINES, JUDGED), "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS rows FROM judged_lines GROUP BY 1"
    ),
    "rejected_users": _query(
        (USERS, JUDGED_USERS), "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS rows FROM judged_users GROUP BY 1"
    ),
    "transactions_judged": _query(
        (LINES, JUDGED), "SELECT date, card_id, reason FROM judged_lines WHERE reason IS NOT NULL"
    ),
    "users_judged": _query(
        (USERS, JUDGED_USERS), "SELECT address, reason FROM judged_users WHERE reason IS NOT NULL"
    ),
    "csv_to_silver": _SILVER,
    "table_overwrite": _MONTHLY,
    "table_partitioned": _query((LINES,), f"SELECT {_SILVER_COLUMNS}, txn_month FROM lines"),
    "snapshot_of_missing_profiles": _query(
        (LINES, MONTHS, USERS, DIRTY_USERS),
        "SELECT DISTINCT client_id, 'none yet' AS profiles FROM months UNION ALL "
        "SELECT DISTINCT client_id, 'written' AS profiles FROM months "
        "WHERE client_id NOT IN (SELECT id FROM dirty_users)",
    ),
    "silver_transactions": _CLEANED,
    "silver_transactions_salted": _CLEANED,
    "silver_users": _query((USERS,), "SELECT * FROM users"),
    "timestamps_parsed": _query((LINES,), "SELECT id, date FROM lines"),
    "contract_valid": _query(
        (CONTRACT,),
        "SELECT transaction_id, date, CAST(amount AS DOUBLE) AS amount, merchant_name, category "
        "FROM judged WHERE reason = ''",
    ),
    "contract_rejected": _query(
        (CONTRACT,),
        "SELECT transaction_id, date AS raw_date, CAST(amount AS VARCHAR) AS raw_amount, "
        "chr(9) || ' ' || lower(merchant_name) || ' ' || chr(10) AS raw_merchant_name, category, reason "
        "FROM judged WHERE reason <> ''",
    ),
    "discretionary_tags": _query(
        (LINES,),
        f"SELECT id, category_name, abs(amount) AS expense_amount, CASE WHEN category_name IN "
        f"({_quoted(DISCRETIONARY_CATEGORIES)}) THEN abs(amount) ELSE 0.0 END AS is_discretionary "
        "FROM lines WHERE amount < 0",
    ),
    "transactions_with_users": _WITH_USERS,
    "transactions_with_users_salted": _WITH_USERS,
    "monthly_spend": _MONTHLY,
    "time_series_features": _TIME_SERIES,
    "time_series_min_history": _query(
        (LINES, MONTHS, SERIES), f"SELECT {_SERIES_COLUMNS} FROM series WHERE position > 2"
    ),
    "smoothed_spend": _query(
        (LINES, MONTHS, SERIES),
        "SELECT client_id, txn_month, current_month_spend, smoothed_target_spend FROM series",
    ),
    "calendar_features": _calendar("NULL", "avg(spend)"),
    "calendar_features_filled": _calendar("0", "sum(spend) / 3"),
    "distinct_clients_by_year": _query(
        (LINES,),
        "SELECT CAST(substr(date, 1, 4) AS INTEGER) AS year, count(*) AS rows, count(DISTINCT client_id) AS clients, "
        "count(DISTINCT merchant_id) AS merchants, TRUE AS clients_within_error, TRUE AS merchants_within_error "
        "FROM lines GROUP BY 1",
    ),
    "client_net_amount": _query(
        (LINES,),
        "SELECT client_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS net_amount "
        "FROM lines GROUP BY 1",
    ),
    "client_spend_totals": _query((LINES, MONTHS, TOTALS), "SELECT * FROM totals"),
    "category_spend_profile": _query(
        (LINES,),
        "SELECT category_name, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spent "
        "FROM lines WHERE amount < 0 GROUP BY 1 ORDER BY 2, 1 LIMIT 30",
    ),
    "top_transactions": _query(
        (LINES,), "SELECT id, client_id, amount FROM lines ORDER BY amount DESC, id LIMIT 5"
    ),
    "user_portfolio_features": _query(
        GOLD,
        "SELECT * REPLACE (round(avg_monthly_spend, 6) AS avg_monthly_spend, "
        "round(avg_monthly_discretionary, 6) AS avg_monthly_discretionary, "
        "round(monthly_income, 6) AS monthly_income) FROM features",
    ),
    "top_discretionary_users": _query(
        GOLD,
        "SELECT client_id, round(avg_monthly_discretionary, 6) AS avg_monthly_discretionary, "
        "risk_tolerance_score FROM features "
        "ORDER BY features.avg_monthly_discretionary DESC, client_id LIMIT 50",
    ),
    "portfolio_recommendations": _query(RECOMMENDED, _RECOMMENDATION),
    "allocation_statuses": _query(
        (
            REQUESTS_ASKED,
            ALLOCATION,
        ),
        "SELECT client_id, status, "
        + ", ".join(f"CASE WHEN status IN ('OPTIMAL', 'NO_BUDGET') THEN {a.name} END AS {a.name}" for a in ASSETS)
        + " FROM plan",
    ),
    "allocation_rows": _query(RECOMMENDED, _LONG),
    "positive_allocations": _query(RECOMMENDED, f"SELECT * FROM ({_LONG}) WHERE amount > 0"),
    "portfolio_return_and_risk": _query(
        RECOMMENDED,
        f"SELECT client_id, {_weighted('annual_return')} AS expected_annual_return, "
        f"{_weighted('risk')} AS expected_annual_risk FROM plan WHERE status = 'OPTIMAL'",
    ),
    "any_asset_holdings": _query(
        (REQUESTS_ASKED, ANY_ASSETS),
        "SELECT client_id, status, lo AS asset, lo_amount AS amount FROM held WHERE status = 'OPTIMAL' "
        "UNION ALL SELECT client_id, status, hi, hi_amount FROM held WHERE status = 'OPTIMAL' AND lo <> hi "
        "UNION ALL SELECT client_id, status, NULL, NULL FROM held WHERE status <> 'OPTIMAL'",
    ),
    "any_asset_return_and_risk": _query(
        (REQUESTS_ASKED, ANY_ASSETS),
        "SELECT client_id, status, CASE status WHEN 'OPTIMAL' THEN "
        + _half_up("(lo_amount * lo_ret + CASE WHEN lo <> hi THEN hi_amount * hi_ret ELSE 0 END)", 2)
        + " WHEN 'NO_BUDGET' THEN 0 END AS expected_annual_return, CASE status WHEN 'OPTIMAL' THEN "
        + _half_up("(lo_amount * lo_risk + CASE WHEN lo <> hi THEN hi_amount * hi_risk ELSE 0 END)", 2)
        + " WHEN 'NO_BUDGET' THEN 0 END AS expected_annual_risk FROM held",
    ),
    "card_offers": _query(
        (
            USERS,
            BUNDLES,
            "budgets AS (SELECT id AS client_id, credit_score - total_debt / "
            "nullif(yearly_income, 0) * 50 AS budget FROM users)",
            "ranked AS (SELECT client_id, budget, bundle, revenue, risk_cost, row_number() OVER "
            "(PARTITION BY client_id ORDER BY revenue DESC, risk_cost, bundle) AS place "
            "FROM budgets LEFT JOIN bundles ON risk_cost <= budget)",
        ),
        "SELECT client_id, round(budget, 6) AS risk_budget, CASE WHEN budget IS NULL THEN "
        "'MISSING_INPUT' WHEN bundle IS NULL THEN 'INFEASIBLE' ELSE 'OPTIMAL' END AS status, "
        "bundle, revenue, risk_cost FROM ranked WHERE place = 1",
    ),
    "any_card_offers": _query(
        (
            USERS,
            """cards AS (
  SELECT p_size % 30 AS n, 'Card_' || (p_size % 30) AS product, 50 + sum(p_partkey) % 400 AS revenue,
         60 + sum(p_partkey) % 289 AS risk_cost
  FROM part GROUP BY p_size % 30),
allowed AS (SELECT a.n AS a, b.n AS b FROM cards a JOIN cards b ON a.n < b.n WHERE b.n <> a.n + 1 AND a.n + b.n <> 35),
any_bundles AS (
  SELECT '' AS bundle, 0 AS revenue, 0 AS risk_cost
  UNION ALL SELECT product, revenue, risk_cost FROM cards
  UNION ALL SELECT x.product || '+' || y.product, x.revenue + y.revenue, x.risk_cost + y.risk_cost
  FROM allowed JOIN cards x ON x.n = a JOIN cards y ON y.n = b
  UNION ALL SELECT x.product || '+' || y.product || '+' || z.product, x.revenue + y.revenue + z.revenue,
                   x.risk_cost + y.risk_cost + z.risk_cost
  FROM allowed p JOIN allowed q ON q.a = p.b JOIN allowed r ON r.a = p.a AND r.b = q.b
  JOIN cards x ON x.n = p.a JOIN cards y ON y.n = p.b JOIN cards z ON z.n = q.b)""",
            "budgets AS (SELECT id AS client_id, credit_score - total_debt / "
            "nullif(yearly_income, 0) * 50 AS budget FROM users)",
            "ranked AS (SELECT client_id, budget, bundle, revenue, risk_cost, row_number() OVER "
            "(PARTITION BY client_id ORDER BY revenue DESC, risk_cost, bundle) AS place "
            "FROM budgets LEFT JOIN any_bundles ON risk_cost <= budget)",
        ),
        "SELECT client_id, round(budget, 6) AS risk_budget, CASE WHEN budget IS NULL THEN "
        "'MISSING_INPUT' WHEN bundle IS NULL THEN 'INFEASIBLE' ELSE 'OPTIMAL' END AS status, "
        "bundle, CAST(revenue AS BIGINT) AS revenue, CAST(risk_cost AS BIGINT) AS risk_cost FROM ranked WHERE place = 1",
    ),
    "client_ids": _query((LINES, MONTHS), "SELECT DISTINCT client_id FROM months"),
    "table_counts": _query(
        GOLD,
        "SELECT (SELECT count(DISTINCT client_id) FROM months) AS clients, "
        "(SELECT count(*) FROM months) AS series_rows, "
        "(SELECT count(*) FROM features) AS profile_rows",
    ),
    "latest_month": _query(
        (LINES, MONTHS, SERIES), f"SELECT {_SERIES_COLUMNS} FROM series WHERE age = 1"
    ),
    "client_snapshots": _SNAPSHOTS,
    "client_snapshots_one_pass": _SNAPSHOTS,
    "client_snapshots_as_of": _query(
        (*GOLD, SERIES, """asks AS (
  SELECT CAST(o_custkey AS VARCHAR) AS client_id, strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m') AS as_of_month
  FROM orders WHERE o_orderstatus = 'P')"""),
        "SELECT asks.client_id, as_of_month, txn_month, round(monthly_income, 6) AS monthly_income, "
        "risk_tolerance_score AS risk_score, investment_horizon, current_month_spend, spend_1_month_ago, "
        "spend_2_months_ago FROM asks ASOF JOIN series "
        "ON asks.client_id = series.client_id AND asks.as_of_month >= series.txn_month "
        "JOIN features ON features.client_id = asks.client_id",
    ),
    "client_lookup": _query(
        (LINES, MONTHS, SERIES),
        f"SELECT {_SERIES_COLUMNS} FROM series WHERE client_id = (SELECT min(client_id) FROM months)",
    ),
    "clients_without_history": _query(
        (LINES, USERS, MONTHS),
        "SELECT id AS client_id FROM users WHERE id NOT IN "
        "(SELECT client_id FROM months WHERE txn_month < '1993-01')",
    ),
    "client_histories": _TIME_SERIES,
    "spend_trend": _query(
        (LINES, MONTHS, SERIES), "SELECT client_id, txn_month, smoothed_target_spend FROM series"
    ),
    "top_spender_history": _query(
        (LINES, MONTHS, SERIES),
        f"SELECT {_SERIES_COLUMNS} FROM series WHERE client_id = (SELECT client_id FROM months "
        "GROUP BY client_id ORDER BY sum(spend) DESC, client_id LIMIT 1)",
    ),
    "advisor_plan": _query(
        ADVISED,
        f"SELECT client_id, round(monthly_income, 6) AS monthly_income, predicted_expense, "
        f"{_BUDGET_LEFT} AS safe_investable_budget, status, Savings, Bonds, ETFs, Crypto FROM plan",
    ),
    "advisor_responses": _query(
        ADVISED,
        f"SELECT client_id, round(monthly_income, 6) AS monthly_income, predicted_expense, "
        f"{_BUDGET_LEFT} AS safe_investable_budget, status, Savings, Bonds, ETFs, Crypto FROM plan",
    ),
    "advisor_plan_model": _query(
        ADVISED, "SELECT client_id, round(monthly_income, 6) AS monthly_income FROM plan"
    ),
    "advisor_display": _query(
        ADVISED,
        "SELECT client_id, "
        + ", ".join(
            f"'$' || format('{{:,.2f}}', {value}) AS {name}"
            for name, value in (
                ("monthly_income", "monthly_income"),  # formatted from the unrounded value
                ("predicted_expense", "predicted_expense"),
                ("safe_investable_budget", _BUDGET_LEFT),
            )
        )
        + " FROM plan",
    ),
    "lags_filled": _query(TRAINING, f"SELECT {_SERIES_COLUMNS} FROM labelled"),
    "holdout_split": _query(
        TRAINING,
        "SELECT client_id, txn_month, smoothed_target_spend, next_smoothed_spend, is_test, "
        "is_test_next FROM labelled",
    ),
    "supervised_raw": _supervised(
        _LAG_FEATURES, "spend_1_month_ago", "current_month_spend", "is_test"
    ),
    "supervised_smoothed": _supervised(
        _RECENT_FEATURES, "spend_1_month_ago", "smoothed_target_spend", "is_test"
    ),
    "supervised_next": _supervised(
        _RECENT_FEATURES, "smoothed_target_spend", "next_smoothed_spend", "is_test_next"
    ),
    "naive_errors": _query(
        TRAINING,
        " UNION ALL ".join(
            _naive(*t) for t in _TARGETS
        ),
    ),
    "time_folds": _query(
        (
            *TRAINING,
            "per_month AS (SELECT txn_month, count(*) AS n FROM labelled WHERE NOT is_test GROUP BY 1)",
            "numbered AS (SELECT txn_month, n, row_number() OVER (ORDER BY txn_month) AS position, "
            "count(*) OVER () AS months FROM per_month)",
            "folds(fold) AS (VALUES (1), (2), (3))",
            "cut AS (SELECT fold, txn_month, n, position, months - (4 - fold) * (months // 4) AS t, "
            "months // 4 AS b FROM numbered CROSS JOIN folds)",
        ),
        "SELECT fold, max(txn_month) FILTER (position <= t) AS train_end, "
        "min(txn_month) FILTER (position > t) AS test_start, "
        "max(txn_month) FILTER (position > t) AS test_end, "
        "CAST(sum(n) FILTER (position <= t) AS BIGINT) AS train_rows, "
        "CAST(sum(n) FILTER (position > t) AS BIGINT) AS test_rows "
        "FROM cut WHERE position <= t + b GROUP BY fold",
    ),
    "forecast_scores": _query(
        TRAINING,
        "SELECT client_id, txn_month, smoothed_target_spend AS label, spend_1_month_ago AS naive, is_test "
        "FROM labelled WHERE smoothed_target_spend IS NOT NULL",
    ),
    "forecast_report": _query(TRAINING, " UNION ALL ".join(_report(*t) for t in _TARGETS)),
    "forecast_runs": _query(
        TRAINING,
        " UNION ALL ".join(
            f"SELECT 'spend_forecaster' AS run_name, target, '{trees}' AS trees, '{depth}' AS depth, "
            f"'0.1' AS rate, train_rows, test_rows, naive_mae FROM ({_report(*t)})"
            for t, trees, depth in ((_TARGETS[1], 200, 6), (_TARGETS[2], 100, 4))
        ),
    ),
    "grid_search": "SELECT * FROM (VALUES (3), (4), (6)) a(max_depth), (VALUES (0.01::DOUBLE), (0.1::DOUBLE)) b(step_size), "
    "(VALUES (100), (200)) c(trees)",
    "daily_refresh": _query(RECOMMENDED, _RECOMMENDATION),
    "daily_refresh_bucketed": _TIME_SERIES,
    "stream_silver": _SILVER,
    "stream_distinct": _query(
        (LINES,),
        f"SELECT DISTINCT id, date, client_id FROM lines WHERE abs(amount) < 1000000 AND {_KEPT} AND l_tax <> 0.08 "
        # held back until they were too late
        "AND NOT (merchant_state = 'S3' AND date BETWEEN '1996' AND '1997')",
    ),
    "incremental_months": _query(
        (LINES, f"silver AS (SELECT * FROM lines WHERE abs(amount) < 1000000 AND {_KEPT} AND l_tax <> 0.08)",
         MONTHS.replace("FROM lines", "FROM silver")),
        "SELECT client_id, txn_month, CAST(spend AS DOUBLE) AS spend, CAST(discretionary AS DOUBLE) AS discretionary FROM months",
    ),
    "incremental_features": _TIME_SERIES,
}
