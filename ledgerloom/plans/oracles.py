"""Independent DuckDB SQL for every registered query.

Each oracle starts from the same fixture mapping (FIXTURES.md) written as CTEs
over the pre-registered views, then states the operator in plain SQL the way
the reference computes it (e.g. the monthly closing balance as a range join
plus sum, SCD2 keys as a global ``row_number``).  Column names and types match
the Spark side so the value hashes can agree.
"""

from __future__ import annotations

from ..sources import seeds

INGESTED = "TIMESTAMP '2026-01-01 00:00:00'"


def band_sql(dob: str, as_of: str = "DATE '2026-01-01'") -> str:
    start = f"CAST(floor(floor(date_diff('day', {dob}, {as_of}) / 365.25) / 10) * 10 AS INTEGER)"
    return f"(CAST({start} AS VARCHAR) || '-' || CAST({start} + 9 AS VARCHAR))"


def _mask(c: str) -> str:
    return f"('****' || right({c}, 4))"


def _dedupe(src: str, key: str, order: str) -> str:
    return f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


_ACCOUNT_COLS = """
    'A' || CAST(o_orderkey AS VARCHAR) AS account_id,
    CASE WHEN o_orderkey % 97 = 0 THEN 'U-missing' ELSE 'U' || CAST(o_custkey AS VARCHAR) END AS user_id,
    {priority} AS account_type,
    'GB' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS account_number,
    CAST(o_orderdate AS DATE) AS opened_date,
    TIMESTAMP '2026-01-01 00:00:00' AS _ingested_at"""

CHANGED_PRIORITY = (
    "CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority "
    "WHEN o_orderpriority = '5-LOW' THEN '1-URGENT' ELSE '5-LOW' END"
)

BASE = {
    "b_users": f"""
  SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id,
         c_name AS full_name,
         lower(c_name) || '@example.com' AS email,
         DATE '1945-01-01' + CAST((c_custkey * 7919) % 20000 AS INTEGER) AS date_of_birth,
         'Nation ' || CAST(c_nationkey AS VARCHAR) AS address,
         DATE '1990-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS signup_date,
         {INGESTED} AS _ingested_at
  FROM customer""",
    "b_accounts": f"SELECT {_ACCOUNT_COLS.format(priority='o_orderpriority')} FROM orders",
    "b_transactions": """
  SELECT 'T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         'A' || CAST(l_orderkey AS VARCHAR) AS account_id,
         l_returnflag || l_linestatus AS transaction_type,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS amount,
         'GBP' AS currency,
         l_shipdate AS transaction_ts,
         l_shipdate AS _ingested_at,
         l_partkey AS _src_partkey,
         l_suppkey AS _src_suppkey
  FROM lineitem""",
    "b_goals": f"""
  SELECT 'G' || CAST(c_custkey AS VARCHAR) AS goal_id,
         'U' || CAST(c_custkey AS VARCHAR) AS user_id,
         '  ' || c_mktsegment || ' ' AS goal_name,
         CASE WHEN c_custkey % 11 = 0 THEN CAST(0 AS DECIMAL(10,2))
              ELSE CAST(CAST(abs(c_acctbal) AS DECIMAL(10,2)) + 500 AS DECIMAL(10,2)) END AS target_amount,
         CAST(abs(c_acctbal) AS DECIMAL(10,2)) AS current_amount,
         DATE '1990-01-01' + CAST(c_custkey % 1500 AS INTEGER) + 30 AS created_date,
         DATE '1990-01-01' + CAST(c_custkey % 1500 AS INTEGER) + 395 AS target_date,
         {INGESTED} AS _ingested_at
  FROM customer""",
    "account_types": seeds.seed_values_sql(
        seeds.FIXTURE_ACCOUNT_TYPES, ["account_type_id", "type_name", "category", "description"]
    ),
    "transaction_types": seeds.seed_values_sql(
        seeds.FIXTURE_TRANSACTION_TYPES, ["transaction_type_id", "type_name", "direction", "description"]
    ),
    "d_users": _dedupe("b_users", "user_id", "_ingested_at DESC, user_id DESC"),
    "s_users": f"SELECT user_id, {band_sql('date_of_birth')} AS age_band, signup_date FROM d_users",
    "d_accounts": _dedupe("b_accounts", "account_id", "_ingested_at DESC, account_id DESC"),
    "t_accounts": """
  SELECT d.*, aty.account_type_id,
         CASE WHEN aty.account_type_id IS NULL THEN 'bad_type' WHEN p.pk IS NULL THEN 'orphan' END AS reason
  FROM d_accounts d
  LEFT JOIN account_types aty ON d.account_type = aty.type_name
  LEFT JOIN (SELECT DISTINCT user_id AS pk FROM s_users) p ON d.user_id = p.pk""",
    "s_accounts": f"""
  SELECT account_id, user_id, account_type_id, {_mask('account_number')} AS account_number_masked, opened_date
  FROM t_accounts WHERE reason IS NULL""",
    "d_transactions": _dedupe(
        "b_transactions", "transaction_id", "_ingested_at DESC, _src_partkey DESC, _src_suppkey DESC"
    ),
    "t_transactions": """
  SELECT d.*, tty.transaction_type_id,
         CASE WHEN tty.transaction_type_id IS NULL THEN 'bad_type' WHEN p.pk IS NULL THEN 'orphan' END AS reason
  FROM d_transactions d
  LEFT JOIN transaction_types tty ON d.transaction_type = tty.type_name
  LEFT JOIN (SELECT DISTINCT account_id AS pk FROM s_accounts) p ON d.account_id = p.pk""",
    "s_transactions": """
  SELECT transaction_id, account_id, transaction_type_id, amount, currency, transaction_ts
  FROM t_transactions WHERE reason IS NULL""",
    "d_goals": _dedupe("b_goals", "goal_id", "_ingested_at DESC, goal_id DESC"),
    "t_goals": """
  SELECT d.*, CASE WHEN p.pk IS NULL THEN 'orphan' END AS reason
  FROM d_goals d LEFT JOIN (SELECT DISTINCT user_id AS pk FROM s_users) p ON d.user_id = p.pk""",
    "s_goals": """
  SELECT goal_id, user_id, trim(goal_name) AS goal_name, target_amount, current_amount, created_date, target_date
  FROM t_goals WHERE reason IS NULL""",
    "account_summary": """
  SELECT a.account_id, a.user_id, aty.type_name AS account_type, a.opened_date,
         CAST(coalesce(g.total_inflows, 0) AS DECIMAL(20,2)) AS total_inflows,
         CAST(coalesce(g.total_outflows, 0) AS DECIMAL(20,2)) AS total_outflows,
         CAST(coalesce(g.total_inflows, 0) - coalesce(g.total_outflows, 0) AS DECIMAL(20,2)) AS balance,
         CAST(coalesce(g.transaction_count, 0) AS BIGINT) AS transaction_count,
         g.first_transaction_ts, g.last_transaction_ts
  FROM s_accounts a
  JOIN account_types aty ON a.account_type_id = aty.account_type_id
  LEFT JOIN (
    SELECT t.account_id,
           sum(CASE WHEN tty.direction = 'inflow' THEN t.amount END) AS total_inflows,
           sum(CASE WHEN tty.direction = 'outflow' THEN t.amount END) AS total_outflows,
           count(*) AS transaction_count,
           min(t.transaction_ts) AS first_transaction_ts,
           max(t.transaction_ts) AS last_transaction_ts
    FROM s_transactions t JOIN transaction_types tty ON t.transaction_type_id = tty.transaction_type_id
    GROUP BY t.account_id
  ) g ON a.account_id = g.account_id""",
}


def pct_sql(num: str, den: str) -> str:
    """round(num/den*100, 1) HALF_UP in exact integer arithmetic (num >= 0, den > 0)."""
    n = f"CAST(({num}) * 100 AS HUGEINT)"
    d = f"CAST(({den}) * 100 AS HUGEINT)"
    return f"CAST(((2000 * {n} + {d}) // (2 * {d})) / 10.0 AS DECIMAL(18,1))"


def with_base(final: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(BASE)
    if extra:
        ctes.update(extra)
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{final}"


ORACLES: dict[str, str] = {}


def oracle(name: str, final: str, extra: dict[str, str] | None = None) -> None:
    ORACLES[name] = with_base(final, extra)


# --- silver ---------------------------------------------------------------
oracle("dedupe_latest", "SELECT * FROM d_transactions")
oracle("conform_users", "SELECT * FROM s_users")
_GAPS = {
    "gaps": """
  SELECT CASE WHEN n % 50 <> 0 THEN user_id END AS user_id, _ingested_at, signup_date,
         CASE WHEN n % 70 <> 0 THEN CAST(date_of_birth AS VARCHAR) ELSE 'unknown' END AS date_of_birth
  FROM (SELECT *, CAST(user_id[2:] AS BIGINT) AS n FROM b_users)""",
}
oracle(
    "conform_users_gaps",
    f"SELECT user_id, {band_sql('TRY_CAST(date_of_birth AS DATE)')} AS age_band, signup_date FROM gaps WHERE user_id IS NOT NULL",
    _GAPS,
)
oracle(
    "reject_users",
    "SELECT user_id, date_of_birth, signup_date, _ingested_at, 'null_key' AS reason FROM gaps WHERE user_id IS NULL",
    _GAPS,
)
oracle("conform_accounts", "SELECT * FROM s_accounts")
oracle(
    "reject_accounts",
    "SELECT account_id, user_id, account_type, account_number, opened_date, _ingested_at, reason "
    "FROM t_accounts WHERE reason IS NOT NULL",
)
oracle("conform_transactions", "SELECT * FROM s_transactions")
oracle(
    "reject_transactions",
    "SELECT transaction_id, account_id, transaction_type, amount, currency, transaction_ts, _ingested_at, "
    "_src_partkey, _src_suppkey, reason FROM t_transactions WHERE reason IS NOT NULL",
)
oracle("conform_goals", "SELECT * FROM s_goals")

# --- marts ----------------------------------------------------------------
oracle("account_summary", "SELECT * FROM account_summary")
C360_SQL = f"""
SELECT u.user_id, u.age_band, u.signup_date,
       CAST(coalesce(a.num_accounts, 0) AS BIGINT) AS num_accounts,
       CAST(coalesce(a.total_balance, 0) AS DECIMAL(20,2)) AS total_balance,
       CAST(coalesce(a.total_inflows, 0) AS DECIMAL(20,2)) AS total_inflows,
       CAST(coalesce(a.total_outflows, 0) AS DECIMAL(20,2)) AS total_outflows,
       CAST(coalesce(g.num_savings_goals, 0) AS BIGINT) AS num_savings_goals,
       CAST(coalesce(g.total_target_amount, 0) AS DECIMAL(20,2)) AS total_target_amount,
       CAST(coalesce(g.total_saved_toward_goals, 0) AS DECIMAL(20,2)) AS total_saved_toward_goals,
       CASE WHEN coalesce(g.total_target_amount, 0) > 0
            THEN {pct_sql('g.total_saved_toward_goals', 'g.total_target_amount')} END AS goal_progress_pct
FROM s_users u
LEFT JOIN (SELECT user_id, count(*) AS num_accounts, sum(balance) AS total_balance,
                  sum(total_inflows) AS total_inflows, sum(total_outflows) AS total_outflows
           FROM account_summary GROUP BY user_id) a ON u.user_id = a.user_id
LEFT JOIN (SELECT user_id, count(*) AS num_savings_goals, sum(target_amount) AS total_target_amount,
                  sum(current_amount) AS total_saved_toward_goals
           FROM s_goals GROUP BY user_id) g ON u.user_id = g.user_id"""
oracle("customer_360", C360_SQL)

# --- calendar and star ------------------------------------------------------
STAR = {
    "bounds": """
  SELECT CAST(date_trunc('month', min(d)) AS DATE) AS "start", last_day(max(d)) AS "end"
  FROM (SELECT CAST(transaction_ts AS DATE) AS d FROM s_transactions
        UNION ALL SELECT opened_date FROM s_accounts
        UNION ALL SELECT signup_date FROM s_users)""",
    "days": """
  SELECT CAST(g.d AS DATE) AS d
  FROM bounds, unnest(generate_series(CAST(bounds."start" AS TIMESTAMP), CAST(bounds."end" AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS g(d)""",
    "acct_input": """
  SELECT a.account_id, a.user_id, a.account_number_masked, a.opened_date,
         aty.type_name AS account_type, aty.category AS account_type_category
  FROM s_accounts a JOIN account_types aty ON a.account_type_id = aty.account_type_id""",
    "dim_customer": f"""
  SELECT row_number() OVER (ORDER BY user_id) AS customer_key, user_id, age_band, signup_date,
         {{hash_cust}} AS row_hash, signup_date AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM s_users""",
    "dim_account": """
  SELECT row_number() OVER (ORDER BY account_id) AS account_key, account_id, user_id, account_number_masked,
         opened_date, account_type, account_type_category, {hash_acct} AS row_hash,
         opened_date AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM acct_input""",
    "txd": """
  SELECT t.*, tty.direction, CAST(t.transaction_ts AS DATE) AS d
  FROM s_transactions t JOIN transaction_types tty ON t.transaction_type_id = tty.transaction_type_id""",
    "resolved": """
  SELECT x.*, da.account_key, da.user_id AS owner, dc.customer_key
  FROM txd x
  LEFT JOIN dim_account da ON x.account_id = da.account_id AND x.d >= da.valid_from AND x.d < da.valid_to
  LEFT JOIN dim_customer dc ON da.user_id = dc.user_id AND x.d >= dc.valid_from AND x.d < dc.valid_to""",
    "mm": "SELECT CAST(date_trunc('month', max(CAST(transaction_ts AS DATE))) AS DATE) AS m FROM s_transactions",
    "spine": """
  SELECT a.account_id, a.user_id, CAST(g.m AS DATE) AS month, last_day(CAST(g.m AS DATE)) AS month_end
  FROM s_accounts a, mm,
       unnest(CASE WHEN CAST(date_trunc('month', a.opened_date) AS DATE) <= mm.m
                   THEN generate_series(CAST(date_trunc('month', a.opened_date) AS TIMESTAMP),
                                        CAST(mm.m AS TIMESTAMP), INTERVAL 1 MONTH)
                   ELSE [CAST(date_trunc('month', a.opened_date) AS TIMESTAMP)] END) AS g(m)""",
    "activity": """
  SELECT account_id, CAST(date_trunc('month', d) AS DATE) AS month,
         CAST(coalesce(sum(CASE WHEN direction = 'inflow' THEN amount END), 0) AS DECIMAL(20,2)) AS month_inflow,
         CAST(coalesce(sum(CASE WHEN direction = 'outflow' THEN amount END), 0) AS DECIMAL(20,2)) AS month_outflow,
         count(*) AS transaction_count
  FROM txd GROUP BY 1, 2""",
    "closing": """
  SELECT s.account_id, s.user_id, s.month, s.month_end,
         CAST(coalesce(sum(CASE WHEN x.direction = 'inflow' THEN x.amount ELSE -x.amount END), 0)
              AS DECIMAL(20,2)) AS closing_balance
  FROM spine s LEFT JOIN txd x ON s.account_id = x.account_id AND x.d <= s.month_end
  GROUP BY 1, 2, 3, 4""",
    "snap": """
  SELECT c.account_id, c.user_id, c.month_end,
         CAST(strftime(c.month_end, '%Y%m%d') AS INTEGER) AS date_key,
         coalesce(a.month_inflow, CAST(0 AS DECIMAL(20,2))) AS month_inflow,
         coalesce(a.month_outflow, CAST(0 AS DECIMAL(20,2))) AS month_outflow,
         CAST(coalesce(a.month_inflow, 0) - coalesce(a.month_outflow, 0) AS DECIMAL(20,2)) AS month_net,
         c.closing_balance,
         CAST(coalesce(a.transaction_count, 0) AS BIGINT) AS transaction_count
  FROM closing c LEFT JOIN activity a ON c.account_id = a.account_id AND c.month = a.month""",
}


def _hash_sql(cols: list[str], trim: bool = False, sort: bool = True) -> str:
    names = sorted(cols) if sort else cols
    parts = []
    for c in names:
        v = f"CAST({c} AS VARCHAR)"
        if trim:
            v = f"trim({v})"
        parts.append(f"coalesce({v}, '∅')")
    return f"sha256(concat_ws('||', {', '.join(parts)}))"


HASH_CUST = _hash_sql(["age_band", "signup_date"])
HASH_ACCT = _hash_sql(["account_number_masked", "opened_date", "account_type", "account_type_category"])
STAR = {k: v.replace("{hash_cust}", HASH_CUST).replace("{hash_acct}", HASH_ACCT) for k, v in STAR.items()}

SCD2_LOAD = """
  SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id, {band} AS age_band,
         DATE '1990-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS signup_date
  FROM (SELECT *, DATE '1945-01-01' + CAST((c_custkey * 7919) % 20000 AS INTEGER) AS dob,
               {as_of} AS as_of FROM customer) c {where}"""

SCD2 = {
    "l1": SCD2_LOAD.format(band=band_sql("dob", "as_of"), as_of="DATE '2026-01-01'", where="WHERE c_custkey % 7 <> 0"),
    "l2": SCD2_LOAD.format(
        band=band_sql("dob", "as_of"),
        as_of="CASE WHEN c_custkey % 10 = 0 THEN DATE '2036-01-01' ELSE DATE '2026-01-01' END",
        where="",
    ),
    "scd1": f"""
  SELECT row_number() OVER (ORDER BY user_id) AS customer_key, user_id, age_band, signup_date,
         {HASH_CUST} AS row_hash, signup_date AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
  FROM l1""",
}


def _scd2_next(prev: str, load: str, run: str = "DATE '2026-02-01'") -> dict[str, str]:
    p = f"{prev}_{load}"
    return {
        f"{p}_cur": f"""
  SELECT user_id, max(CASE WHEN is_current THEN row_hash END) AS open_hash
  FROM {prev} GROUP BY user_id""",
        f"{p}_tag": f"""
  SELECT h.*, c.user_id IS NOT NULL AS ex, c.open_hash
  FROM (SELECT *, {HASH_CUST} AS row_hash FROM {load}) h LEFT JOIN {p}_cur c ON h.user_id = c.user_id""",
        f"{p}_ins": f"""
  SELECT (SELECT coalesce(max(customer_key), 0) FROM {prev})
           + row_number() OVER (ORDER BY user_id, vf) AS customer_key,
         user_id, age_band, signup_date, row_hash, vf AS valid_from,
         DATE '9999-12-31' AS valid_to, true AS is_current
  FROM (SELECT *, CASE WHEN NOT ex THEN signup_date ELSE {run} END AS vf
        FROM {p}_tag WHERE NOT ex OR open_hash IS NULL OR row_hash <> open_hash)""",
        f"{p}_exp": f"SELECT user_id FROM {p}_tag WHERE ex AND open_hash IS NOT NULL AND row_hash <> open_hash",
        f"{p}": f"""
  SELECT customer_key, user_id, age_band, signup_date, row_hash, valid_from,
         CASE WHEN is_current AND user_id IN (SELECT user_id FROM {p}_exp) THEN {run} ELSE valid_to END AS valid_to,
         CASE WHEN is_current AND user_id IN (SELECT user_id FROM {p}_exp) THEN false ELSE is_current END
           AS is_current
  FROM {prev}
  UNION ALL SELECT * FROM {p}_ins""",
    }


SCD2.update(_scd2_next("scd1", "l2"))
SCD2.update(_scd2_next("scd1_l2", "l2"))
SCD2.update(_scd2_next("scd1_l2", "l1", "DATE '2026-03-01'"))
STAR.update(SCD2)

oracle("union_date_bounds", 'SELECT * FROM bounds', STAR)
oracle(
    "dim_date",
    """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, isodow(d) >= 6 AS is_weekend, d = last_day(d) AS is_month_end
FROM days""",
    STAR,
)
oracle("dim_account_input", "SELECT * FROM acct_input", STAR)
oracle("row_hash", f"SELECT user_id, {HASH_CUST} AS row_hash FROM s_users", STAR)
oracle(
    "surrogate_keys",
    "SELECT row_number() OVER (ORDER BY transaction_id) AS transaction_key, transaction_id, account_id "
    "FROM s_transactions",
    STAR,
)
oracle("scd2_first_load", "SELECT * FROM scd1", STAR)
oracle("scd2_second_load", "SELECT * FROM scd1_l2", STAR)
oracle("scd2_noop", "SELECT * FROM scd1_l2_l2", STAR)
oracle("scd2_current", "SELECT * FROM scd1_l2 WHERE is_current", STAR)
oracle("dim_customer", "SELECT * FROM dim_customer", STAR)
oracle("dim_account", "SELECT * FROM dim_account", STAR)
oracle(
    "fct_transaction",
    """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, customer_key, account_key,
       transaction_type_id AS transaction_type_key, transaction_id,
       CAST(amount AS DECIMAL(12,2)) AS amount,
       CAST(CASE WHEN direction = 'inflow' THEN amount ELSE -amount END AS DECIMAL(12,2)) AS signed_amount,
       currency
FROM resolved WHERE account_key IS NOT NULL AND customer_key IS NOT NULL""",
    STAR,
)
oracle(
    "fct_unresolved",
    """
SELECT transaction_id, account_id, d AS transaction_date,
       CASE WHEN account_key IS NULL THEN 'no_account_version' ELSE 'no_customer_version' END AS reason
FROM resolved WHERE account_key IS NULL OR customer_key IS NULL""",
    STAR,
)
PIT_SQL = """
SELECT x.account_id, x.transaction_id, x.txn_date, x.user_id, v.customer_key, v.age_band
FROM (SELECT t.account_id, t.transaction_id, CAST(t.transaction_ts AS DATE) AS txn_date, a.user_id
      FROM s_transactions t JOIN s_accounts a ON t.account_id = a.account_id) x
JOIN scd1_l2 v ON x.user_id = v.user_id AND x.txn_date >= v.valid_from AND x.txn_date < v.valid_to"""
oracle("pit_join", PIT_SQL, STAR)
oracle("pit_join_asof", PIT_SQL, STAR)
oracle(
    "month_spine",
    "SELECT account_id, month, month_end, CAST(strftime(month_end, '%Y%m%d') AS INTEGER) AS date_key FROM spine",
    STAR,
)
oracle("month_activity", "SELECT * FROM activity", STAR)
oracle(
    "running_balance",
    "SELECT account_id, date_key, closing_balance, month_net, transaction_count FROM snap",
    STAR,
)
oracle(
    "monthly_snapshot",
    """
SELECT s.date_key, dc.customer_key, da.account_key, s.month_inflow, s.month_outflow, s.month_net,
       s.closing_balance, s.transaction_count
FROM snap s
JOIN dim_account da ON s.account_id = da.account_id AND s.month_end >= da.valid_from AND s.month_end < da.valid_to
JOIN dim_customer dc ON s.user_id = dc.user_id AND s.month_end >= dc.valid_from AND s.month_end < dc.valid_to""",
    STAR,
)

# --- data vault ---------------------------------------------------------------
L1, L2, L3 = (f"TIMESTAMP '2026-0{m}-01 00:00:00'" for m in (1, 2, 3))
HK_ACCOUNT = _hash_sql(["account_id"], trim=True, sort=False)
HK_USER = _hash_sql(["user_id"], trim=True, sort=False)
HK_TXN = _hash_sql(["transaction_id"], trim=True, sort=False)
HK_ACCOUNT_USER = _hash_sql(["account_id", "user_id"], trim=True, sort=False)
HD_ACCOUNT = _hash_sql(["account_type", "account_number", "opened_date"])
HD_TXN = _hash_sql(["transaction_type", "amount", "currency", "transaction_ts"])


def _sat_account(src: str, load: str) -> str:
    return (
        f"SELECT {HK_ACCOUNT} AS account_hk, {load} AS load_date, {HD_ACCOUNT} AS hash_diff, "
        f"'bronze.accounts' AS record_source, account_type, account_number, opened_date FROM {src}"
    )


def _latest(src: str, key: str) -> str:
    return (
        f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {key} "
        "ORDER BY load_date DESC, hash_diff DESC) = 1"
    )


VAULT = {
    "acc_early": "SELECT * FROM d_accounts WHERE opened_date < DATE '2000-01-01'",
    "hub1": f"SELECT {HK_ACCOUNT} AS account_hk, account_id, {L1} AS load_date, 'bronze.accounts' AS record_source "
    "FROM acc_early",
    "hub2_delta": f"""
  SELECT {HK_ACCOUNT} AS account_hk, account_id, {L2} AS load_date, 'bronze.accounts' AS record_source
  FROM d_accounts WHERE {HK_ACCOUNT} NOT IN (SELECT account_hk FROM hub1)""",
    "link1": f"""
  SELECT {HK_ACCOUNT_USER} AS account_user_hk, {HK_ACCOUNT} AS account_hk, {HK_USER} AS user_hk,
         {L1} AS load_date, 'bronze.accounts' AS record_source FROM acc_early""",
    "link2_delta": f"""
  SELECT {HK_ACCOUNT_USER} AS account_user_hk, {HK_ACCOUNT} AS account_hk, {HK_USER} AS user_hk,
         {L2} AS load_date, 'bronze.accounts' AS record_source
  FROM d_accounts WHERE {HK_ACCOUNT_USER} NOT IN (SELECT account_user_hk FROM link1)""",
    "b_accounts_v2": f"SELECT {_ACCOUNT_COLS.format(priority=CHANGED_PRIORITY)} FROM orders",
    "sat1": _sat_account("d_accounts", L1),
    "sat2_in": _sat_account("b_accounts_v2", L2),
    "sat1_latest": _latest("sat1", "account_hk"),
    "sat2_delta": """
  SELECT i.* FROM sat2_in i LEFT JOIN sat1_latest l ON i.account_hk = l.account_hk
  WHERE l.hash_diff IS NULL OR i.hash_diff <> l.hash_diff""",
    "sat12_latest": _latest("(SELECT * FROM sat1 UNION ALL SELECT * FROM sat2_delta)", "account_hk"),
    "sat3_in": _sat_account("d_accounts", L3),
    "sat3_delta": """
  SELECT i.* FROM sat3_in i LEFT JOIN sat12_latest l ON i.account_hk = l.account_hk
  WHERE l.hash_diff IS NULL OR i.hash_diff <> l.hash_diff""",
    "hub_user_all": f"SELECT {HK_USER} AS user_hk, user_id FROM d_users",
    "hub_account_all": f"SELECT {HK_ACCOUNT} AS account_hk, account_id FROM d_accounts",
    "link_account_user_all": f"SELECT {HK_ACCOUNT} AS account_hk, {HK_USER} AS user_hk FROM d_accounts",
    "sat_txn1": f"""
  SELECT {HK_TXN} AS transaction_hk, {L1} AS load_date, {HD_TXN} AS hash_diff,
         'bronze.transactions' AS record_source, transaction_type, amount, currency, transaction_ts
  FROM d_transactions""",
}

oracle("hub_load", "SELECT * FROM hub1 UNION ALL SELECT * FROM hub2_delta", VAULT)
oracle("hub_delta", "SELECT * FROM hub2_delta", VAULT)
oracle("link_load", "SELECT * FROM link1 UNION ALL SELECT * FROM link2_delta", VAULT)
oracle("link_delta", "SELECT * FROM link2_delta", VAULT)
oracle("sat_load", "SELECT * FROM sat1", VAULT)
oracle("sat_delta", "SELECT * FROM sat2_delta", VAULT)
oracle("sat_delta_revert", "SELECT * FROM sat3_delta", VAULT)
oracle(
    "sat_current",
    _latest("(SELECT * FROM sat1 UNION ALL SELECT * FROM sat2_delta UNION ALL SELECT * FROM sat3_delta)", "account_hk"),
    VAULT,
)
oracle("sat_transaction_load", "SELECT * FROM sat_txn1", VAULT)
RECON_SQL = f"""
SELECT h.account_id, hu.user_id, aty.account_type_id, {_mask('s.account_number')} AS account_number_masked,
       s.opened_date
FROM sat1 s
JOIN hub_account_all h ON s.account_hk = h.account_hk
JOIN account_types aty ON s.account_type = aty.type_name
JOIN link_account_user_all l ON s.account_hk = l.account_hk
JOIN hub_user_all hu ON l.user_hk = hu.user_hk
WHERE hu.user_id IN (SELECT user_id FROM s_users)"""
oracle("vault_reconstruct", RECON_SQL, VAULT)
RECON_TXN_SQL = f"""
SELECT h.transaction_id, ha.account_id, tty.transaction_type_id, s.amount, s.currency, s.transaction_ts
FROM sat_txn1 s
JOIN (SELECT {HK_TXN} AS transaction_hk, transaction_id FROM d_transactions) h ON s.transaction_hk = h.transaction_hk
JOIN transaction_types tty ON s.transaction_type = tty.type_name
JOIN (SELECT {HK_TXN} AS transaction_hk, {HK_ACCOUNT} AS account_hk FROM d_transactions) l
  ON s.transaction_hk = l.transaction_hk
JOIN hub_account_all ha ON l.account_hk = ha.account_hk
WHERE ha.account_id IN (SELECT account_id FROM s_accounts)"""
oracle("vault_reconstruct_transactions", RECON_TXN_SQL, VAULT)

# --- checks -------------------------------------------------------------------
def _chk(name: str, failing_sql: str) -> str:
    f = "coalesce(CAST(t.f AS BIGINT), CAST(0 AS BIGINT))"
    return f"SELECT '{name}' AS \"check\", {f} = 0 AS ok, {f} AS failing FROM ({failing_sql}) AS t(f)"


def _checks(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def unique_sql(src: str, keys: str) -> str:
    return f"SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM {src} GROUP BY {keys})"


def fk_sql(child: str, parent: str, c: str, p: str | None = None) -> str:
    return f"SELECT count(*) FROM {child} x WHERE NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{p or c} = x.{c})"


def fanout_sql(fact: str, dim: str, k: str) -> str:
    return (
        f"SELECT count(*) FROM {fact} x LEFT JOIN (SELECT {k} AS dk, count(*) AS m FROM {dim} GROUP BY 1) d "
        f"ON x.{k} = d.dk WHERE d.m IS NULL OR d.m <> 1"
    )


def counts_sql(a: str, b: str) -> str:
    return f"SELECT abs((SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b}))"


def nonempty_sql(src: str) -> str:
    return f"SELECT 1 - count(*) FROM (SELECT 1 FROM {src} LIMIT 1)"


def measure_sql(left: str, key: str, lm: str, right: str, rm: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {key} AS k, {lm} AS l FROM {left}) a "
        f"LEFT JOIN (SELECT {key} AS k, sum({rm}) AS r FROM {right} GROUP BY 1) b ON a.k = b.k "
        "WHERE a.l IS DISTINCT FROM coalesce(b.r, 0)"
    )


def current_sql(dim: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {dim} WHERE is_current GROUP BY 1 HAVING count(*) > 1)"


def contiguous_sql(dim: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT valid_to, lead(valid_from) OVER (PARTITION BY {key} "
        f"ORDER BY valid_from, valid_to) AS nx FROM {dim}) WHERE nx IS NOT NULL AND valid_to <> nx"
    )


def coverage_sql(fact: str, cal: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT DISTINCT date_key FROM {fact}) f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {cal} c WHERE c.date_key = f.date_key)"
    )


def hub_complete_sql(hub: str, src: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT DISTINCT {key} FROM {src}) s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {hub} h WHERE h.{key} = s.{key})"
    )


def repeat_sql(sat: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT hash_diff, lag(hash_diff) OVER (PARTITION BY {key} "
        f"ORDER BY load_date, hash_diff) AS p FROM {sat}) WHERE p = hash_diff"
    )


def equal_sql(a: str, b: str, key: str, cols: list[str]) -> str:
    diff = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in cols)
    return (
        f"SELECT count(*) FROM (SELECT *, 1 AS _in FROM {a}) a "
        f"FULL OUTER JOIN (SELECT *, 1 AS _in FROM {b}) b ON a.{key} IS NOT DISTINCT FROM b.{key} "
        f"WHERE a._in IS NULL OR b._in IS NULL OR {diff}"
    )


CHECK = dict(STAR)
CHECK.update(VAULT)
CHECK.update(
    {
        "fct": """
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, customer_key, account_key,
         transaction_type_id AS transaction_type_key, transaction_id,
         CAST(amount AS DECIMAL(12,2)) AS amount,
         CAST(CASE WHEN direction = 'inflow' THEN amount ELSE -amount END AS DECIMAL(12,2)) AS signed_amount,
         currency
  FROM resolved WHERE account_key IS NOT NULL AND customer_key IS NOT NULL""",
        "unresolved": "SELECT transaction_id FROM resolved WHERE account_key IS NULL OR customer_key IS NULL",
        "fct_all": "SELECT transaction_id FROM fct UNION ALL SELECT transaction_id FROM unresolved",
        "pit_facts": "SELECT t.*, a.user_id FROM s_transactions t JOIN s_accounts a ON t.account_id = a.account_id",
        "crash": "SELECT * FROM scd1 UNION ALL SELECT * FROM scd1_l2_ins",
        "sat_rerun_in": _sat_account("d_accounts", L2),
        "sat_rerun": """
  SELECT i.* FROM sat_rerun_in i LEFT JOIN sat1_latest l ON i.account_hk = l.account_hk
  WHERE l.hash_diff IS NULL OR i.hash_diff <> l.hash_diff""",
        "sat_hist": "SELECT * FROM sat1 UNION ALL SELECT * FROM sat2_delta UNION ALL SELECT * FROM sat3_delta",
        "sat_blind": "SELECT * FROM sat1 UNION ALL SELECT * FROM sat_rerun_in",
        "c360": C360_SQL,
        "fct_by_account": "SELECT f.*, da.account_id FROM fct f JOIN dim_account da ON f.account_key = da.account_key",
        "snap_fact": """
  SELECT s.date_key, dc.customer_key, da.account_key, s.closing_balance
  FROM snap s
  JOIN dim_account da ON s.account_id = da.account_id AND s.month_end >= da.valid_from AND s.month_end < da.valid_to
  JOIN dim_customer dc ON s.user_id = dc.user_id AND s.month_end >= dc.valid_from AND s.month_end < dc.valid_to""",
        "snap_latest": """
  SELECT da.account_id, sf.closing_balance FROM snap_fact sf JOIN dim_account da ON sf.account_key = da.account_key
  QUALIFY row_number() OVER (PARTITION BY da.account_id ORDER BY sf.date_key DESC, sf.closing_balance DESC) = 1""",
        "dim_date_keys": "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key FROM days",
        "short_days": """
  SELECT CAST(strftime(CAST(g.d AS DATE), '%Y%m%d') AS INTEGER) AS date_key
  FROM (SELECT CAST(date_trunc('month', min(opened_date)) AS DATE) AS s, last_day(max(opened_date)) AS e
        FROM s_accounts) b,
       unnest(generate_series(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY)) AS g(d)""",
        "recon": RECON_SQL,
        "sat12_cur": _latest("(SELECT * FROM sat1 UNION ALL SELECT * FROM sat2_delta)", "account_hk"),
        "recon2": RECON_SQL.replace("FROM sat1 s", "FROM sat12_cur s"),
    }
)
ACCT_COLS = ["user_id", "account_type_id", "account_number_masked", "opened_date"]

oracle(
    "check_unique",
    _checks(
        _chk("dim_customer.customer_key unique", unique_sql("dim_customer", "customer_key")),
        _chk("bronze.transactions.transaction_id unique", unique_sql("b_transactions", "transaction_id")),
    ),
    CHECK,
)
oracle(
    "check_fk",
    _checks(
        _chk("silver.transactions -> accounts", fk_sql("s_transactions", "s_accounts", "account_id")),
        _chk("bronze.accounts -> silver.users", fk_sql("b_accounts", "s_users", "user_id")),
    ),
    CHECK,
)
oracle(
    "check_fk_fanout",
    _checks(
        _chk("fct_transaction.account_key", fanout_sql("fct", "dim_account", "account_key")),
        _chk("transactions.user_id -> versioned customers", fanout_sql("pit_facts", "scd1_l2", "user_id")),
    ),
    CHECK,
)
oracle(
    "check_counts",
    _checks(
        _chk("fct + unresolved == silver.transactions", counts_sql("fct_all", "s_transactions")),
        _chk("fct_transaction == silver.transactions", counts_sql("fct", "s_transactions")),
    ),
    CHECK,
)
oracle(
    "check_nonempty",
    _checks(
        _chk("silver.accounts has rows", nonempty_sql("s_accounts")),
        _chk("sat re-run appends rows", nonempty_sql("sat_rerun")),
    ),
    CHECK,
)
oracle(
    "check_measure",
    _checks(
        _chk("360 vs account_summary", measure_sql("c360", "user_id", "total_balance", "account_summary", "balance")),
        _chk(
            "fct signed_amount vs account_summary",
            measure_sql("account_summary", "account_id", "balance", "fct_by_account", "signed_amount"),
        ),
        _chk(
            "latest snapshot vs account_summary",
            measure_sql("account_summary", "account_id", "balance", "snap_latest", "closing_balance"),
        ),
    ),
    CHECK,
)
oracle(
    "check_scd2_current",
    _checks(
        _chk("second load", current_sql("scd1_l2", "user_id")),
        _chk("inserted without expiring", current_sql("crash", "user_id")),
    ),
    CHECK,
)
oracle(
    "check_scd2_contiguous",
    _checks(
        _chk("second load", contiguous_sql("scd1_l2", "user_id")),
        _chk("inserted without expiring", contiguous_sql("crash", "user_id")),
    ),
    CHECK,
)
oracle(
    "check_date_coverage",
    _checks(
        _chk("dim_date covers fct_transaction", coverage_sql("fct", "dim_date_keys")),
        _chk("opening-date calendar covers fct_transaction", coverage_sql("fct", "short_days")),
    ),
    CHECK,
)
oracle(
    "check_hub_complete",
    _checks(
        _chk("hub_account after a full load", hub_complete_sql("hub_account_all", "b_accounts", "account_id")),
        _chk("hub_account after load 1 only", hub_complete_sql("hub1", "b_accounts", "account_id")),
    ),
    CHECK,
)
oracle(
    "check_hash_repeat",
    _checks(
        _chk("three-load history", repeat_sql("sat_hist", "account_hk")),
        _chk("unfiltered re-load", repeat_sql("sat_blind", "account_hk")),
    ),
    CHECK,
)
oracle(
    "check_equal",
    _checks(
        _chk("vault == silver accounts", equal_sql("recon", "s_accounts", "account_id", ACCT_COLS)),
        _chk("vault after load 2 == silver", equal_sql("recon2", "s_accounts", "account_id", ACCT_COLS)),
    ),
    CHECK,
)

# --- sources, sinks, streaming, previews ----------------------------------------
oracle("csv_round_trip", "SELECT * FROM b_users")
oracle("incremental_append", "SELECT * FROM d_transactions")
oracle(
    "quarantine_round_trip",
    "SELECT transaction_id, account_id, transaction_type, amount, currency, transaction_ts, _ingested_at, "
    "_src_partkey, _src_suppkey, reason FROM t_transactions WHERE reason IS NOT NULL",
)
oracle("stream_incremental_append", "SELECT * FROM d_transactions")
oracle("preview_top_n", "SELECT * FROM account_summary ORDER BY balance DESC, account_id ASC LIMIT 20")


# --- the end-to-end invariant suite -------------------------------------------------
HK_GOAL = _hash_sql(["goal_id"], trim=True, sort=False)
HK_TXN_ACCOUNT = _hash_sql(["transaction_id", "account_id"], trim=True, sort=False)
HK_GOAL_USER = _hash_sql(["goal_id", "user_id"], trim=True, sort=False)
HD_USER = _hash_sql(["date_of_birth", "signup_date"])
HD_GOAL = _hash_sql(["goal_name", "target_amount", "current_amount", "created_date", "target_date"])

E2E = dict(CHECK)
E2E.update(
    {
        "dim_transaction_type": "SELECT transaction_type_id AS transaction_type_key, type_name, direction, description "
        "FROM transaction_types",
        "hub_user": f"SELECT {HK_USER} AS user_hk, user_id FROM d_users",
        "hub_account": f"SELECT {HK_ACCOUNT} AS account_hk, account_id FROM d_accounts",
        "hub_transaction": f"SELECT {HK_TXN} AS transaction_hk, transaction_id FROM d_transactions",
        "hub_savings_goal": f"SELECT {HK_GOAL} AS savings_goal_hk, goal_id FROM d_goals",
        "link_account_user": f"SELECT {HK_ACCOUNT_USER} AS account_user_hk, {HK_ACCOUNT} AS account_hk, "
        f"{HK_USER} AS user_hk FROM d_accounts",
        "link_transaction_account": f"SELECT {HK_TXN_ACCOUNT} AS transaction_account_hk, {HK_TXN} AS transaction_hk, "
        f"{HK_ACCOUNT} AS account_hk FROM d_transactions",
        "link_savings_goal_user": f"SELECT {HK_GOAL_USER} AS savings_goal_user_hk, {HK_GOAL} AS savings_goal_hk, "
        f"{HK_USER} AS user_hk FROM d_goals",
        "sat_user_details": f"SELECT {HK_USER} AS user_hk, {L1} AS load_date, {HD_USER} AS hash_diff, "
        "date_of_birth, signup_date FROM d_users",
        "sat_savings_goal_details": f"SELECT {HK_GOAL} AS savings_goal_hk, {L1} AS load_date, {HD_GOAL} AS hash_diff, "
        "goal_name, target_amount, current_amount, created_date, target_date FROM d_goals",
        "recon_users": f"""
  SELECT h.user_id, {band_sql('s.date_of_birth')} AS age_band, s.signup_date
  FROM sat_user_details s JOIN hub_user h ON s.user_hk = h.user_hk""",
        "recon_txn": RECON_TXN_SQL,
        "recon_goals": """
  SELECT h.goal_id, hu.user_id, trim(s.goal_name) AS goal_name, s.target_amount, s.current_amount,
         s.created_date, s.target_date
  FROM sat_savings_goal_details s
  JOIN hub_savings_goal h ON s.savings_goal_hk = h.savings_goal_hk
  JOIN link_savings_goal_user l ON s.savings_goal_hk = l.savings_goal_hk
  JOIN hub_user hu ON l.user_hk = hu.user_hk
  WHERE hu.user_id IN (SELECT user_id FROM s_users)""",
    }
)


def inverted_sql(dim: str) -> str:
    return f"SELECT count(*) FROM {dim} WHERE valid_to < valid_from"


#: The catalogue's tables under the names of the CTEs that hold them.
CTE_OF = {
    "users": "s_users", "accounts": "s_accounts", "transactions": "s_transactions", "savings_goals": "s_goals", "customer_360": "c360",
    "dim_date": "dim_date_keys", "fct_transaction": "fct", "fct_account_monthly_snapshot": "snap_fact", "transactions_by_outcome": "fct_all",
    "facts_by_account": "fct_by_account", "last_balances": "snap_latest", "sat_account_details": "sat1", "sat_transaction_details": "sat_txn1",
    "bronze_users": "b_users", "bronze_accounts": "b_accounts", "bronze_transactions": "b_transactions", "bronze_savings_goals": "b_goals",
    "rebuilt_users": "recon_users", "rebuilt_accounts": "recon", "rebuilt_transactions": "recon_txn", "rebuilt_savings_goals": "recon_goals",
}


def _fact_sql(f) -> str:
    table, other = CTE_OF.get(f.table, f.table), CTE_OF.get(f.other, f.other)
    return {
        "filled": lambda: nonempty_sql(table),
        "points": lambda: fk_sql(table, other, f.column),
        "key": lambda: unique_sql(table, f.column),
        "covers": lambda: hub_complete_sql(table, other, f.column),
        "one_match": lambda: fanout_sql(table, other, f.column),
        "one_open": lambda: current_sql(table, f.column),
        "contiguous": lambda: contiguous_sql(table, f.column),
        "upright": lambda: inverted_sql(table),
        "no_repeat": lambda: repeat_sql(table, f.column),
        "same_rows": lambda: counts_sql(table, other),
        "same_sum": lambda: measure_sql(table, f.columns[0], f.column, other, f.other_column),
        "equal": lambda: equal_sql(table, other, f.column, list(f.columns)),
    }[f.kind]()


def _e2e_sql() -> str:
    from .verify import CATALOGUE

    return _checks(*[_chk(f.label, _fact_sql(f)) for f in CATALOGUE])


oracle("checks_e2e", _e2e_sql(), E2E)
oracle(
    "check_conservation",
    _chk(
        "every transaction is a fact",
        "SELECT abs((SELECT count(*) FROM txd x JOIN dim_account da ON x.account_id = da.account_id "
        "JOIN dim_customer dc ON da.user_id = dc.user_id) - (SELECT count(*) FROM s_transactions))",
    ),
    CHECK,
)
oracle(
    "check_scd2_inverted",
    _checks(
        _chk("second load", inverted_sql("scd1_l2")),
        _chk("effective after the run date", "SELECT count(*) FROM scd1 JOIN l2 USING (user_id) WHERE l2.age_band <> scd1.age_band AND DATE '1990-06-01' < scd1.valid_from"),
    ),
    CHECK,
)

# --- a vault that grows by micro-batches: early accounts, then all of them with changed priorities
STREAM = dict(VAULT)
STREAM.update(
    {
        "sat_early": _sat_account("acc_early", L1),
        "sat_stream_delta": """
  SELECT i.* FROM sat2_in i LEFT JOIN sat_early e ON i.account_hk = e.account_hk
  WHERE e.hash_diff IS NULL OR i.hash_diff <> e.hash_diff""",
    }
)
oracle("stream_hub", "SELECT * FROM hub1 UNION ALL SELECT * FROM hub2_delta", STREAM)
oracle("stream_link", "SELECT * FROM link1 UNION ALL SELECT * FROM link2_delta", STREAM)
oracle("stream_sat", "SELECT * FROM sat_early UNION ALL SELECT * FROM sat_stream_delta", STREAM)

# --- catalog tables
oracle("catalog_ingest", "SELECT user_id, full_name, email, date_of_birth, address, signup_date, _ingested_at FROM b_users")
oracle("scd2_table_load", "SELECT * FROM scd1_l2", STAR)
oracle("vault_rerun", "SELECT * FROM sat1", VAULT)
oracle(
    "csv_inferred",
    "SELECT user_id, signup_date, CAST(user_id[2:] AS INTEGER) AS n, CAST(user_id[2:] AS INTEGER) % 2 = 0 AS even FROM b_users",
)
oracle("vault_reconstruct_users", "SELECT * FROM recon_users", E2E)
oracle("vault_reconstruct_goals", "SELECT * FROM recon_goals", E2E)
for _name, _columns in {
    "hub_user": "user_hk, user_id",
    "hub_transaction": "transaction_hk, transaction_id",
    "hub_savings_goal": "savings_goal_hk, goal_id",
    "link_transaction_account": "transaction_account_hk, transaction_hk, account_hk",
    "link_savings_goal_user": "savings_goal_user_hk, savings_goal_hk, user_hk",
    "sat_user_details": "user_hk, hash_diff, date_of_birth, signup_date",
    "sat_savings_goal_details": "savings_goal_hk, hash_diff, goal_name, target_amount, current_amount, created_date, target_date",
}.items():
    _source = {"user": "users", "transaction": "transactions", "savings": "savings_goals"}[_name.split("_")[1]]
    oracle(f"load_{_name}", f"SELECT {_columns}, {L1} AS load_date, 'bronze.{_source}' AS record_source FROM {_name}", E2E)

# --- open parts, prefixes, padded keys and late rows
oracle("scd2_open_partition_load", "SELECT * FROM scd1_l2_l1", STAR)
oracle("load_hub_pruned", "SELECT * FROM hub1 UNION ALL SELECT * FROM hub2_delta", VAULT)
oracle("load_sat_pruned", "SELECT * FROM sat_hist", CHECK)
oracle(
    "vault_padded_keys",
    f"""
SELECT {HK_ACCOUNT} AS account_hk, account_id, {HD_ACCOUNT} AS hash_diff, account_type
FROM (SELECT * FROM b_accounts UNION ALL
      SELECT account_id || ' ', user_id, account_type, account_number, opened_date, {L2}
      FROM b_accounts_v2 WHERE CAST(account_id[2:] AS BIGINT) % 20 = 0)
QUALIFY row_number() OVER (PARTITION BY trim(account_id) ORDER BY _ingested_at DESC) = 1""",
    VAULT,
)
LATE = dict(VAULT)
LATE.update(
    {
        "march_in": _sat_account("b_accounts_v2", L3),
        "march": "SELECT i.* FROM march_in i JOIN sat1 j ON i.account_hk = j.account_hk WHERE i.hash_diff <> j.hash_diff",
        "february_src": "SELECT * REPLACE (CASE WHEN CAST(account_id[2:] AS BIGINT) % 4 = 0 THEN '3-MEDIUM' ELSE account_type END AS account_type) FROM b_accounts_v2",
        "february_in": _sat_account("february_src", L2),
        "february": """
  SELECT i.* FROM february_in i JOIN sat1 j ON i.account_hk = j.account_hk LEFT JOIN march m ON i.account_hk = m.account_hk
  WHERE i.hash_diff <> j.hash_diff AND i.hash_diff IS DISTINCT FROM m.hash_diff""",
    }
)
oracle("vault_late_batch", "SELECT * FROM sat1 UNION ALL SELECT * FROM march UNION ALL SELECT * FROM february", LATE)

# --- dimensions whose versions change between the transactions
VERSIONS = dict(STAR)
VERSIONS.update(
    {
        "u2": """
  SELECT user_id, CASE WHEN CAST(user_id[2:] AS BIGINT) % 10 = 0 THEN 'changed' ELSE age_band END AS age_band, signup_date FROM s_users""",
        **_scd2_next("dim_customer", "u2", "DATE '1997-01-10'"),
        "a2": f"""
  SELECT *, {HASH_ACCT} AS row_hash
  FROM (SELECT * REPLACE ('changed' AS account_type) FROM acct_input WHERE CAST(account_id[2:] AS BIGINT) % 10 = 0)""",
        "dim_account_a2": """
  SELECT * REPLACE (CASE WHEN account_id IN (SELECT account_id FROM a2) THEN DATE '1996-06-15' ELSE valid_to END AS valid_to,
                    account_id NOT IN (SELECT account_id FROM a2) AS is_current)
  FROM dim_account
  UNION ALL
  SELECT (SELECT max(account_key) FROM dim_account) + row_number() OVER (ORDER BY account_id), account_id, user_id,
         account_number_masked, opened_date, account_type, account_type_category, row_hash,
         DATE '1996-06-15', DATE '9999-12-31', true
  FROM a2""",
        "da": "SELECT * FROM dim_account_a2 WHERE valid_from < valid_to",
        "dc": "SELECT * FROM dim_customer_u2 WHERE valid_from < valid_to",
        "dates": """
  SELECT account_id, user_id, valid_from AS d FROM da UNION SELECT account_id, user_id, valid_to FROM da
  UNION SELECT da.account_id, da.user_id, dc.valid_from FROM da JOIN dc ON da.user_id = dc.user_id
  UNION SELECT da.account_id, da.user_id, dc.valid_to FROM da JOIN dc ON da.user_id = dc.user_id""",
        "parts": "SELECT account_id, user_id, d AS f, lead(d) OVER (PARTITION BY account_id, user_id ORDER BY d) AS t FROM dates",
        "bridge": """
  SELECT p.account_id, p.user_id, da.account_key, dc.customer_key, p.f AS valid_from, p.t AS valid_to
  FROM parts p
  JOIN da ON p.account_id = da.account_id AND p.user_id = da.user_id AND da.valid_from <= p.f AND p.f < da.valid_to
  LEFT JOIN dc ON p.user_id = dc.user_id AND dc.valid_from <= p.f AND p.f < dc.valid_to
  WHERE p.t IS NOT NULL""",
    }
)
oracle("dim_bridge", "SELECT * FROM bridge", VERSIONS)
oracle(
    "fct_transaction_versions",
    """
SELECT CAST(strftime(x.d, '%Y%m%d') AS INTEGER) AS date_key, dc.customer_key, da.account_key,
       x.transaction_type_id AS transaction_type_key, x.transaction_id, CAST(x.amount AS DECIMAL(12,2)) AS amount,
       CAST(CASE WHEN x.direction = 'inflow' THEN x.amount ELSE -x.amount END AS DECIMAL(12,2)) AS signed_amount, x.currency
FROM txd x
JOIN dim_account_a2 da ON x.account_id = da.account_id AND x.d >= da.valid_from AND x.d < da.valid_to
JOIN dim_customer_u2 dc ON da.user_id = dc.user_id AND x.d >= dc.valid_from AND x.d < dc.valid_to""",
    VERSIONS,
)

# --- tables kept by increments end as a full build does
ORACLES["snapshot_increment"] = ORACLES["monthly_snapshot"]
ORACLES["account_summary_increment"] = ORACLES["account_summary"]
ORACLES["check_equal_digest"] = ORACLES["check_equal"]

oracle(
    "csv_rescued",
    """
SELECT CASE WHEN NOT broken THEN user_id END AS user_id, CASE WHEN NOT broken THEN signup_date END AS signup_date,
       CASE WHEN NOT broken THEN n END AS n, CASE WHEN broken THEN line END AS line,
       CASE WHEN broken THEN CASE WHEN n % 77 = 0 OR n % 45 = 0 THEN 'bad_fields' ELSE 'bad_value' END END AS reason
FROM (SELECT *, n % 77 = 0 OR n % 45 = 0 OR n % 30 = 0 AS broken,
             CASE WHEN n % 77 = 0 THEN user_id
                  ELSE user_id || ',' || CASE WHEN n % 30 = 0 THEN 'soon' ELSE CAST(signup_date AS VARCHAR) END || ',' || CAST(n AS VARCHAR)
                       || CASE WHEN n % 45 = 0 THEN ',more' ELSE '' END END AS line
      FROM (SELECT user_id, signup_date, CAST(user_id[2:] AS INTEGER) AS n FROM b_users))""",
)

# --- reference tables, the gate, a full order
oracle(
    "vault_reference",
    """
SELECT 'ref_account_type' AS reference, r.account_type_id AS id, r.type_name, (SELECT count(*) FROM d_accounts d WHERE d.account_type = r.type_name) AS n_rows
FROM account_types r
UNION ALL
SELECT 'ref_transaction_type', r.transaction_type_id, r.type_name, (SELECT count(*) FROM d_transactions d WHERE d.transaction_type = r.type_name)
FROM transaction_types r""",
)
_GATE = _checks(
    _chk("accounts.account_id unique", unique_sql("s_accounts", "account_id")),
    _chk("silver.accounts -> users", fk_sql("s_accounts", "s_users", "user_id")),
    _chk("bronze.accounts -> users", fk_sql("b_accounts", "s_users", "user_id")),
)
oracle("check_gate", f"SELECT *, bool_and(ok) OVER () AS gate FROM ({_GATE})")
oracle(
    "ordered_transactions",
    "SELECT row_number() OVER (ORDER BY transaction_ts, transaction_id) AS place, transaction_id, account_id, transaction_ts FROM s_transactions",
)

# --- streams with keyed state end as the batch loads do
ORACLES["stream_sat_state"] = ORACLES["vault_late_batch"]
ORACLES["stream_hub_state"] = ORACLES["stream_hub"]
