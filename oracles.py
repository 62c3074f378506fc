"""DuckDB SQL for every registered query, on the same Parquet tables."""

from __future__ import annotations

TX_AS_OF = "2001-08-01"
EV_AS_OF = "2024-01-31"

STAGED = """
us AS (
  SELECT c_custkey AS user_id, CAST(first_order AS DATE) AS signup_date,
         c_mktsegment AS acquisition_channel,
         CASE c_custkey % 3 WHEN 0 THEN 'Banking' WHEN 1 THEN 'Invest' ELSE 'Both' END
           AS account_type,
         n_name AS state,
         CASE c_custkey % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
                            WHEN 3 THEN '45-54' ELSE '55+' END AS age_group
  FROM customer
  LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_order FROM orders GROUP BY o_custkey)
    ON o_custkey = c_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey),
priced AS (
  SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'One-Time Deposit'
              WHEN '2-HIGH' THEN 'Recurring Deposit' WHEN '3-MEDIUM' THEN 'Withdrawal'
              ELSE 'Round-Up' END AS kind
  FROM orders),
tx AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS user_id,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CASE WHEN kind = 'Withdrawal' THEN -price ELSE price END AS amount_usd,
         kind AS transaction_type,
         CASE WHEN o_orderstatus = 'F' THEN 'Banking' ELSE 'Invest' END AS product,
         CAST(CASE WHEN kind = 'Round-Up' THEN CEIL(price) - price ELSE 0 END AS DECIMAL(18,2))
           AS round_up
  FROM priced),
ev AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, ts AS event_ts,
         CASE event_type WHEN 'signup' THEN 'Login' WHEN 'view' THEN 'View_Portfolio'
              WHEN 'purchase' THEN 'Deposit' WHEN 'click' THEN 'Withdrawal'
              ELSE CASE WHEN event_type = 'error' AND value > 200 THEN 'Cancel_Account'
                        ELSE 'View_Statement' END END AS event_type,
         CASE event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS platform,
         CAST(value AS DECIMAL(12,2)) AS session_duration_sec
  FROM events),
starters AS (SELECT user_id, MIN(event_date) AS signup_date FROM ev GROUP BY user_id),
recent AS (SELECT * FROM ev WHERE event_date >= DATE '2024-01-31' - 15)
"""

FLOWS = """
  COUNT(*) AS {count},
  CAST(COALESCE(SUM(amount_usd) FILTER (amount_usd > 0), 0) AS DECIMAL(18,2)) AS total_deposited,
  CAST(COALESCE(-SUM(amount_usd) FILTER (amount_usd < 0), 0) AS DECIMAL(18,2)) AS total_withdrawn,
  CAST(SUM(round_up) AS DECIMAL(18,2)) AS total_round_ups,
  CAST(SUM(amount_usd) AS DECIMAL(18,2)) AS {net}
"""
TX_ROLLUP = f"""
  SELECT user_id, {FLOWS.format(count="total_transactions", net="running_balance")},
         MIN(transaction_date) AS first_transaction_date,
         MAX(transaction_date) AS last_transaction_date
  FROM tx GROUP BY user_id
"""
EVENT_ROLLUP = """
  SELECT user_id, COUNT(*) AS total_events, MAX(event_date) AS last_event_date,
         CAST(SUM(session_duration_sec) AS DOUBLE) / COUNT(session_duration_sec)
           AS avg_session_duration_sec,
         BOOL_OR(event_type = 'Cancel_Account') AS has_cancel
  FROM ev GROUP BY user_id
"""


def rate(part: str, whole: str, digits: int) -> str:
    """Half-up percentage in integer arithmetic; NULL when the whole is 0."""
    return ratio(f"100 * CAST({part} AS BIGINT)", whole, digits)


def ratio(num: str, den: str, digits: int) -> str:
    scale = 10**digits
    den = f"NULLIF(CAST({den} AS BIGINT), 0)"
    return f"((({num}) * {2 * scale} + {den}) // (2 * {den})) / {float(scale)}::DOUBLE"


MARTS = f"""
tr AS ({TX_ROLLUP}),
er AS ({EVENT_ROLLUP}),
summary AS (
  SELECT us.*,
         CASE WHEN last_transaction_date IS NULL OR days > 90 THEN 1 ELSE 0 END AS churned,
         CASE WHEN has_cancel THEN 'Explicit'
              WHEN last_transaction_date IS NULL OR days > 90 THEN 'Silent'
              ELSE 'Active' END AS churn_type,
         COALESCE(total_transactions, 0) AS total_transactions,
         COALESCE(total_deposited, 0) AS total_deposited,
         COALESCE(total_withdrawn, 0) AS total_withdrawn,
         COALESCE(total_round_ups, 0) AS total_round_ups,
         COALESCE(running_balance, 0) AS running_balance,
         first_transaction_date, last_transaction_date,
         days AS days_since_last_transaction,
         COALESCE(total_events, 0) AS total_events, last_event_date,
         COALESCE(avg_session_duration_sec, 0) AS avg_session_duration_sec
  FROM us
  LEFT JOIN (SELECT *, CAST(DATE_DIFF('day', last_transaction_date, DATE '{TX_AS_OF}') AS INTEGER)
                         AS days FROM tr) t ON t.user_id = us.user_id
  LEFT JOIN er ON er.user_id = us.user_id),
counted AS (
  SELECT CAST(DATE_TRUNC('month', signup_date) AS DATE) AS cohort_month,
         COUNT(*) AS total_users, CAST(SUM(churned) AS BIGINT) AS churned_users,
         COUNT(*) FILTER (churn_type = 'Explicit') AS explicit_churners,
         COUNT(*) FILTER (churn_type = 'Silent') AS silent_churners
  FROM summary GROUP BY 1),
cohort AS (
  SELECT cohort_month, total_users, churned_users,
         total_users - churned_users AS retained_users,
         {rate("churned_users", "total_users", 1)} AS churn_rate_pct,
         explicit_churners, silent_churners,
         {rate("explicit_churners", "total_users", 1)} AS explicit_churn_rate_pct,
         {rate("silent_churners", "total_users", 1)} AS silent_churn_rate_pct
  FROM counted),
stacked AS (
  UNPIVOT (SELECT cohort_month, churn_rate_pct, churned_users AS "Churned",
                  retained_users AS "Retained" FROM cohort)
  ON "Churned", "Retained" INTO NAME status VALUE users),
flows AS (
  SELECT CAST(DATE_TRUNC('month', transaction_date) AS DATE) AS transaction_month,
         product, transaction_type, {FLOWS.format(count="transaction_count", net="net_flow")}
  FROM tx GROUP BY ALL)
"""

_TX = "amount_usd round_up"
_SUMS = "total_deposited total_withdrawn total_round_ups"
# Exact money columns, shown as DOUBLE.
DECIMALS = {
    "staged_transactions": _TX,
    "preview_transactions": _TX,
    "check_amount_rules": _TX,
    "typed_amounts": _TX,
    "csv_transactions": _TX,
    "events_with_last_transaction": "amount_usd",
    "bucketed_user_summary": f"{_SUMS} running_balance",
    "staged_events": "session_duration_sec",
    "tx_rollup": f"{_SUMS} running_balance",
    "user_summary": f"{_SUMS} running_balance",
    "user_profile": f"{_SUMS} running_balance",
    "transaction_summary": f"{_SUMS} net_flow",
    "flow_by_product_type": "net_flow",
    "favourite_deposit": "favourite_amount",
}


def churn_by(dim: str, limit: str = "") -> str:
    return f"""
SELECT {dim}, CAST(SUM(churned) AS BIGINT) AS churned_users, COUNT(*) AS total_users,
       {rate("SUM(churned)", "COUNT(*)", 2)} AS churn_pct
FROM summary WHERE {dim} IS NOT NULL GROUP BY {dim} ORDER BY churn_pct DESC, {dim} {limit}"""


def value_counts(table: str, column: str) -> str:
    return f"""
SELECT {column}, COUNT(*) AS n_rows FROM {table}
WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY n_rows DESC, {column}"""


def funnel_times(kinds: list[str], days: int, branch: bool) -> str:
    """CTEs t1 … tn: user and time of each step."""
    ctes = [
        f"""t1 AS (SELECT user_id, MIN(event_ts) AS t1 FROM ev
                   WHERE event_type = '{kinds[0]}' GROUP BY user_id)"""
    ]
    for i, kind in enumerate(kinds[1:], start=2):
        after = 1 if branch else i - 1
        ctes.append(
            f"""t{i} AS (SELECT a.user_id, MIN(e.event_ts) AS t{i}
                FROM t{after} a JOIN t1 USING (user_id) JOIN ev e ON e.user_id = a.user_id
                WHERE e.event_type = '{kind}' AND e.event_ts > a.t{after}
                  AND e.event_ts <= t1.t1 + INTERVAL {days} DAY GROUP BY a.user_id)"""
        )
    return ",\n".join(ctes)


def funnel(kinds: list[str], days: int, segment: str | None = None, branch: bool = False) -> str:
    n = len(kinds)
    times = " ".join(f"LEFT JOIN t{i} USING (user_id)" for i in range(2, n + 1))
    counts = ", ".join(f"COUNT(t{i}) AS n{i}" for i in range(1, n + 1))
    key = "" if segment is None else f"{segment}, "
    members = "" if segment is None else f"JOIN us USING (user_id) WHERE {segment} IS NOT NULL"
    group = "" if segment is None else f"GROUP BY {segment}"
    rows = " UNION ALL ".join(
        f"""SELECT {key}{i} AS step_no, '{kind}' AS step, n{i} AS users,
            {rate(f"n{i}", "n1", 2)} AS pct_of_first,
            {rate(f"n{i}", "n1" if branch or i == 1 else f"n{i - 1}", 2)} AS pct_of_previous
            FROM reached"""
        for i, kind in enumerate(kinds, start=1)
    )
    return f"""WITH_STAGED, {funnel_times(kinds, days, branch)},
reached AS (SELECT {key}{counts} FROM t1 {times} {members} {group})
{rows}"""


def retention(unit: str, by: str | None, event_filter: str) -> str:
    extra = "" if by is None else f", {by}"
    join = "" if by is None else "JOIN summary USING (user_id)"
    on = "" if by is None else f"AND c.{by} = g.{by}"
    g_extra = "" if by is None else f", g.{by}"
    trunc = {
        "day": "{0}",
        "week": "CAST(DATE_TRUNC('week', {0}) AS DATE)",
    }[unit]
    step = {"day": 1, "week": 7}[unit]
    return f"""WITH_MARTS,
base AS (SELECT starters.user_id, {trunc.format("starters.signup_date")} AS cohort{extra}
         FROM starters {join}),
active AS (SELECT DISTINCT user_id, {trunc.format("event_date")} AS active FROM ev
           WHERE event_date <= DATE '{EV_AS_OF}' {event_filter}),
c AS (SELECT cohort{extra}, (active - cohort) // {step} AS period, COUNT(*) AS users
      FROM active JOIN base USING (user_id) WHERE active >= cohort GROUP BY ALL),
sizes AS (SELECT cohort{extra}, COUNT(*) AS cohort_size FROM base GROUP BY ALL),
g AS (SELECT *, UNNEST(RANGE(0, ({trunc.format(f"DATE '{EV_AS_OF}'")} - cohort) // {step} + 1))
        AS period FROM sizes)
SELECT g.cohort{g_extra}, CAST(g.period AS INTEGER) AS period, cohort_size,
       COALESCE(users, 0) AS users, {rate("COALESCE(users, 0)", "cohort_size", 2)} AS pct
FROM g LEFT JOIN c ON c.cohort = g.cohort AND c.period = g.period {on}"""


def events_per_user(group: str, event_filter: str, grain: str) -> str:
    start = "event_date" if grain == "day" else f"CAST(DATE_TRUNC('{grain}', event_date) AS DATE)"
    return f"""
SELECT {start} AS period_start, {group}, COUNT(*) AS events, COUNT(DISTINCT ev.user_id) AS users,
       {ratio("COUNT(*)", "COUNT(DISTINCT ev.user_id)", 2)} AS events_per_user
FROM ev JOIN summary USING (user_id) {event_filter} GROUP BY ALL"""


def paths(target: str, depth: int) -> str:
    lags = ", ".join(f"LAG(event_type, {i}) OVER w" for i in range(depth, 0, -1))
    return f"""
SELECT path, COUNT(*) AS occurrences, COUNT(DISTINCT user_id) AS users FROM (
  SELECT user_id, event_type, CONCAT_WS(' > ', {lags}, event_type) AS path FROM ev
  WINDOW w AS (PARTITION BY user_id ORDER BY event_ts, event_id))
WHERE event_type = '{target}' GROUP BY path"""


CANDIDATES = f"""
candidates AS (
  SELECT user_id, MAX(transaction_date) AS last_transaction_date FROM tx GROUP BY user_id
  HAVING MAX(transaction_date) < DATE '{TX_AS_OF}' - 90),
chosen AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (ORDER BY LEFT(MD5(CONCAT(CAST(user_id AS VARCHAR), 'cancel')), 15), user_id)
                AS position FROM candidates)
  WHERE position <= (SELECT GREATEST(1, FLOOR(COUNT(*) * 0.3::DOUBLE)) FROM candidates))
"""

EVENT_PAYLOAD = """
SELECT *, CAST(TO_JSON({'user_id': user_id, 'event_type': event_type, 'time': time,
         'platform': platform, 'event_properties': {'platform': platform,
         'session_duration_sec': session_duration_sec}, 'insert_id': insert_id}) AS VARCHAR)
         AS body
FROM (SELECT 'user_' || user_id AS user_id, event_type, EPOCH_US(event_ts) // 1000 AS time, platform,
             CAST(event_id AS VARCHAR) AS insert_id,
             CAST(TRUNC(session_duration_sec) AS BIGINT) AS session_duration_sec FROM ev)
"""

UNIQUE_SQL = {
    "stg_users": ("us", "user_id"),
    "stg_transactions": ("tx", "transaction_id"),
    "stg_events": ("ev", "event_id"),
    "mart_user_summary": ("summary", "user_id"),
}
NOT_NULL_SQL = {
    "stg_users": ("us", "user_id signup_date acquisition_channel account_type"),
    "stg_transactions": ("tx", "transaction_id user_id transaction_date"),
    "stg_events": ("ev", "event_id user_id event_date"),
    "mart_user_summary": ("summary", "user_id"),
    "mart_churn_cohort": ("cohort", "cohort_month"),
    "mart_churn_cohort_stacked": ("stacked", "cohort_month"),
    "mart_transaction_summary": ("flows", "transaction_month"),
}


WRONG_LABELS = """(SELECT * REPLACE (CASE user_id % 7 WHEN 0 THEN 'Explicit' WHEN 1 THEN 'Silent'
  WHEN 2 THEN 'Active' ELSE churn_type END AS churn_type) FROM summary)"""


def churn_type_issues(cancels: str, days: int, summary: str = "summary") -> str:
    return f"""
SELECT * FROM (
  SELECT user_id, churn_type, churned, days_since_last_transaction,
         CASE WHEN churn_type = 'Explicit' AND user_id NOT IN
                   (SELECT user_id FROM {cancels} WHERE event_type = 'Cancel_Account')
              THEN 'explicit_missing_event'
              WHEN churn_type = 'Silent' AND days_since_last_transaction <= {days}
              THEN 'silent_too_recent'
              WHEN churn_type = 'Active' AND churned = 1 THEN 'active_marked_churned' END AS issue
  FROM {summary}) WHERE issue IS NOT NULL"""


def full_batches(table: str, key: str, size: int) -> str:
    """Batch sizes: all full but the last. Which rows share a batch is not prescribed."""
    return f"""
SELECT batch_no, COUNT(*) AS n_rows, COUNT(DISTINCT {key}) AS keys
FROM (SELECT {key}, (ROW_NUMBER() OVER (ORDER BY {key}) - 1) // {size} AS batch_no FROM {table})
GROUP BY batch_no"""


# Tables and their columns as the exports hold them; money and doubles need a stated form.
EXPORTED = {
    "mart_user_summary": (
        "summary",
        "user_id signup_date acquisition_channel account_type state age_group churned churn_type "
        "total_transactions total_deposited:money total_withdrawn:money total_round_ups:money "
        "running_balance:money first_transaction_date last_transaction_date "
        "days_since_last_transaction total_events last_event_date avg_session_duration_sec:double",
    ),
    "mart_churn_cohort": (
        "cohort",
        "cohort_month total_users churned_users retained_users churn_rate_pct:double "
        "explicit_churners silent_churners explicit_churn_rate_pct:double silent_churn_rate_pct:double",
    ),
    "mart_churn_cohort_stacked": ("stacked", "cohort_month status users churn_rate_pct:double"),
    "mart_transaction_summary": (
        "flows",
        "transaction_month product transaction_type transaction_count total_deposited:money "
        "total_withdrawn:money total_round_ups:money net_flow:money",
    ),
}


def export_digest() -> str:
    forms = {
        "": "CAST({0} AS VARCHAR)",
        "money": "CAST(CAST({0} AS DECIMAL(18,2)) AS VARCHAR)",
        "double": "CAST(CAST(FLOOR({0} * 1000000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS VARCHAR)",
    }
    rows = []
    for name, (table, columns) in EXPORTED.items():
        texts = {}
        for column in columns.split():
            column, _, kind = column.partition(":")
            texts[column] = forms[kind].format(column)
        whole = ", ".join(f"COALESCE({text}, '\\N')" for text in texts.values())
        texts["*"] = f"CONCAT_WS('|', {whole})"
        rows += [
            f"""SELECT '{name}' AS table_name, '{column}' AS column_name, COUNT(*) AS n_rows,
            COUNT(*) FILTER ({text} IS NULL) AS n_nulls,
            CAST(COALESCE(SUM(CAST('0x' || LEFT(MD5({text}), 15) AS HUGEINT)), 0) AS VARCHAR) AS digest
            FROM {table}"""
            for column, text in texts.items()
        ]
    return " UNION ALL ".join(rows)


DIMENSIONS = ("platform", "account_type", "acquisition_channel")


def segment_combinations() -> str:
    rows = []
    for bits in range(1, 8):
        chosen = [d for i, d in enumerate(DIMENSIONS) if bits >> i & 1]
        shown = ", ".join(d if d in chosen else f"CAST(NULL AS VARCHAR) AS {d}" for d in DIMENSIONS)
        present = " AND ".join(f"{d} IS NOT NULL" for d in chosen)
        rows.append(f"""SELECT '{" & ".join(chosen)}' AS combination, event_type, {shown},
            COUNT(*) AS events, COUNT(DISTINCT user_id) AS users
            FROM ev LEFT JOIN us USING (user_id) WHERE {present}
            GROUP BY event_type, {", ".join(chosen)}""")
    return " UNION ALL ".join(rows)


def request_bodies(payload: str, key: str, order: str, size: int) -> str:
    """Batches in the order of the seeded MD5 of their key, rows in the order of their fields."""
    return f"""
SELECT batch_no, COUNT(*) AS n_rows, '[' || STRING_AGG(body, ',' ORDER BY {order}) || ']' AS body
FROM (SELECT *, (ROW_NUMBER() OVER (ORDER BY LEFT(MD5({key} || 'send'), 15), {key}) - 1) // {size}
        AS batch_no FROM ({payload}))
GROUP BY batch_no"""


def quality_report() -> str:
    checks = {}
    for name, (table, key) in UNIQUE_SQL.items():
        checks[f"unique:{name}.{key}"] = (
            f"SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1"
        )
    for name, (table, columns) in NOT_NULL_SQL.items():
        for column in columns.split():
            checks[f"not_null:{name}.{column}"] = f"SELECT 1 FROM {table} WHERE {column} IS NULL"
    checks["churn_type_logic"] = churn_type_issues("ev", 90)
    expected = rate("churned_users", "total_users", 1)
    checks["churn_rate_consistency"] = (
        f"SELECT 1 FROM cohort WHERE total_users = 0 OR churn_rate_pct IS DISTINCT FROM {expected}"
    )
    for name, table in (("stg_transactions", "tx"), ("stg_events", "ev")):
        checks[f"orphans:{name}"] = (
            f"SELECT DISTINCT user_id FROM {table} WHERE user_id NOT IN (SELECT user_id FROM us)"
        )
    counted = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, COUNT(*) AS violations FROM ({sql})"
        for name, sql in checks.items()
    )
    return f"""
SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({counted})"""


IDENTIFY_PAYLOAD = """
SELECT *, CAST(TO_JSON({'user_id': user_id, 'user_properties': {'$set': {
         'signup_date': signup_date, 'acquisition_channel': acquisition_channel,
         'account_type': account_type, 'state': state, 'age_group': age_group,
         'churned': churned, 'churn_type': churn_type}}}) AS VARCHAR) AS body
FROM (SELECT 'user_' || user_id AS user_id, signup_date, acquisition_channel, account_type,
             state, age_group, churned = 1 AS churned, churn_type FROM summary)"""


SESSIONS = """
SELECT user_id, CAST(session_no AS INTEGER) AS session_no, MIN(event_ts) AS session_start,
       MAX(event_ts) AS session_end, COUNT(*) AS events,
       EPOCH_US(MAX(event_ts)) // 1000 // 60000 - EPOCH_US(MIN(event_ts)) // 1000 // 60000 AS whole
FROM (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY event_ts, event_id
                                 ROWS UNBOUNDED PRECEDING) AS session_no
      FROM (SELECT *, CASE WHEN event_ts <= LAG(event_ts) OVER (
                             PARTITION BY user_id ORDER BY event_ts, event_id) + INTERVAL 12 HOUR
                           THEN 0 ELSE 1 END AS opens FROM ev))
GROUP BY user_id, session_no"""
SESSION_MINUTES = "(EPOCH_US(session_end) // 1000 - EPOCH_US(session_start) // 1000) // 60000"


def _statements() -> dict[str, str]:
    """Statements whose tables come from the staged / mart CTEs put in front of them."""
    reach = ("View_Portfolio", "Deposit", "Withdrawal")
    flags = ", ".join(
        f"COUNT(DISTINCT user_id) FILTER (event_type = '{s}') AS {s}" for s in ("Login", *reach)
    )
    reach_rows = " UNION ALL ".join(
        f"""SELECT account_type, '{s}' AS step, {s} AS users,
            {rate(s, "Login", 2)} AS pct_of_base FROM reach"""
        for s in ("Login", *reach)
    )
    segment_rows = " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, {d} AS segment, event_type, COUNT(*) AS events,
            COUNT(DISTINCT user_id) AS users
            FROM ev LEFT JOIN us USING (user_id) WHERE {d} IS NOT NULL GROUP BY ALL"""
        for d in ("platform", "account_type", "acquisition_channel")
    )
    each_rows = " UNION ALL ".join(
        f"""SELECT '{d}' AS dimension, {d} AS segment, CAST(SUM(churned) AS BIGINT)
            AS churned_users, COUNT(*) AS total_users,
            {rate("SUM(churned)", "COUNT(*)", 2)} AS churn_pct
            FROM summary WHERE {d} IS NOT NULL GROUP BY {d}"""
        for d in ("age_group", "acquisition_channel", "account_type", "state")
    )
    null_columns = ("user_id", "signup_date", "last_transaction_date", "last_event_date")
    null_rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS nulls FROM summary"
        for c in null_columns
    )
    expected = rate("churned_users", "total_users", 1)
    logins = "WHERE event_type = 'Login'"
    return {
        "staged_users": "SELECT * FROM us",
        "staged_transactions": "SELECT * FROM tx",
        "staged_events": "SELECT * FROM ev",
        "row_counts": """
SELECT 'users' AS table_name, COUNT(*) AS n_rows FROM us
UNION ALL SELECT 'transactions', COUNT(*) FROM tx
UNION ALL SELECT 'events', COUNT(*) FROM ev""",
        "preview_transactions": "SELECT * FROM tx ORDER BY transaction_id LIMIT 3",
        "events_of_type": """
SELECT event_id, user_id, event_type FROM ev WHERE event_type IN ('Login', 'Deposit')""",
        "ingest_window": "SELECT event_id, event_date FROM recent",
        "tx_rollup": TX_ROLLUP,
        "event_rollup": EVENT_ROLLUP,
        "cancelled_users": "SELECT DISTINCT user_id FROM ev WHERE event_type = 'Cancel_Account'",
        "last_transaction": """
SELECT user_id, MAX(transaction_date) AS last_transaction_date FROM tx GROUP BY user_id""",
        "user_summary": "SELECT * FROM summary",
        "user_profile": "SELECT * FROM summary WHERE user_id = 42",
        "churn_cohort": "SELECT * FROM cohort ORDER BY cohort_month",
        "churn_cohort_stacked": "SELECT * FROM stacked ORDER BY cohort_month, status DESC",
        "cohort_at": """
SELECT cohort_month, churn_rate_pct, churned_users, retained_users, total_users FROM cohort
WHERE cohort_month IN (DATE '1995-01-01', DATE '1995-03-01', DATE '1996-02-01')""",
        "transaction_summary": "SELECT * FROM flows",
        "flow_by_product_type": """
SELECT product, transaction_type, CAST(SUM(transaction_count) AS BIGINT) AS transaction_count,
       CAST(SUM(net_flow) AS DECIMAL(18,2)) AS net_flow
FROM flows GROUP BY product, transaction_type""",
        "exported_marts": """
SELECT 'mart_user_summary' AS table_name, COUNT(*) AS n_rows FROM summary
UNION ALL SELECT 'mart_churn_cohort', COUNT(*) FROM cohort
UNION ALL SELECT 'mart_churn_cohort_stacked', COUNT(*) FROM stacked
UNION ALL SELECT 'mart_transaction_summary', COUNT(*) FROM flows""",
        "headline": f"""
SELECT COUNT(*) AS total_users, CAST(SUM(churned) AS BIGINT) AS churned_users,
       {rate("SUM(churned)", "COUNT(*)", 2)} AS churn_pct FROM summary""",
        "churn_by_age_group": churn_by("age_group"),
        "churn_by_channel": churn_by("acquisition_channel"),
        "churn_by_account_type": churn_by("account_type"),
        "churn_by_state_top10": churn_by("state", "LIMIT 10"),
        "churn_by_each_segment": each_rows,
        "churn_type_counts": value_counts("summary", "churn_type"),
        "event_type_counts": value_counts("ev", "event_type"),
        "step_reach": f"""WITH_STAGED,
reach AS (SELECT account_type, {flags} FROM ev JOIN us USING (user_id)
          WHERE event_type IN ('Login', 'View_Portfolio', 'Deposit', 'Withdrawal')
          GROUP BY account_type)
{reach_rows}""",
        "events_with_account_type": """
SELECT event_id, user_id, event_type, account_type FROM ev LEFT JOIN us USING (user_id)""",
        "segment_counts": segment_rows,
        "session_stats": """
SELECT event_type, churned, COUNT(*) AS events,
       CAST(SUM(session_duration_sec) AS DOUBLE) / COUNT(session_duration_sec)
         AS avg_session_duration_sec
FROM ev JOIN summary USING (user_id) GROUP BY event_type, churned""",
        "funnel": funnel(["Login", "View_Portfolio", "Deposit"], 1),
        "funnel_by_account_type": funnel(["Login", "View_Portfolio", "Deposit"], 7, "account_type"),
        "branch_funnel": funnel(["Login", "Deposit", "Withdrawal"], 1, "account_type", True),
        "retention": retention("day", None, ""),
        "login_retention_by_churn_type": retention(
            "week", "churn_type", "AND event_type = 'Login'"
        ),
        "logins_per_user": events_per_user("churned", logins, "week"),
        "events_per_user_by_churn_type": events_per_user("churn_type", "", "month"),
        "crossover": f"""WITH_MARTS, series AS ({events_per_user("churned", logins, "day")}),
pivoted AS (SELECT period_start,
              COALESCE(MAX(events_per_user) FILTER (churned = 0), 0) AS value_a,
              COALESCE(MAX(events_per_user) FILTER (churned = 1), 0) AS value_b
            FROM series GROUP BY period_start),
compared AS (SELECT *, LAG(value_a > value_b) OVER (ORDER BY period_start) AS was_over
             FROM pivoted)
SELECT period_start, value_a, value_b FROM compared
WHERE value_a > value_b AND NOT was_over ORDER BY period_start LIMIT 1""",
        "active_share": f"""
SELECT period_start, active_users, users_so_far,
       {rate("active_users", "users_so_far", 2)} AS active_pct FROM (
  SELECT event_date AS period_start, COUNT(DISTINCT user_id) AS active_users,
         (SELECT COUNT(*) FROM starters WHERE signup_date <= event_date) AS users_so_far
  FROM ev GROUP BY event_date)""",
        "paths_to_withdrawal": paths("Withdrawal", 3),
        "paths_to_cancel": paths("Cancel_Account", 2),
        "inactive_users": f"""
SELECT user_id, last_event_date, CAST(DATE '2024-01-20' - last_event_date AS INTEGER)
         AS days_inactive,
       CASE WHEN last_event_date IS NULL THEN 'never' ELSE 'lapsed' END AS status
FROM us LEFT JOIN (SELECT user_id, MAX(event_date) AS last_event_date FROM ev {logins} AND event_date <= DATE '2024-01-20'
                   GROUP BY user_id) USING (user_id)
WHERE last_event_date IS NULL OR DATE '2024-01-20' - last_event_date > 3""",
        "stalled_at": f"""
SELECT user_id, f AS stalled_since,
       (EPOCH_US(TIMESTAMP '{EV_AS_OF}') // 1000 - EPOCH_US(f) // 1000) // 3600000 AS hours_stalled
FROM (SELECT user_id, MAX(event_ts) FILTER (event_type = 'View_Portfolio') AS f,
             MAX(event_ts) FILTER (event_type = 'Deposit') AS t
      FROM ev WHERE event_ts <= TIMESTAMP '{EV_AS_OF}' GROUP BY user_id)
WHERE f IS NOT NULL AND (t IS NULL OR t <= f)
  AND EPOCH_US(TIMESTAMP '{EV_AS_OF}') // 1000 - EPOCH_US(f) // 1000 >= 48 * 3600000""",
        "favourite_deposit": """
SELECT user_id, amount_usd AS favourite_amount, n AS times FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, amount_usd) AS rn
  FROM (SELECT user_id, amount_usd, COUNT(*) AS n FROM tx WHERE amount_usd > 0 GROUP BY ALL))
WHERE rn = 1""",
        "check_unique": "SELECT user_id, COUNT(*) AS n_rows FROM ev GROUP BY user_id HAVING COUNT(*) > 1",
        "null_counts": null_rows,
        "check_not_null": """
SELECT 'last_event_date' AS column_name, COUNT(*) AS nulls FROM summary
WHERE last_event_date IS NULL HAVING COUNT(*) > 0""",
        "explicit_without_cancel": f"""
SELECT user_id, churn_type FROM {WRONG_LABELS} WHERE churn_type = 'Explicit' AND user_id NOT IN
  (SELECT user_id FROM ev WHERE event_type = 'Cancel_Account')""",
        "check_churn_type": churn_type_issues("ev", 90, WRONG_LABELS),
        "check_churn_rate": f"""
SELECT cohort_month, total_users, churned_users, explicit_churn_rate_pct AS churn_rate_pct,
       {expected} AS expected_churn_rate_pct FROM cohort
WHERE total_users = 0 OR explicit_churn_rate_pct IS DISTINCT FROM {expected}""",
        "check_orphans": """
SELECT user_id, COUNT(*) AS n_rows FROM tx WHERE user_id NOT IN (SELECT user_id FROM starters)
GROUP BY user_id""",
        "check_domain": """
SELECT acquisition_channel AS value, COUNT(*) AS n_rows FROM us WHERE acquisition_channel
  NOT IN ('Organic', 'Referral', 'Paid Social', 'Email', 'App Store') GROUP BY 1""",
        "check_product_matches_account": """
SELECT transaction_id, user_id, product, account_type FROM tx JOIN us USING (user_id)
WHERE account_type IN ('Banking', 'Invest') AND product <> account_type""",
        "check_activity_bounds": """
SELECT * FROM (
  SELECT event_id, user_id, event_date, signup_date,
         CASE WHEN event_date < signup_date THEN 'before_signup'
              WHEN event_date > DATE '2024-01-20' THEN 'after_as_of' END AS issue
  FROM ev LEFT JOIN starters USING (user_id)) WHERE issue IS NOT NULL""",
        "check_amount_rules": """
SELECT * FROM (
  SELECT transaction_id, transaction_type, amount_usd, round_up,
         CASE WHEN transaction_type = 'Withdrawal' AND NOT amount_usd < 0
                OR transaction_type <> 'Withdrawal' AND NOT amount_usd > 0 THEN 'wrong_sign'
              WHEN transaction_type = 'Round-Up'
                   AND NOT ABS(amount_usd) BETWEEN 0.01 AND 250000 THEN 'amount_out_of_range'
              WHEN transaction_type <> 'Round-Up'
                   AND NOT ABS(amount_usd) BETWEEN 50000 AND 400000 THEN 'amount_out_of_range'
              WHEN transaction_type <> 'Round-Up' AND round_up <> 0 THEN 'unexpected_round_up'
         END AS issue
  FROM tx) WHERE issue IS NOT NULL""",
        "quality_report": quality_report(),
        "typed_amounts": "SELECT transaction_id, transaction_type, amount_usd, round_up FROM tx",
        "churn_candidates": f"WITH_STAGED, {CANDIDATES} SELECT * FROM candidates",
        "sampled_candidates": f"WITH_STAGED, {CANDIDATES} SELECT * FROM chosen",
        "append_events": "SELECT event_id, user_id, event_type, event_date FROM ev",
        "identify_payload": IDENTIFY_PAYLOAD,
        "event_payload": EVENT_PAYLOAD,
        "streamed_events_once": "SELECT event_id, user_id, event_type, event_ts FROM ev",
        "streamed_lapses": f"""WITH_STAGED,
clock AS (SELECT MAX(event_ts) FILTER (event_date < DATE '2024-01-15') - INTERVAL 1 DAY AS first_run,
                 MAX(event_ts) - INTERVAL 1 DAY AS second_run FROM ev),
early AS (SELECT user_id, MAX(event_date) AS last_event_date FROM ev {logins}
          AND event_date < DATE '2024-01-15' GROUP BY user_id),
every AS (SELECT user_id, MAX(event_date) AS last_event_date FROM ev {logins} GROUP BY user_id)
SELECT user_id, last_event_date, last_event_date + 4 AS lapsed_on FROM early, clock
WHERE CAST(last_event_date + 4 AS TIMESTAMP) < first_run
UNION SELECT user_id, last_event_date, last_event_date + 4 FROM every, clock
WHERE CAST(last_event_date + 4 AS TIMESTAMP) < second_run""",
        "bucketed_user_summary": "SELECT * FROM summary",
        "incremental_rollup": EVENT_ROLLUP,
        "sketch_errors": """
SELECT event_type, CAST(COUNT(*) AS BIGINT) AS events, COUNT(*) AS n, true AS users_near,
       true AS p50_near, true AS p90_near, true AS p99_near
FROM ev GROUP BY event_type""",
        "sessions": f"SELECT * EXCLUDE (whole), {SESSION_MINUTES} AS minutes FROM ({SESSIONS})",
        "sessions_per_day": f"""
SELECT user_id, CAST(session_start AS DATE) AS session_day, COUNT(*) AS sessions,
       CAST(SUM(events) AS BIGINT) AS events, MAX({SESSION_MINUTES}) AS longest_minutes
FROM ({SESSIONS}) GROUP BY 1, 2""",
        "events_with_last_transaction": """
SELECT event_id, user_id, event_ts, transaction_id, transaction_date, amount_usd FROM (
  SELECT e.event_id, e.user_id, e.event_ts, transaction_id, transaction_date, amount_usd,
         ROW_NUMBER() OVER (PARTITION BY e.event_id ORDER BY transaction_date DESC, transaction_id DESC) AS place
  FROM ev e LEFT JOIN tx ON tx.user_id = e.user_id AND transaction_date <= e.event_ts)
WHERE place = 1""",
        "deposits_with_last_view": """
SELECT event_id, user_id, event_ts, view_id, viewed_at, platform FROM (
  SELECT d.event_id, d.user_id, d.event_ts, v.event_id AS view_id, v.event_ts AS viewed_at, v.platform,
         ROW_NUMBER() OVER (PARTITION BY d.event_id ORDER BY v.event_ts DESC, v.event_id DESC) AS place
  FROM ev d LEFT JOIN ev v ON v.user_id = d.user_id AND v.event_type = 'View_Portfolio'
    AND v.event_ts <= d.event_ts AND v.event_ts >= d.event_ts - INTERVAL 3 DAY
  WHERE d.event_type = 'Deposit')
WHERE place = 1""",
        "deposits_after_logins": """
SELECT d.event_id, MAX(d.user_id) AS user_id, COUNT(*) AS n_before, MAX(l.event_ts) AS latest_before
FROM ev d JOIN ev l ON l.user_id = d.user_id AND l.event_type = 'Login'
  AND l.event_ts <= d.event_ts AND l.event_ts >= d.event_ts - INTERVAL 48 HOUR
WHERE d.event_type = 'Deposit' GROUP BY d.event_id""",
        "identify_requests": request_bodies(IDENTIFY_PAYLOAD, "user_id", "user_id", 100),
        "event_request_bodies": request_bodies(
            EVENT_PAYLOAD, "insert_id",
            "user_id, event_type, time, platform, session_duration_sec, insert_id", 500,
        ),
        "export_digest": export_digest(),
        "csv_users": "SELECT * FROM us",
        "csv_transactions": "SELECT * FROM tx",
        "csv_events": """
SELECT event_id, user_id, event_date, CAST(event_date AS TIMESTAMP) AS event_ts, event_type, platform,
       CAST(TRUNC(session_duration_sec) AS BIGINT) AS session_duration_sec FROM ev""",
        "segment_combinations": segment_combinations(),
        "user_batches": full_batches("us", "user_id", 100),
        "event_batches": full_batches("ev", "event_id", 500),
        "event_requests": f"""
SELECT COUNT(*) AS requests, MAX(n) AS largest, CAST(SUM(n) AS BIGINT) AS n_rows,
       CAST(SUM(body_length) AS BIGINT) AS characters
FROM (SELECT COUNT(*) AS n, SUM(LENGTH(body) + 1) + 1 AS body_length
      FROM (SELECT body, (ROW_NUMBER() OVER (ORDER BY insert_id) - 1) // 500 AS batch_no
            FROM ({EVENT_PAYLOAD})) GROUP BY batch_no)""",
    }


def oracle_sql() -> dict[str, str]:
    staged, marts = f"WITH {STAGED}", f"WITH {STAGED}, {MARTS}"
    needs_marts = ("summary", "cohort", "stacked", "flows")
    out = {}
    for name, sql in _statements().items():
        if "WITH_" in sql:
            sql = sql.replace("WITH_STAGED", staged).replace("WITH_MARTS", marts)
        else:
            sql = (marts if any(t in sql for t in needs_marts) else staged) + sql
        if name in DECIMALS:
            shown = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMALS[name].split())
            sql = f"SELECT * REPLACE ({shown}) FROM ({sql})"
        out[name] = sql
    return out
