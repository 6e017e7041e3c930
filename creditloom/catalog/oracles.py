"""Result of each registered query as SQL over the given tables (DuckDB dialect).

Stated from the meaning of the operator and the table mapping, independent of
the DataFrame code. Queries without an entry have only their row count checked.
"""

from __future__ import annotations

SNAPS = "('1997-12-31'), ('1998-12-31'), ('1999-12-31'), ('2000-12-31'), ('2001-12-31')"

CREDIT = f"""
snaps AS (SELECT CAST(d AS DATE) AS snapshot_date FROM (VALUES {SNAPS}) AS v(d)),
credit0 AS (
  SELECT o_orderkey AS loan_id, snapshot_date, CAST(o_orderdate AS DATE) AS sale_date,
         o_orderstatus AS st, o_orderpriority AS pr,
         CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
         CAST((o_orderkey * 31 + date_diff('day', CAST(o_orderdate AS DATE), snapshot_date)) % 240 - 120
              AS BIGINT) AS raw_dpd
  FROM orders JOIN snaps ON CAST(o_orderdate AS DATE) <= snapshot_date),
credit AS (
  SELECT loan_id, snapshot_date, snapshot_date AS "date", sale_date, raw_dpd, balance,
         CASE WHEN st = 'F' AND pr = '1-URGENT' THEN 'Write Off'
              WHEN st = 'F' THEN 'Paid Off Loan'
              WHEN st = 'P' AND pr = '5-LOW' THEN 'Returned'
              ELSE 'Existing Active' END AS account_status_l1,
         CASE WHEN pr = '2-HIGH' THEN 'PAR 30' WHEN pr = '3-MEDIUM' THEN 'PAR 7'
              ELSE 'Active' END AS account_status_l2,
         CASE WHEN raw_dpd > 0 THEN balance ELSE CAST(0 AS DECIMAL(18,2)) END AS arrears,
         CAST(balance * 10 AS DECIMAL(20,2)) AS total_due_today,
         CAST(balance * CAST(loan_id % 11 AS INTEGER) AS DECIMAL(20,2)) AS total_paid,
         CAST(snapshot_date - CAST(loan_id % 28 AS INTEGER) AS DATE) AS max_payment_date
  FROM credit0)"""

CUSTOMERS = """
customers AS (
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN -o_orderkey ELSE o_orderkey END AS loan_id,
         CAST(o_orderdate AS DATE) AS sale_date,
         CASE WHEN c_custkey % 5 <> 0
              THEN CAST(DATE '1935-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS DATE) END AS date_of_birth,
         CAST(abs(CAST(c_acctbal AS DECIMAL(18,2))) * 20 AS DECIMAL(20,2)) AS received,
         c_custkey % 13 AS duration, c_mktsegment AS gender, c_nationkey AS citizenship
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

RISK = """
         CASE WHEN account_status_l1 IN ('Write Off', 'Blocked', 'Default', 'Lost') THEN 'Critical'
              WHEN account_status_l2 IN ('PAR 60', 'PAR 90', 'PAR 90+') THEN 'Critical'
              WHEN raw_dpd >= 60 THEN 'Critical'
              WHEN account_status_l2 = 'PAR 30' OR raw_dpd >= 30 THEN 'High'
              WHEN account_status_l2 = 'PAR 7' OR raw_dpd >= 7 THEN 'Medium'
              ELSE 'Low' END AS risk_category"""

CREDIT_FEATURES = f"""{CREDIT},
cfeat AS (
  SELECT *, greatest(raw_dpd, 0) AS days_past_due, {RISK},
         CAST(raw_dpd > 0 AS INTEGER) AS is_delinquent,
         CAST(account_status_l1 = 'Write Off' AS INTEGER) AS is_write_off,
         CAST(account_status_l1 = 'Returned' AS INTEGER) AS is_returned,
         CAST(account_status_l1 = 'Paid Off Loan' AS INTEGER) AS is_paid_off
  FROM credit)"""

FEATURES = f"""{CREDIT_FEATURES}, {CUSTOMERS},
feat0 AS (
  SELECT f.*, c.loan_id AS customer_loan, c.date_of_birth, c.received, c.duration, c.gender, c.citizenship,
         c.sale_date AS customer_sale_date,
         date_diff('day', c.date_of_birth, f.snapshot_date) / 365.25::DOUBLE AS age0,
         CASE WHEN c.duration > 0 THEN CAST(c.received AS DOUBLE) / c.duration END AS avg_monthly_income
  FROM cfeat f LEFT JOIN customers c USING (loan_id)),
feat AS (
  SELECT *, CASE WHEN age0 BETWEEN 0 AND 130 THEN age0 END AS customer_age_years,
         CASE WHEN age0 >= 18 AND age0 < 26 THEN '18-25' WHEN age0 >= 26 AND age0 < 36 THEN '26-35'
              WHEN age0 >= 36 AND age0 < 46 THEN '36-45' WHEN age0 >= 46 AND age0 < 56 THEN '46-55'
              WHEN age0 >= 56 AND age0 <= 130 THEN '55+' END AS age_band,
         CASE WHEN avg_monthly_income < 0 THEN NULL
              WHEN avg_monthly_income < 5000 THEN 'Below 5,000'
              WHEN avg_monthly_income < 10000 THEN '5,000-9,999'
              WHEN avg_monthly_income < 20000 THEN '10,000-19,999'
              WHEN avg_monthly_income < 30000 THEN '20,000-29,999'
              WHEN avg_monthly_income < 50000 THEN '30,000-49,999'
              WHEN avg_monthly_income < 100000 THEN '50,000-99,999'
              WHEN avg_monthly_income < 150000 THEN '100,000-149,999'
              WHEN avg_monthly_income >= 150000 THEN '150,000+' END AS income_band
  FROM feat0)"""

NPS = """
lines AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
  FROM lineitem),
nps AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 1000 + rn AS submission_id, l_orderkey AS loan_id,
         CAST(l_shipdate AS DATE) AS submitted_at, CAST(l_quantity AS INTEGER) % 12 AS nps_score,
         CASE WHEN CAST(l_quantity AS INTEGER) % 12 <= 6 THEN 'Detractor'
              WHEN CAST(l_quantity AS INTEGER) % 12 <= 8 THEN 'Passive'
              WHEN CAST(l_quantity AS INTEGER) % 12 <= 10 THEN 'Promoter' END AS nps_bucket
  FROM lines)"""

ASOF = f"""{FEATURES}, {NPS},
cxn0 AS (
  SELECT n.submission_id, n.loan_id, n.nps_score, n.nps_bucket, n.submitted_at, f.snapshot_date,
         f.days_past_due, f.arrears, f.balance, f.risk_category, f.age_band,
         f.income_band AS avg_monthly_income_band, f.account_status_l2,
         row_number() OVER (PARTITION BY n.submission_id ORDER BY f.snapshot_date DESC NULLS LAST) AS rn
  FROM nps n LEFT JOIN feat f ON f.loan_id = n.loan_id
       AND f.snapshot_date <= coalesce(n.submitted_at, DATE '2002-03-01')),
cxn AS (SELECT * EXCLUDE (rn) FROM cxn0 WHERE rn = 1)"""


def _mean(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE) / nullif(COUNT({column}), 0)"


def _share(predicate: str) -> str:
    return f"ROUND(AVG(CAST({predicate} AS INTEGER)), 6)"


MEAN_POS = "CAST(SUM(CASE WHEN arrears > 0 THEN arrears END) AS DOUBLE) / nullif(count_if(arrears > 0), 0)"

HEALTH = f"""{CREDIT_FEATURES},
health AS (
  SELECT snapshot_date, COUNT(*) AS accounts,
         AVG(CAST(days_past_due > 0 AS INTEGER)) AS delinquency_rate,
         AVG(CAST(days_past_due >= 30 AS INTEGER)) AS par30_rate,
         AVG(CAST(days_past_due >= 60 AS INTEGER)) AS par60_rate,
         AVG(is_write_off) AS write_off_rate, AVG(is_paid_off) AS paid_off_rate,
         AVG(is_returned) AS return_rate,
         CASE WHEN SUM(total_due_today) > 0
              THEN CAST(SUM(total_paid) AS DOUBLE) / CAST(SUM(total_due_today) AS DOUBLE) END AS collection_rate,
         {MEAN_POS} AS avg_arrears, {_mean('balance')} AS avg_balance,
         CAST(SUM(balance) AS DECIMAL(28,2)) AS portfolio_balance
  FROM cfeat GROUP BY snapshot_date)"""

BANDED = f"""COUNT(*) AS accounts,
  AVG(CAST(days_past_due > 0 AS INTEGER)) AS delinquency_rate,
  AVG(CAST(days_past_due >= 30 AS INTEGER)) AS par30_rate,
  AVG(is_write_off) AS write_off_rate, AVG(is_paid_off) AS paid_off_rate,
  {_mean('balance')} AS avg_balance"""

BY_AGE = f"""{FEATURES},
by_age AS (SELECT snapshot_date, coalesce(age_band, 'Unknown') AS band, {BANDED}, {MEAN_POS} AS avg_arrears
           FROM feat GROUP BY 1, 2)"""
BY_INCOME = f"""{FEATURES},
by_income AS (SELECT snapshot_date, coalesce(income_band, 'Unknown') AS band, {BANDED}
              FROM feat GROUP BY 1, 2)"""
BY_RISK = f"""{CREDIT_FEATURES},
by_risk AS (SELECT snapshot_date, risk_category, COUNT(*) AS accounts,
                   CAST(SUM(balance) AS DECIMAL(28,2)) AS balance, AVG(days_past_due) AS avg_dpd,
                   {MEAN_POS} AS avg_arrears
            FROM cfeat GROUP BY 1, 2)"""
BY_BUCKET = f"""{ASOF},
by_bucket AS (
  SELECT CASE WHEN days_past_due IS NULL THEN 'no_match' WHEN days_past_due = 0 THEN '0 (current)'
              WHEN days_past_due <= 7 THEN '1-7' WHEN days_past_due <= 30 THEN '8-30'
              WHEN days_past_due <= 60 THEN '31-60' WHEN days_past_due <= 90 THEN '61-90'
              ELSE '90+' END AS dpd_bucket,
         COUNT(*) AS respondents, {_mean('nps_score')} AS avg_nps,
         AVG(CAST(nps_score >= 9 AS INTEGER)) AS promoter_rate,
         AVG(CAST(nps_score <= 6 AS INTEGER)) AS detractor_rate
  FROM cxn WHERE nps_score IS NOT NULL GROUP BY 1)"""

SCORES = """ROUND(avg_nps, 6) AS avg_nps, ROUND(promoter_rate, 6) AS promoter_rate,
  ROUND(detractor_rate, 6) AS detractor_rate"""
BANDED_OUT = """accounts, ROUND(delinquency_rate, 6) AS delinquency_rate, ROUND(par30_rate, 6) AS par30_rate,
  ROUND(write_off_rate, 6) AS write_off_rate, ROUND(paid_off_rate, 6) AS paid_off_rate,
  ROUND(avg_balance, 6) AS avg_balance"""


def _pivot(source: str, key: str, having: str) -> str:
    days = ["1997-12-31", "1998-12-31", "1999-12-31", "2000-12-31", "2001-12-31"]
    cells = ",\n".join(
        f"ROUND(AVG(CASE WHEN snapshot_date = DATE '{d}' THEN delinquency_rate END) * 100, 6) AS \"{d}\""
        for d in days
    )
    return f"SELECT band AS {key}, {cells} FROM {source} WHERE {having} GROUP BY band"


HOLEY = f"""{CREDIT},
holey AS (
  SELECT loan_id, snapshot_date, "date",
         CASE WHEN loan_id % 40 <> 0 THEN sale_date END AS sale_date,
         CASE WHEN loan_id % 3 = 0 THEN account_status_l1 END AS account_status_l1,
         CASE WHEN (loan_id + year(snapshot_date)) % 4 <> 0 THEN account_status_l2 END AS account_status_l2
  FROM credit)"""

COPIES = f"""{CREDIT},
copied AS (SELECT * FROM credit UNION ALL SELECT * FROM credit WHERE loan_id % 97 = 0)"""

# raw text export of the credit table: the row, an older copy, a blank row
RAW_CREDIT = f"""{CREDIT},
kinds AS (
  SELECT *, 0 AS kind FROM credit
  UNION ALL SELECT *, 1 FROM credit WHERE loan_id % 7 = 0
  UNION ALL SELECT *, 2 FROM credit WHERE loan_id % 10 = 0),
typed AS (
  SELECT CAST(loan_id AS VARCHAR) AS loan_id, snapshot_date, "date", sale_date,
         CAST(max_payment_date - CASE WHEN kind = 1 THEN 40 ELSE 0 END AS DATE) AS max_payment_date,
         account_status_l1, account_status_l2,
         CASE WHEN loan_id % 17 <> 0 THEN CAST(raw_dpd AS DOUBLE) END AS days_past_due,
         CAST(arrears AS DOUBLE) AS arrears, CAST(balance + kind AS DOUBLE) AS balance,
         CAST(balance AS DOUBLE) AS closing_balance,
         CAST(date_diff('day', sale_date, snapshot_date) AS VARCHAR) AS loan_age_days, kind
  FROM kinds WHERE kind <> 2)"""

LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
RANKED_LINES = f"""
line_cols AS (SELECT {LINE_COLUMNS}, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY ship_date DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC) AS rn
  FROM line_cols)"""

SALES = """
sales0 AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS loan_id,
         'S' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS sale_id,
         CAST(l_shipdate AS DATE) AS sale_date, CAST(l_shipdate AS DATE) + 30 AS return_date,
         l_quantity < 5 AS returned,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS cash_price, 'p' || l_partkey AS product_name
  FROM lineitem),
sales AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY sale_date DESC, sale_id DESC,
        return_date DESC, returned DESC, cash_price DESC, product_name DESC) AS rn FROM sales0) WHERE rn = 1)"""
DOB = """
dob0 AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS loan_id,
         CAST(CAST(l_shipdate AS DATE) - CAST((l_suppkey % 60 + 18) * 365 AS INTEGER) AS DATE) AS date_of_birth,
         CAST(l_shipdate AS DATE) AS created_date, CAST(l_linenumber AS INTEGER) AS created_second
  FROM lineitem),
dob AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id
        ORDER BY created_date DESC, created_second DESC, date_of_birth DESC) AS rn FROM dob0) WHERE rn = 1)"""
INCOME = """
income0 AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS duration,
         CASE WHEN l_partkey % 23 <> 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS received,
         CAST(l_suppkey AS DOUBLE) AS persons_received_from_total,
         CAST(l_linenumber AS DOUBLE) AS banks_received, CAST(l_partkey AS DOUBLE) AS paybills_received_others
  FROM lineitem),
income AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY loan_id
        ORDER BY received DESC NULLS LAST, duration DESC, persons_received_from_total DESC,
                 banks_received DESC, paybills_received_others DESC) AS rn FROM income0) WHERE rn = 1)"""


def _check(
    name: str, severity: str, ok: str, expected: str, observed: str, message: str,
    evidence: str = "NULL", sample: str = "''",
) -> str:
    return f"""SELECT '{name}' AS "name", '{severity}' AS severity,
      CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, '{expected}' AS expected,
      {observed} AS observed, {message} AS message,
      CAST({evidence} AS VARCHAR) AS evidence_path, {sample} AS sample_unmatched"""


def _freshness(as_of: str) -> str:
    age = f"date_diff('day', latest, greatest(latest, DATE '{as_of}'))"
    return _check(
        "FRESHNESS", "HIGH", f"{age} <= 100", "latest snapshot <= 100 days old",
        f"'latest=' || latest || ', age_days=' || {age}",
        f"'Latest snapshot is ' || latest || ' (' || {age} || ' days old).'",
    ) + " FROM (SELECT MAX(snapshot_date) AS latest FROM credit)"


UNIQUENESS = _check(
    "UNIQUENESS", "CRITICAL", "dups = 0", "0 duplicate (loan_id, snapshot_date) rows",
    "dups || ' duplicate rows'", "'Found ' || dups || ' duplicate rows on primary key.'",
    "CASE WHEN dups > 0 THEN 'evidence/dq_duplicates' END",
) + """ FROM (SELECT CAST(coalesce(SUM(n), 0) AS BIGINT) AS dups FROM (
     SELECT COUNT(*) AS n FROM copied GROUP BY loan_id, snapshot_date HAVING COUNT(*) > 1))"""


def _integrity(source: str) -> str:
    return _check(
        "REFERENTIAL_INTEGRITY", "HIGH", "share >= 0.95", "coverage >= 95%",
        "'coverage=' || printf('%.3f%%', share * 100)",
        "printf('%.2f%%', share * 100) || ' of credit loan_ids match a customer record.'",
        sample=f"""(SELECT string_agg(CAST(loan_id AS VARCHAR), ',' ORDER BY loan_id) FROM (
            SELECT DISTINCT loan_id FROM {source} WHERE loan_id NOT IN (SELECT loan_id FROM customers)
            ORDER BY loan_id LIMIT 25))""",
    ) + f""" FROM (SELECT AVG(CAST(loan_id IN (SELECT loan_id FROM customers) AS INTEGER)) AS share
              FROM {source})"""


def _optional_range(name: str, column: str, noun: str, plural: str, lo: int, hi: int) -> str:
    return _check(
        name, "MEDIUM", "bad = 0", f"{noun} in [{lo}, {hi}]",
        "bad || ' out-of-range / ' || n || ' non-null'",
        f"bad || ' {plural} outside [{lo},{hi}]. min=' || printf('%.1f', low) || ', max=' || printf('%.1f', high)",
    ) + f""" FROM (SELECT count_if({column} < {lo} OR {column} > {hi}) AS bad, COUNT({column}) AS n,
              MIN({column}) AS low, MAX({column}) AS high FROM feat)"""


RANGE_AGE = _optional_range("RANGE_CUSTOMER_AGE", "customer_age_years", "age", "ages", 18, 100)
RANGE_INCOME = _optional_range("RANGE_INCOME", "avg_monthly_income", "income", "incomes", 0, 10000000)


def _range_dpd(column: str, source: str) -> str:
    return _check(
        "RANGE_DAYS_PAST_DUE", "HIGH", "bad = 0", "days_past_due in [0, 3650]",
        "bad || ' out-of-range / ' || n", "bad || ' DPD values outside [0,3650].'",
    ) + f" FROM (SELECT count_if({column} < 0 OR {column} > 3650) AS bad, COUNT(*) AS n FROM {source})"


def _null_check(shown: str, limit: float, source: str) -> str:
    return _check(
        f"NULL_{shown}", "MEDIUM" if limit else "HIGH", f"share <= {limit}", f"<= {limit:.1%} null",
        "printf('%.3f%%', share * 100) || ' null'",
        f"'`{shown}` is ' || printf('%.2f%%', share * 100) || ' null.'",
    ) + f""" FROM (SELECT AVG(CAST("{shown.lower()}" IS NULL AS INTEGER)) AS share FROM {source})"""


NULL_LIMITS = (
    ("LOAN_ID", 0.0), ("DATE", 0.0), ("SALE_DATE", 0.0), ("ACCOUNT_STATUS_L1", 0.5), ("ACCOUNT_STATUS_L2", 0.5),
)
EXPECTED = (
    "[''loan_id'', ''date'', ''sale_date'', ''account_status_l1'', ''account_status_l2'', "
    "''days_past_due'', ''arrears'', ''balance'', ''closing_balance'']"
)


def _drift(ok: bool) -> str:
    observed = "'all present'" if ok else "'missing: [''arrears'']'"
    message = (
        "'Canonical schema honoured by all snapshots.'" if ok else "'Schema drift detected: arrears'"
    )
    return _check(
        "SCHEMA_DRIFT", "CRITICAL", str(ok).upper(), f"columns present: {EXPECTED}", observed, message
    )


def _all_checks() -> str:
    parts = [
        _freshness("2002-12-31").replace("FROM credit)", "FROM copied)"),
        UNIQUENESS,
        _integrity("copied"),
        RANGE_AGE,
        _range_dpd("days_past_due", "feat"),
        *[_null_check(c, limit, "copied") for c, limit in NULL_LIMITS],
        _drift(True),
        RANGE_INCOME,
    ]
    rows = " UNION ALL ".join(f"SELECT {i + 1} AS position, * FROM ({p})" for i, p in enumerate(parts))
    return f"""WITH {FEATURES},
copied AS (SELECT * FROM credit UNION ALL SELECT * FROM credit WHERE loan_id % 97 = 0),
results AS ({rows})"""


ALL_CHECKS = _all_checks()

PROFILED = {
    "orders": ("orders", [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
        ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]),
    "customer": ("customer", [
        ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
        ("c_acctbal", "double"), ("c_mktsegment", "string")]),
    "events": ("events", [
        ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
        ("event_type", "string"), ("value", "double"), ("props", "string")]),
    "documents": ("documents", [
        ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
        ("n_chars", "bigint")]),
    "nps_customers": ("customers", [
        ("loan_id", "bigint"), ("sale_date", "date"), ("date_of_birth", "date"),
        ("received", "decimal(20,2)"), ("duration", "bigint"), ("gender", "string"),
        ("citizenship", "int")]),
}
NUMERIC = ("bigint", "int", "double", "decimal(20,2)")


def _each_column(part, keep=lambda dtype: True) -> str:
    return " UNION ALL ".join(
        part(name, source, i, column, dtype, len(columns))
        for name, (source, columns) in PROFILED.items()
        for i, (column, dtype) in enumerate(columns)
        if keep(dtype)
    )


def _null_part(name, source, i, column, dtype, width) -> str:
    return f"""SELECT '{name}' AS dataset, {i} AS position, '{column}' AS column_name, '{dtype}' AS dtype,
      COUNT(*) AS row_count, {width} AS column_count, COUNT(*) - COUNT({column}) AS null_count,
      ROUND((COUNT(*) - COUNT({column}))::DOUBLE / COUNT(*) * 100, 3) AS null_pct FROM {source}"""


def _distinct_part(name, source, i, column, dtype, width) -> str:
    return f"""SELECT '{name}' AS dataset, '{column}' AS column_name,
      COUNT(DISTINCT {column}) AS distinct_count FROM {source} HAVING COUNT({column}) > 0"""


def _numeric_part(name, source, i, column, dtype, width) -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{name}' AS dataset, '{column}' AS column_name, ROUND(MIN({v}), 3) AS "min",
      ROUND(MAX({v}), 3) AS "max", ROUND(AVG({v}), 3) AS mean, ROUND(stddev_samp({v}), 3) AS std,
      ROUND(median({v}), 3) AS median FROM {source}"""


def _top_part(name, source, i, column, dtype, width) -> str:
    return f"""SELECT '{name}' AS dataset, '{column}' AS column_name, CAST(rn AS INTEGER) AS position,
      "value", n FROM (
        SELECT "value", COUNT(*) AS n, row_number() OVER (
            ORDER BY COUNT(*) DESC, "value") AS rn
        FROM (SELECT CAST({column} AS VARCHAR) AS "value" FROM {source}) WHERE "value" IS NOT NULL
        GROUP BY "value") WHERE rn <= 5"""


def _exact_part(dataset, source, column, dtype, scale) -> str:
    v = f"CAST({column} AS {dtype})"
    half = f"CAST(CAST(SUM(v) AS DECIMAL(36,{scale})) * CASE WHEN COUNT(*) = 1 THEN 1.0 ELSE 0.5 END AS DECIMAL(38,{scale + 1}))"
    return f"""SELECT '{dataset}' AS dataset, '{column}' AS column_name,
      (SELECT CAST(MIN({v}) AS VARCHAR) FROM {source}) AS "min", (SELECT CAST(MAX({v}) AS VARCHAR) FROM {source}) AS "max",
      CAST({half} AS VARCHAR) AS median
      FROM (SELECT {v} AS v, row_number() OVER (ORDER BY {column}) AS rn, COUNT(*) OVER () AS n FROM {source} WHERE {column} IS NOT NULL)
      WHERE rn IN ((n + 1) // 2, n // 2 + 1)"""


EXACT = [
    ("orders", "orders", "o_orderkey", "BIGINT", 0), ("orders", "orders", "o_custkey", "BIGINT", 0),
    ("large", "large", "big", "BIGINT", 0), ("large", "large", "decimal", "DECIMAL(30,4)", 4), ("large", "large", "price", "DECIMAL(18,2)", 2),
    ("customers", "customers", "loan_id", "BIGINT", 0), ("customers", "customers", "received", "DECIMAL(20,2)", 2),
    ("customers", "customers", "duration", "BIGINT", 0), ("customers", "customers", "citizenship", "INTEGER", 0),
]

# profile of the raw credit export, the events and the customers with odd headers
RAW_COLUMNS = (
    ("LOAN_ID", "CASE WHEN kind <> 2 THEN CAST(loan_id AS VARCHAR) END"),
    (" DATE ", "CAST(snapshot_date AS VARCHAR)"),
    ("SALE_DATE", """CASE WHEN kind = 2 THEN NULL
        WHEN loan_id % 3 = 0 THEN strftime(sale_date, '%-m/%-d/%Y')
        WHEN loan_id % 3 = 1 AND day(sale_date) > 12 THEN strftime(sale_date, '%d-%m-%Y')
        ELSE strftime(sale_date, '%Y-%m-%d') END"""),
    ("Max Payment Date", """CASE WHEN kind <> 2 THEN CAST(
        max_payment_date - CASE WHEN kind = 1 THEN 40 ELSE 0 END AS VARCHAR) END"""),
    ("ACCOUNT_STATUS_L1", "CASE WHEN kind <> 2 THEN account_status_l1 END"),
    ("ACCOUNT_STATUS_L2", "CASE WHEN kind <> 2 THEN account_status_l2 END"),
    ("Days Past Due?", """CASE WHEN kind = 2 THEN NULL WHEN loan_id % 17 = 0 THEN 'n/a'
        ELSE CAST(raw_dpd AS VARCHAR) END"""),
    ("ARREARS", "CASE WHEN kind <> 2 THEN CAST(arrears AS VARCHAR) END"),
    ("BALANCE", "CASE WHEN kind <> 2 THEN CAST(balance + kind AS VARCHAR) END"),
    ("CLOSING_BALANCE", "CASE WHEN kind <> 2 THEN CAST(balance AS VARCHAR) END"),
    ("CUSTOMER_AGE", "CASE WHEN kind <> 2 THEN CAST(date_diff('day', sale_date, snapshot_date) AS VARCHAR) END"),
    ("Unnamed: 28", "CAST(NULL AS VARCHAR)"),
)


def _profile_rows() -> str:
    def part(dataset: str, shown: str, dtype: str, value: str, source: str) -> str:
        return f"""SELECT '{dataset}' AS dataset, '{shown}' AS column_name, '{dtype}' AS dtype,
          COUNT(*) AS row_count, COUNT(DISTINCT {value}) AS distinct_count,
          ROUND((COUNT(*) - COUNT({value}))::DOUBLE / COUNT(*) * 100, 3) AS null_pct,
          ROUND(COUNT(DISTINCT {value})::DOUBLE / COUNT(*) * 100, 3) AS distinct_pct FROM {source}"""

    parts = [part("credit", shown, "string", value, "kinds") for shown, value in RAW_COLUMNS]
    parts += [part("events", c, d, c, "events") for c, d in PROFILED["events"][1]]
    shown = {"gender": "?gender", "citizenship": "citizen�ship"}
    parts += [
        part("nps_survey", shown.get(c, c), d, c, "customers") for c, d in PROFILED["nps_customers"][1]
    ]
    return f"WITH {RAW_CREDIT}, {CUSTOMERS}, profiles AS ({' UNION ALL '.join(parts)})"


PROFILES = _profile_rows()

ORACLES: dict[str, str] = {
    # --- KPIs
    "portfolio_health": f"""WITH {HEALTH}
      SELECT snapshot_date, accounts, ROUND(delinquency_rate, 6) AS delinquency_rate,
             ROUND(par30_rate, 6) AS par30_rate, ROUND(par60_rate, 6) AS par60_rate,
             ROUND(write_off_rate, 6) AS write_off_rate, ROUND(paid_off_rate, 6) AS paid_off_rate,
             ROUND(return_rate, 6) AS return_rate, ROUND(collection_rate, 6) AS collection_rate,
             ROUND(avg_arrears, 6) AS avg_arrears, ROUND(avg_balance, 6) AS avg_balance, portfolio_balance
      FROM health ORDER BY snapshot_date""",
    "kpi_by_age_band": f"""WITH {BY_AGE}
      SELECT snapshot_date, band AS age_band, {BANDED_OUT}, ROUND(avg_arrears, 6) AS avg_arrears
      FROM by_age ORDER BY 1, 2""",
    "kpi_by_income_band": f"""WITH {BY_INCOME}
      SELECT snapshot_date, band AS income_band, {BANDED_OUT} FROM by_income ORDER BY 1, 2""",
    "kpi_by_risk": f"""WITH {BY_RISK}
      SELECT snapshot_date, risk_category, accounts, balance, ROUND(avg_dpd, 6) AS avg_dpd,
             ROUND(avg_arrears, 6) AS avg_arrears
      FROM by_risk ORDER BY snapshot_date, CASE risk_category WHEN 'Critical' THEN 1 WHEN 'High' THEN 2
             WHEN 'Medium' THEN 3 WHEN 'Low' THEN 4 ELSE 5 END""",
    "kpi_trend_long": f"""WITH {HEALTH}
      SELECT snapshot_date, 'Delinquency' AS kpi, ROUND(delinquency_rate * 100, 6) AS "percent" FROM health
      UNION ALL SELECT snapshot_date, 'PAR 30', ROUND(par30_rate * 100, 6) FROM health
      UNION ALL SELECT snapshot_date, 'Write Off', ROUND(write_off_rate * 100, 6) FROM health
      UNION ALL SELECT snapshot_date, 'Paid Off', ROUND(paid_off_rate * 100, 6) FROM health""",
    "pivot_age": f"WITH {BY_AGE} {_pivot('by_age', 'age_band', 'band <> ' + repr('Unknown'))}",
    "pivot_income": f"WITH {BY_INCOME} {_pivot('by_income', 'income_band', 'band <> ' + repr('Unknown'))}",
    "risk_mix_pct": f"""WITH {BY_RISK},
      totals AS (SELECT snapshot_date, SUM(accounts) AS total FROM by_risk GROUP BY 1)
      SELECT snapshot_date,
        ROUND(SUM(CASE WHEN risk_category = 'Critical' THEN accounts ELSE 0 END)::DOUBLE / ANY_VALUE(total) * 100, 6) AS "Critical",
        ROUND(SUM(CASE WHEN risk_category = 'High' THEN accounts ELSE 0 END)::DOUBLE / ANY_VALUE(total) * 100, 6) AS "High",
        ROUND(SUM(CASE WHEN risk_category = 'Medium' THEN accounts ELSE 0 END)::DOUBLE / ANY_VALUE(total) * 100, 6) AS "Medium",
        ROUND(SUM(CASE WHEN risk_category = 'Low' THEN accounts ELSE 0 END)::DOUBLE / ANY_VALUE(total) * 100, 6) AS "Low"
      FROM by_risk JOIN totals USING (snapshot_date) GROUP BY snapshot_date""",
    "risk_mix_custom": f"""WITH {CREDIT_FEATURES}
      SELECT snapshot_date, ROUND(AVG(CAST(days_past_due >= 60 AS DOUBLE)) * 100, 6) AS "Severe",
        ROUND(AVG(CAST(days_past_due < 7 AS DOUBLE)) * 100, 6) AS "Fine",
        ROUND(AVG(CAST(days_past_due >= 7 AND days_past_due < 60 AS DOUBLE)) * 100, 6) AS "Other"
      FROM cfeat GROUP BY snapshot_date""",
    "first_last_kpis": f"""WITH {HEALTH},
      ends AS (SELECT MIN(snapshot_date) AS a, MAX(snapshot_date) AS b FROM health),
      pair AS (SELECT f.*, l.delinquency_rate AS l1, l.par30_rate AS l2, l.write_off_rate AS l3,
                      l.paid_off_rate AS l4, l.collection_rate AS l5
               FROM ends JOIN health f ON f.snapshot_date = a JOIN health l ON l.snapshot_date = b)
      SELECT 'delinquency_rate' AS kpi, ROUND(delinquency_rate, 6) AS first_value, ROUND(l1, 6) AS last_value FROM pair
      UNION ALL SELECT 'par30_rate', ROUND(par30_rate, 6), ROUND(l2, 6) FROM pair
      UNION ALL SELECT 'write_off_rate', ROUND(write_off_rate, 6), ROUND(l3, 6) FROM pair
      UNION ALL SELECT 'paid_off_rate', ROUND(paid_off_rate, 6), ROUND(l4, 6) FROM pair
      UNION ALL SELECT 'collection_rate', ROUND(collection_rate, 6), ROUND(l5, 6) FROM pair""",
    "worst_age_segments": f"""WITH {BY_AGE}
      SELECT band AS age_band, ROUND(AVG(delinquency_rate), 6) AS mean_delinquency FROM by_age
      WHERE band <> 'Unknown' GROUP BY band ORDER BY AVG(delinquency_rate) DESC, band LIMIT 3""",
    "worst_income_segments": f"""WITH {BY_INCOME}
      SELECT band AS income_band, ROUND(AVG(delinquency_rate), 6) AS mean_delinquency FROM by_income
      WHERE band <> 'Unknown' GROUP BY band ORDER BY AVG(delinquency_rate) DESC, band LIMIT 3""",
    "latest_risk_mix": f"""WITH {BY_RISK}
      SELECT snapshot_date, risk_category, accounts, balance, ROUND(avg_dpd, 6) AS avg_dpd,
             ROUND(avg_arrears, 6) AS avg_arrears
      FROM by_risk WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM by_risk)""",
    # --- feature columns
    "age_band_per_loan": f"""WITH {FEATURES}
      SELECT loan_id, snapshot_date, ROUND(customer_age_years, 6) AS customer_age_years, age_band FROM feat""",
    "age_years_bounds": """
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS ref_date,
             CASE WHEN (l_orderkey % 400 - 100) * 365 / 365.25::DOUBLE BETWEEN 0 AND 130
                  THEN ROUND((l_orderkey % 400 - 100) * 365 / 365.25::DOUBLE, 6) END AS age FROM lineitem""",
    "monthly_income_band": f"""WITH {FEATURES.replace('cfeat f LEFT JOIN customers c USING (loan_id)', 'customers c LEFT JOIN (SELECT * FROM cfeat WHERE snapshot_date = DATE ' + repr('2001-12-31') + ') f USING (loan_id)')}
      SELECT customer_loan AS loan_id, ROUND(avg_monthly_income, 6) AS avg_monthly_income,
             income_band AS avg_monthly_income_band FROM feat""",
    "dpd_clean": f"""WITH {CREDIT}
      SELECT loan_id, snapshot_date, CASE WHEN loan_id % 17 = 0 OR loan_id % 19 = 0 THEN CAST(0 AS BIGINT)
             ELSE greatest(raw_dpd, 0) END AS days_past_due FROM credit""",
    "status_flags": f"""WITH {CREDIT_FEATURES}
      SELECT loan_id, snapshot_date, is_write_off, is_returned, is_paid_off, is_delinquent FROM cfeat""",
    "risk_classify": f"""WITH {CREDIT_FEATURES} SELECT loan_id, snapshot_date, risk_category FROM cfeat""",
    "risk_classify_without_status": f"""WITH {CREDIT}
      SELECT loan_id, snapshot_date, greatest(raw_dpd, 0) AS days_past_due,
             CASE WHEN raw_dpd >= 60 THEN 'Critical' WHEN raw_dpd >= 30 THEN 'High'
                  WHEN raw_dpd >= 7 THEN 'Medium' ELSE 'Low' END AS risk_category FROM credit""",
    "feature_coverage": f"""WITH {FEATURES}
      SELECT COUNT(*) AS "rows", {_share('age_band IS NOT NULL')} AS age_band_coverage,
             {_share('income_band IS NOT NULL')} AS income_band_coverage FROM feat""",
    "risk_distribution": f"""WITH {CREDIT_FEATURES}
      SELECT risk_category, COUNT(*) AS "rows" FROM cfeat GROUP BY 1""",
    "nps_bucket": f"WITH {NPS} SELECT submission_id, nps_score, nps_bucket FROM nps",
    # --- text to types
    "mixed_dates": """
      SELECT o_orderkey,
             CASE WHEN o_orderkey % 8 = 7 THEN NULL
                  WHEN o_orderkey % 8 = 1 AND day(o_orderdate) <= 12
                  THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
                  ELSE CAST(o_orderdate AS DATE) END AS parsed_date,
             CAST(CASE o_orderkey % 8 WHEN 7 THEN NULL WHEN 3 THEN 34215 WHEN 5 THEN 50700 ELSE 0 END
                  AS INTEGER) AS second_of_day
      FROM orders""",
    "numeric_coerce": """
      SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_custkey + 0.5::DOUBLE
             WHEN 2 THEN CAST(-o_custkey AS DOUBLE) END AS number FROM orders""",
    "flag_to_boolean": """
      SELECT CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS returned, COUNT(*) AS n
      FROM lineitem GROUP BY 1""",
    "title_case_text": """
      SELECT c_custkey, array_to_string(list_transform(
          regexp_extract_all(lower('o''' || c_name || ' ' || c_mktsegment || '-sur-mer'), '[a-z]+|[^a-z]+'),
          lambda w: upper(w[1]) || w[2:]), '') AS titled
      FROM customer""",
    # --- cleaning
    "clean_credit": f"""WITH {RAW_CREDIT}
      SELECT * EXCLUDE (kind) FROM typed WHERE kind = 0""",
    "credit_quarantine": f"""WITH {RAW_CREDIT}
      SELECT loan_id, snapshot_date, max_payment_date, balance FROM typed WHERE kind = 1""",
    "csv_snapshot_scan": f"""WITH {RAW_CREDIT}
      SELECT * EXCLUDE (kind), CASE WHEN snapshot_date >= DATE '2000-01-01' THEN 'x' END AS extra FROM typed WHERE kind = 0""",
    "late_snapshot_load": f"""WITH {RAW_CREDIT}
      SELECT snapshot_date, CASE kind WHEN 0 THEN 'kept' ELSE 'rejected' END AS outcome, COUNT(*) AS "rows",
             CAST(SUM(CAST(balance AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS balance
      FROM typed WHERE snapshot_date < DATE '2001-12-31' GROUP BY ALL""",
    "sheet_scan": """
      SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, o_orderstatus AS gender, file_format,
             array_to_string(list_transform(regexp_extract_all(lower(o_orderpriority), '[a-z]+|[^a-z]+'),
                 lambda w: upper(w[1]) || w[2:]), '') AS citizenship
      FROM orders, (VALUES ('csv'), ('parquet')) AS f(file_format)""",
    "drop_all_null_rows": """
      SELECT event_type, COUNT(*) AS n, COUNT("value") AS with_value FROM events GROUP BY 1
      UNION ALL SELECT NULL, COUNT("value"), COUNT("value") FROM events""",
    "ri_coverage_null_keys": f"""WITH {CREDIT}, {CUSTOMERS},
      keyed AS (SELECT CASE WHEN loan_id % 13 <> 0 THEN loan_id END AS loan_id FROM credit)
      SELECT COUNT(*) AS total, CAST(count_if(loan_id IN (SELECT loan_id FROM customers)) AS BIGINT) AS matched,
             ROUND(AVG(CAST(coalesce(loan_id IN (SELECT loan_id FROM customers), FALSE) AS INTEGER)), 6) AS coverage FROM keyed""",
    "drop_blank_rows": """
      SELECT o_orderstatus, COUNT(*) AS n, COUNT(o_orderkey) AS keys FROM orders GROUP BY 1""",
    "dedupe_latest": f"WITH {RANKED_LINES} SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1",
    "dedupe_quarantine": f"WITH {RANKED_LINES} SELECT * EXCLUDE (rn) FROM ranked WHERE rn > 1",
    "dedupe_sales": f"WITH {SALES} SELECT * EXCLUDE (return_date) FROM sales",
    "dedupe_dob": f"WITH {DOB} SELECT * FROM dob",
    "dedupe_income": f"WITH {INCOME} SELECT * FROM income",
    "sheet_quarantine": """
      SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, COUNT(*) - 1 AS rejected, sheet
      FROM lineitem, (VALUES ('sales'), ('dob'), ('income')) AS v(sheet)
      GROUP BY l_orderkey, sheet HAVING COUNT(*) > 1""",
    "dedupe_keep_last": """
      SELECT user_id, event_id, event_type, "value" FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "clean_nps": """
      WITH raw AS (
        SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS submission_id,
               CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(l_shipdate AS DATE) AS submitted_at,
               CASE WHEN l_partkey % 29 <> 0 THEN CAST(CAST(l_quantity AS INTEGER) % 12 AS DOUBLE) END AS nps_score,
               CAST(l_suppkey AS VARCHAR) AS any_other_feedback FROM lineitem),
      bucketed AS (
        SELECT *, CASE WHEN nps_score <= 6 THEN 'Detractor' WHEN nps_score <= 8 THEN 'Passive'
                       WHEN nps_score <= 10 THEN 'Promoter' END AS nps_bucket FROM raw)
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY submission_id ORDER BY loan_id DESC, submitted_at DESC,
            nps_score DESC NULLS LAST, any_other_feedback DESC) AS rn FROM bucketed) WHERE rn = 1""",
    "union_aligned": f"""WITH {CREDIT}
      SELECT balance, CASE WHEN snapshot_date >= DATE '1999-12-31' THEN balance END AS closing_balance,
             loan_id, snapshot_date FROM credit""",
    # --- joins and membership
    "customer_master": f"""WITH {SALES}, {DOB}, {INCOME},
      gender AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, o_orderstatus AS gender,
               array_to_string(list_transform(regexp_extract_all(lower(o_orderpriority), '[a-z]+|[^a-z]+'),
                   lambda w: upper(w[1]) || w[2:]), '') AS citizenship
        FROM orders)
      SELECT s.* EXCLUDE (return_date), g.citizenship, g.gender, d.date_of_birth, i.* EXCLUDE (loan_id)
      FROM sales s LEFT JOIN gender g USING (loan_id) LEFT JOIN dob d USING (loan_id)
           LEFT JOIN income i USING (loan_id)""",
    "feature_table": f"""WITH {FEATURES}
      SELECT loan_id, snapshot_date, sale_date, date_of_birth, ROUND(customer_age_years, 6) AS customer_age_years,
             age_band, ROUND(avg_monthly_income, 6) AS avg_monthly_income, income_band AS avg_monthly_income_band,
             days_past_due, arrears, balance, balance AS closing_balance, account_status_l1, account_status_l2,
             risk_category, is_delinquent, is_write_off, is_returned, is_paid_off, "date", total_due_today,
             total_paid, max_payment_date, customer_sale_date, citizenship, gender, duration, received
      FROM feat""",
    "credit_x_nps_asof": f"WITH {ASOF} SELECT * FROM cxn",
    "asof_events": """
      SELECT event_id, user_id, view_id FROM (
        SELECT p.event_id, p.user_id, v.event_id AS view_id,
               row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC NULLS LAST, v.event_id DESC) AS rn
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON v.user_id = p.user_id AND v.ts <= p.ts)
      WHERE rn = 1""",
    "nps_by_dpd_bucket": f"WITH {BY_BUCKET} SELECT dpd_bucket, respondents, {SCORES} FROM by_bucket",
    "nps_by_dpd_matched": f"""WITH {BY_BUCKET}
      SELECT dpd_bucket, respondents, {SCORES} FROM by_bucket WHERE dpd_bucket <> 'no_match'""",
    "nps_spread": f"""WITH {BY_BUCKET},
      two AS (SELECT AVG(CASE WHEN dpd_bucket = '0 (current)' THEN avg_nps END) AS c,
                     AVG(CASE WHEN dpd_bucket IN ('31-60', '61-90', '90+') THEN avg_nps END) AS d FROM by_bucket)
      SELECT ROUND(c, 6) AS current_nps, ROUND(d, 6) AS par30_nps, ROUND(c - d, 6) AS spread FROM two""",
    "nps_by_risk": f"""WITH {ASOF}
      SELECT coalesce(risk_category, 'Unknown') AS risk_category, COUNT(*) AS respondents,
             ROUND({_mean('nps_score')}, 6) AS avg_nps, {_share('nps_score >= 9')} AS promoter_rate,
             {_share('nps_score <= 6')} AS detractor_rate
      FROM cxn WHERE nps_score IS NOT NULL GROUP BY 1""",
    "ri_coverage": f"""WITH {CREDIT}, {CUSTOMERS}
      SELECT COUNT(*) AS total, CAST(count_if(loan_id IN (SELECT loan_id FROM customers)) AS BIGINT) AS matched,
             {_share('loan_id IN (SELECT loan_id FROM customers)')} AS coverage FROM credit""",
    "ri_unmatched": f"""WITH {CREDIT}, {CUSTOMERS}
      SELECT DISTINCT loan_id FROM credit WHERE loan_id NOT IN (SELECT loan_id FROM customers)
      ORDER BY loan_id LIMIT 25""",
    "join_cardinality": """
      SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "canonical_columns": """SELECT 'credit_expiry' AS column_name""",
    # --- profiling
    "profile_columns": f"WITH {CUSTOMERS} {_each_column(_null_part)}",
    "profile_distinct": f"WITH {CUSTOMERS} {_each_column(_distinct_part)}",
    "profile_numeric": f"WITH {CUSTOMERS} {_each_column(_numeric_part, lambda d: d in NUMERIC)}",
    "profile_exact": f"""WITH {CUSTOMERS}, large AS (SELECT o_orderkey + 9007199254740993 AS big,
      CAST(o_custkey AS DECIMAL(30,4)) AS "decimal", CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
      {" UNION ALL ".join(_exact_part(*part) for part in EXACT)}""",
    "profile_top_values": f"WITH {CUSTOMERS} {_each_column(_top_part, lambda d: d not in NUMERIC)}",
    "profile_findings": f"""{PROFILES}
      SELECT 'HIGH' AS severity, dataset, 'join_key_null' AS issue,
             column_name || ' is ' || null_pct || '% NULL - join coverage will be poor' AS detail
      FROM profiles WHERE lower(trim(column_name)) IN ('loan id', 'loan_id') AND null_pct > 5
      UNION ALL SELECT 'MEDIUM', dataset, 'date_as_string', column_name || ' is stored as text - needs parse-and-cast'
      FROM profiles WHERE dtype = 'string' AND (contains(lower(column_name), 'date') OR contains(lower(column_name), 'expiry'))
      UNION ALL SELECT 'MEDIUM', dataset, 'duplicate_ids',
             column_name || ' is only ' || distinct_pct || '% distinct - possible duplicates'
      FROM profiles WHERE ends_with(lower(trim(column_name)), '_id') AND row_count > 100 AND distinct_pct < 95 AND null_pct < 5
      UNION ALL SELECT 'LOW', dataset, 'encoding_artifact',
             'Column header contains unicode replacement char: ''' || column_name || ''''
      FROM profiles WHERE contains(dataset, 'nps') AND (contains(column_name, '�') OR starts_with(column_name, '?'))""",
    "profile_null_hotlist": f"""{PROFILES}
      SELECT dataset, column_name, dtype, null_pct, distinct_count FROM profiles WHERE null_pct >= 1
      ORDER BY dataset, null_pct DESC""",
    # --- quality
    "dq_freshness": f"WITH {CREDIT} {_freshness('2002-03-01')}",
    "dq_freshness_stale": f"WITH {CREDIT} {_freshness('2002-12-31')}",
    "dq_uniqueness": f"WITH {COPIES} {UNIQUENESS}",
    "dq_uniqueness_counts": f"""WITH {COPIES},
      k AS (SELECT COUNT(*) AS n FROM copied GROUP BY loan_id, snapshot_date)
      SELECT CAST(SUM(n) AS BIGINT) AS row_count, CAST(SUM(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_rows,
             CAST(count_if(n > 1) AS BIGINT) AS duplicate_keys FROM k""",
    "dq_uniqueness_evidence": f"""WITH {COPIES}
      SELECT loan_id, snapshot_date, balance FROM copied WHERE loan_id % 97 = 0""",
    "dq_referential_integrity": f"WITH {CREDIT}, {CUSTOMERS} {_integrity('credit')}",
    "dq_range_age": f"WITH {FEATURES} {RANGE_AGE}",
    "dq_range_dpd": f"WITH {CREDIT} {_range_dpd('raw_dpd', 'credit')}",
    "dq_range_income": f"WITH {FEATURES} {RANGE_INCOME}",
    "dq_nulls": f"WITH {HOLEY} " + " UNION ALL ".join(
        _null_check(c, limit, "holey") for c, limit in NULL_LIMITS
    ),
    "dq_schema_drift": _drift(False),
    "dq_all": f"{ALL_CHECKS} SELECT CAST(position AS INTEGER) AS position, * EXCLUDE (position) FROM results",
    "dq_alerts": f"""{ALL_CHECKS},
      routing AS (SELECT * FROM (VALUES ('CRITICAL', 'email'), ('CRITICAL', 'slack'), ('CRITICAL', 'pagerduty'),
                  ('HIGH', 'email'), ('HIGH', 'slack'), ('MEDIUM', 'email')) AS r(severity, channel))
      SELECT channel, severity, 'DQ ' || status || ': ' || "name" AS title, message AS body
      FROM results JOIN routing USING (severity) WHERE status IN ('FAIL', 'WARN')""",
    "dq_failures": f"""{ALL_CHECKS}
      SELECT "name", severity, status, message, evidence_path FROM results WHERE status <> 'PASS'""",
    "dq_gate": f"""{ALL_CHECKS}
      SELECT CAST(count_if(status = 'FAIL') AS BIGINT) AS failed_checks, count_if(status = 'FAIL') > 0 AS gate_failed
      FROM results""",
    # --- monitoring
    "snapshot_row_delta": f"""WITH {CREDIT},
      c AS (SELECT snapshot_date, COUNT(*) AS "rows" FROM credit GROUP BY 1)
      SELECT snapshot_date, "rows", lag("rows") OVER (ORDER BY snapshot_date) AS previous_rows,
             "rows" - lag("rows") OVER (ORDER BY snapshot_date) AS delta FROM c""",
    "null_rate_drift": f"""WITH {HOLEY},
      shares AS (
        SELECT snapshot_date, 'sale_date' AS column_name, AVG(CAST(sale_date IS NULL AS INTEGER)) AS r FROM holey GROUP BY 1
        UNION ALL SELECT snapshot_date, 'account_status_l1', AVG(CAST(account_status_l1 IS NULL AS INTEGER)) FROM holey GROUP BY 1
        UNION ALL SELECT snapshot_date, 'account_status_l2', AVG(CAST(account_status_l2 IS NULL AS INTEGER)) FROM holey GROUP BY 1)
      SELECT snapshot_date, column_name, ROUND(r, 6) AS null_rate,
             ROUND(lag(r) OVER w, 6) AS previous_rate, ROUND(r - lag(r) OVER w, 6) AS drift
      FROM shares WINDOW w AS (PARTITION BY column_name ORDER BY snapshot_date)""",
    # --- sources, sinks, tables
    "table_counts": f"""WITH {CREDIT}, {CUSTOMERS}, {NPS}
      SELECT 'fct_portfolio_snapshot' AS table_name, COUNT(*) AS "rows" FROM credit
      UNION ALL SELECT 'dim_customer', COUNT(*) FROM customers
      UNION ALL SELECT 'fct_sales', COUNT(*) FROM orders
      UNION ALL SELECT 'fct_nps', COUNT(*) FROM nps""",
    "sample_fixed": f"""WITH {CREDIT}
      SELECT snapshot_date, loan_id, balance FROM credit
      ORDER BY md5('42|' || snapshot_date || '|' || loan_id), snapshot_date, loan_id LIMIT 5000""",
    "snapshot_reload": f"""WITH {CREDIT}
      SELECT snapshot_date, COUNT(*) AS "rows", CAST(SUM(
          CASE WHEN snapshot_date = DATE '2001-12-31' THEN balance + 1 ELSE balance END) AS DECIMAL(28,2)) AS balance
      FROM credit GROUP BY 1""",
    "sink_roundtrip": f"""WITH {BY_RISK},
      formats AS (SELECT * FROM (VALUES ('parquet'), ('csv'), ('json')) AS v(file_format))
      SELECT snapshot_date, risk_category, accounts, file_format FROM by_risk, formats""",
    "views_roundtrip": f"""WITH {CREDIT}, {NPS}
      SELECT v AS view_name, (SELECT COUNT(*) FROM credit) AS n
      FROM (VALUES ('v_portfolio_by_age_band'), ('v_portfolio_by_income_band'), ('v_portfolio_by_risk'),
                   ('v_portfolio_health')) AS t(v)
      UNION ALL SELECT 'v_credit_x_nps', (SELECT COUNT(*) FROM nps)""",
    "stored_views": f"""WITH {HEALTH}, {ASOF.split(CREDIT_FEATURES, 1)[1].lstrip().removeprefix(',')},
      matched AS (SELECT snapshot_date, COUNT(*) AS respondents FROM cxn GROUP BY 1),
      bands AS (SELECT snapshot_date, COUNT(DISTINCT coalesce(age_band, 'Unknown')) AS age_bands,
                       COUNT(DISTINCT coalesce(income_band, 'Unknown')) AS income_bands, COUNT(*) AS n FROM feat GROUP BY 1)
      SELECT coalesce(h.snapshot_date, m.snapshot_date) AS snapshot_date, accounts, ROUND(delinquency_rate, 6) AS delinquency_rate,
             ROUND(par30_rate, 6) AS par30_rate, ROUND(par60_rate, 6) AS par60_rate,
             ROUND(write_off_rate, 6) AS write_off_rate, ROUND(paid_off_rate, 6) AS paid_off_rate,
             ROUND(return_rate, 6) AS return_rate, ROUND(collection_rate, 6) AS collection_rate,
             ROUND(avg_arrears, 6) AS avg_arrears, ROUND(avg_balance, 6) AS avg_balance, portfolio_balance,
             respondents, age_bands, income_bands, n AS by_risk
      FROM health h FULL JOIN matched m ON h.snapshot_date = m.snapshot_date LEFT JOIN bands b ON b.snapshot_date = h.snapshot_date""",
    "whole_run": f"""WITH {RAW_CREDIT},
      sheet AS (SELECT COUNT(*) AS n, COUNT(DISTINCT l_orderkey) AS loans, COUNT(DISTINCT l_orderkey * 10 + l_linenumber) AS submissions FROM lineitem)
      SELECT 'raw credit_' || CAST(snapshot_date AS VARCHAR) AS table_name, COUNT(*) AS "rows" FROM kinds GROUP BY snapshot_date
      UNION ALL SELECT 'rejected credit', (SELECT COUNT(*) FROM typed WHERE kind = 1)
      UNION ALL SELECT 'fct_portfolio_snapshot', (SELECT COUNT(*) FROM credit)
      UNION ALL SELECT t, n FROM sheet, (VALUES ('raw sales_sales'), ('raw sales_dob'), ('raw sales_income'), ('raw nps')) AS v(t)
      UNION ALL SELECT t, n - loans FROM sheet, (VALUES ('rejected sales'), ('rejected dob'), ('rejected income')) AS v(t)
      UNION ALL SELECT t, loans FROM sheet, (VALUES ('dim_customer'), ('fct_sales')) AS v(t)
      UNION ALL SELECT 'fct_nps', submissions FROM sheet UNION ALL SELECT 'rejected nps', n - submissions FROM sheet
      UNION ALL SELECT 'raw sales_gender', COUNT(*) FROM orders UNION ALL SELECT 'rejected gender', 0""",
    "audit_rows": f"""WITH {RAW_CREDIT}
      SELECT 'clean_credit' AS step, 'in_rows' AS metric, (SELECT COUNT(*) FROM kinds) AS "value"
      UNION ALL SELECT 'clean_credit', 'out_rows', (SELECT COUNT(*) FROM credit)""",
}
