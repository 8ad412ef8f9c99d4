"""Hand-written DuckDB SQL twins of the registered queries (the oracle).

Same parameters and output names as the Spark builders; written as plain SQL
over the driver's views so the check is independent of the Spark code path.
"""

from __future__ import annotations

from quill.functions.dates import AS_OF
from quill.plans import fixed as FX
from quill.plans import sqlkit as K

ORACLE: dict[str, str] = {}

# written out here, not taken from the builders that they check
PART_TYPE_LABELS = {"ECONOMY": "economy line", "STANDARD": "standard line", "SMALL": "small format",
                    "MEDIUM": "medium format", "LARGE": "large format"}
SEGMENT_LABELS = {"AUTOMOBILE": "automotive", "BUILDING": "construction", "FURNITURE": "furnishing",
                  "MACHINERY": "industrial"}
PAYMENT_LABELS = {1: "cash", 2: "debit card", 3: "credit card"}
CONTRACTS = {"AUTOMOBILE": ("full-time permanent", 900, "0.05"), "BUILDING": ("part-time permanent", 700, None),
             "FURNITURE": ("fixed term", 400, "0.03"), "HOUSEHOLD": ("fee based", 300, "0.02"),
             "MACHINERY": ("seasonal", 250, "0.04")}
MOBILITY = {"full-time permanent": 1500, "part-time permanent": 1200, "fixed term": 600, "fee based": 500}
SALARY_BANDS = [(-1000, "1999.99", "5"), (2000, "5999.99", "10"), (6000, "8999.99", "15")]
COLUMNS = {"region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey",
           "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
           "supplier": "s_suppkey s_name s_nationkey s_acctbal",
           "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
           "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
           "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                       "l_returnflag l_linestatus l_shipdate",
           "events": "event_id ts user_id event_type value props"}
PRIMARY_KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
                "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
                "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}
FOREIGN_KEYS = [("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
                ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"),
                ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
                ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("events", "user_id", "customer", "c_custkey")]
REGION_LABELS = {0: "branch africa", 1: "branch america", 2: "branch asia", 3: "branch europe"}


def _reg(name):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


@_reg("avg_ratio_by_type")
def _avg_ratio_by_type(having_min=80, low=85, high=95):
    ratio = "CAST(round(avg(p_retailprice / p_size), 0) AS BIGINT)"
    return f"""
SELECT p_type AS type_code,
       {K.simple_case('p_type', PART_TYPE_LABELS, 'other')} AS type_label,
       count(*) AS total_items,
       {K.money(K.mean_rounded(f"sum({K.cents('p_retailprice')})", 'count(*)'), in_mask=True)} AS mean_price,
       {K.round_ratio('sum(p_size)', 'count(*)')} AS mean_size,
       {ratio} AS price_per_size,
       CASE WHEN {ratio} < {low} THEN 'economy'
            WHEN {ratio} BETWEEN {low} AND {high} THEN 'medium'
            WHEN {ratio} > {high} THEN 'high' ELSE 'n/a' END AS price_class
FROM part GROUP BY p_type HAVING avg(p_retailprice / p_size) > {having_min}
"""


@_reg("avg_by_category")
def _avg_by_category(min_mean=4400):
    s = f"sum({K.cents('c_acctbal')})"
    return f"""
SELECT {K.simple_case('c_mktsegment', SEGMENT_LABELS, 'undefined')} AS category,
       {K.simple_case('n_regionkey', REGION_LABELS, 'undefined')} AS branch,
       {K.money(K.mean_rounded(s, 'count(c_acctbal)'), in_mask=True)} AS mean_balance
FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY c_mktsegment, n_regionkey
HAVING {s} > {int(round(min_mean * 100))} * count(c_acctbal)
"""


# -- listings ---------------------------------------------------------------
PID = K.national_id("c_custkey", "(c_custkey % 10)")


@_reg("salary_listing")
def _salary_listing(low=650, high=3000):
    return f"""
SELECT {PID} AS national_id, upper(c_name) AS full_name, r_name AS worker_type,
       n_name AS city, {K.money(K.d('c_acctbal'))} AS base_salary
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_acctbal BETWEEN {low} AND {high}
"""


@_reg("invoice_listing")
def _invoice_listing(low=100_000, high=250_000, vat=FX.VAT_RATE):
    net = K.d("o_totalprice")
    tax = K.round0(f"{net} * {vat}")
    total = f"({net} + {tax})"
    code = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
    return f"""
SELECT o_orderkey AS invoice_no, {K.day_de_month('o_orderdate')} AS issued,
       o_custkey AS client_id,
       {K.money(net, in_mask=True)} AS net_amount,
       {K.money(tax, in_mask=True)} AS vat_amount,
       {K.money(total, in_mask=True)} AS total_amount,
       CASE WHEN {total} <= {low} THEN 'low' WHEN {total} <= {high} THEN 'medium'
            ELSE 'high' END AS amount_class,
       {K.simple_case(code, PAYMENT_LABELS, 'cheque')} AS payment_form
FROM orders WHERE {K.in_year('o_orderdate', AS_OF.year - 1)}
"""


@_reg("client_credit")
def _client_credit(state="A"):
    bal = K.d("c_acctbal")
    ident = "replace(c_name, '#', '-')"
    mail = "lower(replace(c_name, '#', '@'))"
    return f"""
WITH c AS (SELECT *, CASE WHEN c_nationkey < 20 THEN 'A' ELSE 'B' END AS state,
                  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 6000 WHEN 'BUILDING' THEN 4000
                       WHEN 'FURNITURE' THEN 8000 WHEN 'MACHINERY' THEN 5000 ELSE 0 END AS credit,
                  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 20000000 + c_custkey END AS phone
           FROM customer)
SELECT {K.mask_id(ident)} AS masked_id, {K.title_case('c_name')} AS client,
       coalesce(CAST(phone AS VARCHAR), 'no phone') AS phone,
       coalesce(CAST(c_nationkey AS VARCHAR), 'no district') AS district, state,
       CASE WHEN {bal} / credit > 0.8 THEN 'critical'
            WHEN {bal} / credit > 0.5 THEN 'regular (' || {K.money(bal, in_mask=True)} || ')'
            ELSE 'good (' || {K.money(f'credit - {bal}', in_mask=True)} || ')' END AS credit_status,
       coalesce({K.mail_domain(mail)}, 'no mail') AS mail_domain
FROM c WHERE state = '{state}' AND credit > 0
"""


@_reg("stock_report")
def _stock_report(word="ring", rate=950, low=10, high=30, offer_min=40):
    price = K.d("p_retailprice")
    return f"""
SELECT p_partkey AS part_id, p_name AS description,
       CASE WHEN {price} IS NULL THEN 'no record' ELSE {K.fixed2(price)} || ' USD' END AS cost_usd,
       CASE WHEN {price} IS NULL THEN 'no record' ELSE {K.money(K.round0(f'{price} * {rate}'))} END AS cost_local,
       p_size AS stock,
       CASE WHEN p_size IS NULL THEN 'no data' WHEN p_size < {low} THEN 'stock very low'
            WHEN p_size >= {low} AND p_size <= {high} THEN 'restock soon' ELSE 'ok' END AS stock_alert,
       CASE WHEN p_size > {offer_min} THEN {K.money(K.round0(f'{price} * 0.9'))}
            ELSE 'n/a' END AS offer_price
FROM part WHERE {K.has_word_starting('p_name', word)} AND p_type = 'ECONOMY'
"""


@_reg("income_bands")
def _income_bands(min_income=-1000, max_income=9000):
    inc = K.d("c_acctbal")
    return f"""
SELECT {PID} AS national_id, c_name AS full_name, {K.money(inc, in_mask=True)} AS income,
       CASE WHEN {inc} > 5000 THEN 'band 1' WHEN {inc} BETWEEN 4000 AND 5000 THEN 'band 2'
            WHEN {inc} BETWEEN 2000 AND 3999.99 THEN 'band 3' WHEN {inc} < 2000 THEN 'band 4'
            ELSE 'unclassified' END AS income_band
FROM customer
WHERE c_acctbal BETWEEN {min_income} AND {max_income} AND c_mktsegment IS NOT NULL
"""


def _part_row_sql(where):
    return f"""
SELECT p_partkey, p_name, p_brand, p_size, {K.d('p_retailprice')} AS p_retailprice
FROM part WHERE {where}
"""


ORACLE["lookup_plain"] = _part_row_sql("p_name = 'hot ring'")
ORACLE["lookup_by_upper"] = _part_row_sql("upper(p_name) = 'HOT RING'")
ORACLE["lookup_upper_layout"] = _part_row_sql("upper(p_name) = 'HOT RING'")


# -- sales (written in the reference's literal shape: real fan-out joins,
#    ROW_NUMBER windows, IN (... INTERSECT ...), correlated EXISTS) -----------
AS_OF_SQL = f"DATE '{AS_OF:%Y-%m-%d}'"


def _cashier_sales(fan_out: bool, segment="BUILDING", min_total=FX.SALES_MIN_TOTAL):
    comm = f"{K.d('l_extendedprice')} * {K.d('l_discount')}"
    if fan_out:
        src = f"""customer JOIN nation ON c_nationkey = n_nationkey
     LEFT JOIN orders ON c_custkey = o_custkey
     LEFT JOIN lineitem ON o_orderkey = l_orderkey"""
        cnt, tot, com = "count(o_orderkey)", f"sum({K.d('o_totalprice')})", f"sum({comm})"
        having = f"sum(coalesce({K.d('o_totalprice')}, 0)) > {min_total}"
    else:
        src = f"""customer JOIN nation ON c_nationkey = n_nationkey
     LEFT JOIN (SELECT o_orderkey, o_custkey, o_totalprice, lc.comm FROM orders
                LEFT JOIN (SELECT l_orderkey, sum({comm}) AS comm FROM lineitem GROUP BY l_orderkey) lc
                ON o_orderkey = lc.l_orderkey) o ON c_custkey = o.o_custkey"""
        cnt, tot, com = "count(o_orderkey)", f"sum({K.d('o_totalprice')})", "sum(comm)"
        having = f"sum(coalesce({K.d('o_totalprice')}, 0)) > {min_total}"
    return f"""
SELECT {PID} AS national_id, {K.title_case('c_name')} AS cashier, c_mktsegment AS worker_type,
       n_name AS city, {cnt} AS ticket_count, {K.money(tot)} AS total_sold,
       {K.money(f'coalesce({com}, 0)')} AS commission_total
FROM {src}
WHERE c_mktsegment = '{segment}'
GROUP BY c_custkey, c_name, c_mktsegment, n_name
HAVING {having}
"""


ORACLE["cashier_sales"] = _cashier_sales(True)
ORACLE["cashier_sales_safe"] = _cashier_sales(False)


@_reg("bonus_tenure")
def _bonus_tenure(urgent="1-URGENT", health="NATION_7", cut=5, valid_days=730):
    STATUS_LABELS = {"F": "finished", "O": "open", "P": "partial"}
    sal = K.d("c_acctbal")
    ten = K.years_between(AS_OF, "f.first_order")
    return f"""
WITH hist AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE CAST(o_orderdate AS DATE) + {valid_days} END AS valid_to
  FROM orders),
open_rows AS (SELECT * FROM hist WHERE valid_to IS NULL OR valid_to > {AS_OF_SQL}),
latest AS (
  SELECT o_custkey, o_orderstatus FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM open_rows) WHERE rn = 1),
deps AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '{urgent}'
         GROUP BY o_custkey),
f AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey)
SELECT {PID} AS national_id, {K.title_case('c_name')} AS worker,
       strftime(f.first_order, '%Y') AS hire_year, {ten} AS tenure_years,
       CAST(coalesce(deps.n, 0) AS BIGINT) AS dependants, n_name AS health_system,
       {K.money(sal)} AS base_salary,
       CASE WHEN upper(n_name) = '{health}'
            THEN {K.money(K.round0(f'{sal} * {FX.HEALTH_BONUS_RATE}'))}
            ELSE '$0' END AS health_bonus,
       {K.money(K.round0(f"{sal} * CASE WHEN {ten} <= {cut} THEN {FX.TENURE_BONUS_RATES[0]} "
                         f"ELSE {FX.TENURE_BONUS_RATES[1]} END"))} AS tenure_bonus,
       r_name AS pension_fund,
       {K.simple_case('latest.o_orderstatus', STATUS_LABELS, 'unknown')} AS status
FROM customer c
JOIN f ON f.o_custkey = c.c_custkey
LEFT JOIN deps ON deps.o_custkey = c.c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN latest ON latest.o_custkey = c.c_custkey
WHERE EXISTS (SELECT 1 FROM open_rows e WHERE e.o_custkey = c.c_custkey)
"""


@_reg("two_sector_advisers")
def _two_sector(a="F", b="O"):
    p = K.d("o_totalprice")
    return f"""
SELECT c_custkey AS adviser_id, c_name AS adviser,
       CAST(sum(CASE WHEN o_orderstatus = '{a}' THEN 1 ELSE 0 END) AS BIGINT) AS count_a,
       {K.money(K.round0(f"sum(CASE WHEN o_orderstatus = '{a}' THEN {p} ELSE 0 END)"))} AS total_a,
       CAST(sum(CASE WHEN o_orderstatus = '{b}' THEN 1 ELSE 0 END) AS BIGINT) AS count_b,
       {K.money(K.round0(f"sum(CASE WHEN o_orderstatus = '{b}' THEN {p} ELSE 0 END)"))} AS total_b,
       CAST(sum(CASE WHEN o_orderstatus IN ('{a}', '{b}') THEN 1 ELSE 0 END) AS BIGINT) AS count_total,
       {K.money(K.round0(f"sum(CASE WHEN o_orderstatus IN ('{a}', '{b}') THEN {p} ELSE 0 END)"))} AS total_fees
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = '{a}'
                    INTERSECT
                    SELECT o_custkey FROM orders WHERE o_orderstatus = '{b}')
GROUP BY c_custkey, c_name
"""


def _fee_summary(month=4):
    p = K.d("o_totalprice")
    return f"""
SELECT c_custkey AS prof_id, c_name AS full_name, c_mktsegment AS profession, n_name AS district,
       count(*) AS fee_count, {K.money(f'sum({p})')} AS fee_total,
       {K.money(K.mean_rounded(f"sum({K.cents('o_totalprice')})", 'count(o_totalprice)'))} AS fee_mean,
       {K.money(f'min({p})')} AS fee_min, {K.money(f'max({p})')} AS fee_max
FROM customer JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 3000) sup ON c_nationkey = sup.s_nationkey
WHERE {K.in_month('o_orderdate', AS_OF.year - 1, month)}
GROUP BY c_custkey, c_name, c_mktsegment, n_name
"""


ORACLE["fee_summary"] = _fee_summary()
ORACLE["ctas_fee_summary"] = _fee_summary()


def _fees_cte(month=3):
    return f"""fees AS (SELECT o_custkey, sum({K.d('o_totalprice')}) AS fee_sum FROM orders
          WHERE {K.in_month('o_orderdate', AS_OF.year - 1, month)} GROUP BY o_custkey)"""


def _raised(sal, threshold=240_000):
    low, high = FX.SALARY_RAISE_RATES
    return K.round0(f"{sal} * CASE WHEN fee_sum < {threshold} THEN {low} ELSE {high} END")


ORACLE["fee_before_after"] = f"""
WITH {_fees_cte()}
SELECT c_custkey AS prof_id, c_custkey AS id_number, {K.money('fee_sum')} AS fee_total,
       {K.money(K.d('c_acctbal'))} AS salary_before,
       {K.money(_raised(K.d('c_acctbal')))} AS salary_after
FROM customer JOIN fees ON c_custkey = o_custkey
"""

ORACLE["update_by_aggregate"] = f"""
WITH {_fees_cte()}
SELECT c_custkey,
       CASE WHEN EXISTS (SELECT 1 FROM fees f2 WHERE f2.o_custkey = c_custkey)
            THEN CAST({_raised(K.d('c_acctbal'))} AS DECIMAL(18,2)) ELSE {K.d('c_acctbal')} END AS salary
FROM customer LEFT JOIN fees ON c_custkey = o_custkey
"""


def _ticket_amount():
    return f"CAST(floor({K.d('o_totalprice')} / 10000) * 10000 AS DECIMAL(18,0))"


ORACLE["keep_last"] = f"""
WITH t AS (SELECT o_custkey, o_orderkey, {_ticket_amount()} AS amount FROM orders),
r AS (SELECT *, dense_rank() OVER (PARTITION BY o_custkey
                                   ORDER BY amount DESC NULLS FIRST) AS dr FROM t)
SELECT o_custkey AS c_custkey, max(amount) AS max_amount,
       max(o_orderkey) FILTER (WHERE dr = 1) AS best_ticket
FROM r GROUP BY o_custkey
"""


def _append_bonus_detail():
    TENURE_BANDS = [(0, 2, "0.02"), (3, 5, "0.04"), (5, 6, "0.07")]
    bands = ", ".join(f"({a}, {b}, CAST({r} AS DECIMAL(5,2)))" for a, b, r in TENURE_BANDS)
    sal = K.d("c_acctbal")
    amt = "mt.max_amount"
    (hi, hr), (mi, mr) = FX.TICKET_BONUS_HIGH, FX.TICKET_BONUS_MID
    bonus = (f"(CASE WHEN {amt} > {hi} THEN {amt} * {hr} "
             f"WHEN {amt} > {mi} AND {amt} <= {hi} THEN {amt} * {mr} ELSE 0 END)")
    return f"""
WITH f AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey),
bands(lo, hi, rate) AS (VALUES {bands}),
t AS (SELECT o_custkey, o_orderkey, {_ticket_amount()} AS amount FROM orders
      WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
r AS (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY amount DESC NULLS FIRST) AS dr FROM t),
mt AS (SELECT o_custkey, max(amount) AS max_amount,
              max(o_orderkey) FILTER (WHERE dr = 1) AS best_ticket FROM r GROUP BY o_custkey),
w AS (SELECT c.*, f.first_order, n_name, r_name, {K.years_between(AS_OF, 'f.first_order')} AS tenure
      FROM customer c JOIN f ON f.o_custkey = c.c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      JOIN (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 3000) sup
        ON c_nationkey = sup.s_nationkey)
SELECT row_number() OVER (ORDER BY w.c_custkey, b.lo) AS num,
       CAST(w.c_custkey AS VARCHAR) || '-' || CAST(w.c_custkey % 10 AS VARCHAR) AS rut,
       {K.title_case('w.c_name')} AS worker_name,
       {K.grouped(sal)} AS base_salary,
       coalesce(CAST(mt.best_ticket AS VARCHAR), 'no info') AS ticket_no,
       n_name AS address, {K.full_name('r_name', 'n_name')} AS health_system,
       coalesce({K.grouped(amt)}, 'no info') AS amount,
       coalesce({K.grouped(K.round0(bonus))}, 'no info') AS ticket_bonus,
       {K.grouped(K.round0(f'{sal} + {bonus}'))} AS sim_ticket,
       {K.grouped(K.round0(f'{sal} * (1 + b.rate)'))} AS sim_tenure
FROM w JOIN bands b ON w.tenure BETWEEN b.lo AND b.hi
LEFT JOIN mt ON mt.o_custkey = w.c_custkey
"""


ORACLE["append_bonus_detail"] = _append_bonus_detail()


# -- views ------------------------------------------------------------------
def _view_raises_sql():
    SCHOOL_BONUS = {0: ("primary", 4), 1: ("secondary", 6), 2: ("technical", 8), 3: ("university", 10)}
    vals = ", ".join(f"({k}, '{v[0]}', {v[1]})" for k, v in SCHOOL_BONUS.items())
    sal = K.d("c_acctbal")
    pct = "CAST(s.pct AS DECIMAL(5,0))"
    return f"""
WITH s(school_key, level, pct) AS (VALUES {vals})
SELECT CAST(c_custkey AS VARCHAR) || '-' || CAST(c_custkey % 10 AS VARCHAR) AS rut,
       {K.title_case('c_name')} AS worker, s.level AS level, s.pct AS pct, {sal} AS salary,
       {K.round0(f'{sal} * ({pct} * {FX.PERCENT})')} AS raise_amount,
       {K.round0(f'{sal} * (1 + {pct} * {FX.PERCENT})')} AS raised_salary,
       count(o_orderkey) AS dependants, n_name AS city, c_mktsegment AS contract_type
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN s ON n_regionkey = s.school_key
LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
GROUP BY c_custkey, c_name, c_acctbal, s.level, s.pct, n_name, c_mktsegment
"""


ORACLE["view_raises"] = _view_raises_sql()
ORACLE["view_readback"] = (f"SELECT rut, worker, level, pct, salary, raise_amount, raised_salary "
                           f"FROM ({_view_raises_sql()})")


def _fines_sql(rebate: bool):
    REBATE_CAREERS = ["AUTOMOBILE", "FURNITURE"]
    price = K.d("p_retailprice")
    # exact seconds; a fine in 1/10,000 of a currency unit per day is integral
    secs = "CAST(datediff('second', o_orderdate, l_shipdate) AS HUGEINT)"
    days = f"CAST({secs} / 86400.0 AS DECIMAL(20,10))"
    fine = f"(CAST({secs} / 86400.0 AS DECIMAL(12,4)) * ({price} * 0.03))"
    careers = ", ".join(f"'{c}'" for c in REBATE_CAREERS)
    extra = ""
    if rebate:
        extra = f""",
       CASE WHEN c_mktsegment IN ({careers}) THEN {FX.FINE_REBATE_PCT} ELSE 0 END AS rebate_pct,
       {K.round0(f"{fine} * (1 - CASE WHEN upper(trim(c_mktsegment)) IN ({careers.upper()}) "
                 f"THEN {FX.FINE_REBATE_PCT} * {FX.PERCENT} ELSE 0 END)")} AS rebated_fine,
       coalesce(c_mktsegment IN ({careers}), false)
         = coalesce(upper(trim(c_mktsegment)) IN ({careers.upper()}), false) AS rebate_consistent"""
    return f"""
SELECT l_orderkey AS loan_id, l_linenumber AS loan_line,
       {K.full_name('c_name', 'c_mktsegment')} AS student, c_mktsegment AS career,
       p_partkey AS book_id, {price} AS book_price, CAST(o_orderdate AS DATE) AS due_date,
       CAST(l_shipdate AS DATE) AS returned_date, {days} AS days_late,
       {K.round0(fine)} AS fine{extra}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
WHERE l_shipdate > o_orderdate AND year(o_orderdate) = {AS_OF.year - 2}
"""


ORACLE["view_fines"] = _fines_sql(True)
ORACLE["view_fines_salted"] = _fines_sql(True)
ORACLE["view_fines_brief"] = _fines_sql(False)
ORACLE["fines_report"] = ("SELECT student, career, loan_id, loan_line, returned_date, days_late, rebated_fine "
                          f"FROM ({_fines_sql(True)})")


@_reg("view_clients")
def _view_clients(status="P", priority="1-URGENT", refund_years=2, free_years=6):
    yrs = K.years_between(AS_OF, "f.first_order")
    n = "count(o.o_orderkey)"
    return f"""
WITH f AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey)
SELECT {PID} AS company_id, c_name AS company_name, '{FX.VAT_TEXT}' AS vat, {yrs} AS years_active,
       {n} AS total_advisories,
       CASE WHEN {yrs} >= {refund_years}
            THEN {K.money(K.round0(f"{K.d('c_acctbal')} * {FX.VAT_REFUND_RATE}"), in_mask=True)} ELSE '$0' END AS vat_refund,
       CASE WHEN {n} >= {FX.MAJOR_CLIENT_MIN} THEN 'major client'
            WHEN {n} BETWEEN 1 AND {FX.MAJOR_CLIENT_MIN - 1} THEN 'frequent client'
            ELSE 'new client' END AS client_type,
       CASE WHEN {yrs} >= {free_years} THEN 'free advisory' WHEN {n} = 0 THEN 'win client'
            ELSE 'no benefit' END AS benefit
FROM customer c LEFT JOIN f ON f.o_custkey = c.c_custkey
LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = '{status}'
                  AND o.o_orderpriority = '{priority}'
GROUP BY c.c_custkey, c.c_name, c.c_acctbal, f.first_order
"""


# -- stock, payroll, product update ------------------------------------------
def _stock_sql(suppliers=(1, 5, 9)):
    sup = ", ".join(str(s) for s in suppliers)
    total = "count(DISTINCT (e.l_orderkey, e.l_linenumber))"
    # a row value of two NULLs is not NULL in DuckDB: count matched keys only
    out = ("count(DISTINCT CASE WHEN p.l_orderkey IS NOT NULL "
           "THEN (p.l_orderkey, p.l_linenumber) END)")
    return f"""
SELECT l.p_partkey AS book_id, l.p_name AS book_name,
       {total} AS total_copies, {out} AS on_loan, {total} - {out} AS available,
       {K.round_ratio(f'{out} * 100', total)} AS loan_pct,
       CASE WHEN {total} - {out} > 2 THEN 'S' ELSE 'N' END AS enough_stock
FROM part l
JOIN lineitem e ON l.p_partkey = e.l_partkey
LEFT JOIN lineitem p ON p.l_orderkey = e.l_orderkey AND p.l_linenumber = e.l_linenumber
      AND year(p.l_shipdate) = {AS_OF.year - 2} AND p.l_suppkey IN ({sup})
GROUP BY l.p_partkey, l.p_name
"""


ORACLE["stock_control"] = _stock_sql()
ORACLE["ctas_stock"] = _stock_sql()


def _payroll_sql():
    cvals = ", ".join(
        f"('{k}', '{v[0]}', {v[1]}, {('CAST(' + v[2] + ' AS DECIMAL(4,2))') if v[2] else 'CAST(NULL AS DECIMAL(4,2))'})"
        for k, v in CONTRACTS.items())
    bvals = ", ".join(f"(CAST({a} AS DECIMAL(18,2)), CAST({b} AS DECIMAL(18,2)), CAST({r} AS DECIMAL(5,2)))"
                      for a, b, r in SALARY_BANDS)
    sal = K.d("c_acctbal")
    comm = "coalesce(t.commission, 0)"
    pct = f"(b.rate * {FX.PERCENT})"
    arms = " ".join(f"WHEN t.contract = '{k}' THEN {v}" for k, v in MOBILITY.items())
    bonus = f"(CASE {arms} ELSE t.incentive END)"
    return f"""
WITH t(seg, contract, incentive, commission) AS (VALUES {cvals}),
b(lo, hi, rate) AS (VALUES {bvals})
SELECT c_custkey AS prof_rut, c_name AS prof_name, c_mktsegment AS profession,
       n_name AS health_plan, {sal} AS base_salary,
       CAST(t.commission * 100 AS DECIMAL(6,2)) AS commission_pct,
       {K.round0(f'{sal} * {comm}')} AS commission_value,
       {K.round0(f'{sal} * {pct}')} AS fee_value,
       CAST({bonus} AS INTEGER) AS mobility_bonus,
       {K.round0(f'{sal} + {sal} * {comm} + {sal} * {pct} + {bonus}')} AS total_pay
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN t ON c_mktsegment = t.seg
JOIN b ON {sal} BETWEEN b.lo AND b.hi
"""


ORACLE["payroll"] = _payroll_sql()
ORACLE["reload_payroll"] = _payroll_sql()

ORACLE["update_literal"] = """
SELECT p_partkey, p_name, p_brand,
       CAST(CASE WHEN p_partkey >= 101 AND p_partkey <= 999 THEN 1000
                 WHEN p_partkey <= 99 THEN 100 END AS BIGINT) AS related_part
FROM part
"""


# -- building blocks ----------------------------------------------------------
ORACLE["scan_project"] = f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS part_id,
       {K.d('l_quantity')} AS quantity, {K.d('l_extendedprice')} AS amount,
       CAST(l_shipdate AS DATE) AS ship_day
FROM lineitem
"""

ORACLE["lenient_cast_load"] = f"""
WITH t AS (
  SELECT o_orderkey,
         CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d%m%Y')
                             WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
                             ELSE strftime(o_orderdate, '%d-%m-%Y') END AS date_text,
         CASE WHEN o_orderkey % 7 = 0 THEN 'n/a'
              ELSE CAST({K.d('o_totalprice')} AS VARCHAR) END AS amount_text
  FROM orders),
p AS (SELECT *, CAST(try_strptime(regexp_replace(date_text, '[^0-9]', '', 'g'), '%d%m%Y') AS DATE)
                AS parsed_date FROM t)
SELECT o_orderkey, date_text, parsed_date, amount_text,
       TRY_CAST(trim(amount_text) AS DECIMAL(18,2)) AS amount,
       make_date({AS_OF.year - 1}, month(parsed_date), 1) AS rerun_date
FROM p
"""

ORACLE["assign_keys"] = """
SELECT row_number() OVER (ORDER BY o_orderkey) + 79 AS key, o_orderkey, o_custkey FROM orders
"""


def _band_join_value_sql():
    VALUE_BANDS = [("-1000", "0", "1"), ("0", "5000", "2"), ("5000", "8000", "3"), ("9000", "10000", "4")]
    vals = ", ".join(f"(CAST({a} AS DECIMAL(18,2)), CAST({b} AS DECIMAL(18,2)), CAST({r} AS DECIMAL(5,2)))"
                     for a, b, r in VALUE_BANDS)
    return f"""
WITH b(lo, hi, rate) AS (VALUES {vals})
SELECT c_custkey, {K.d('c_acctbal')} AS balance, b.lo, b.hi, b.rate AS band
FROM customer JOIN b ON {K.d('c_acctbal')} BETWEEN b.lo AND b.hi
"""


def _band_join_tenure_sql():
    YEAR_BANDS = [(0, 1, "0.01"), (2, 3, "0.03"), (3, 5, "0.05")]
    vals = ", ".join(f"({a}, {b}, CAST({r} AS DECIMAL(5,2)))" for a, b, r in YEAR_BANDS)
    ten = K.years_between(AS_OF, "o_orderdate")
    return f"""
WITH b(lo, hi, rate) AS (VALUES {vals})
SELECT o_orderkey, {ten} AS tenure, b.lo, b.hi, b.rate
FROM orders JOIN b ON {ten} BETWEEN b.lo AND b.hi
"""


ORACLE["band_join_value"] = _band_join_value_sql()
ORACLE["band_join_shuffled"] = _band_join_value_sql()
ORACLE["band_join_tenure"] = _band_join_tenure_sql()

ORACLE["semi_exists"] = f"""
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
              AND {K.in_month('o.o_orderdate', AS_OF.year - 1, 3)})
"""

ORACLE["intersect_keys"] = """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
INTERSECT
SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'
"""

ORACLE["latest_status"] = f"""
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
  WHERE o_orderstatus = 'O' OR CAST(o_orderdate AS DATE) + 730 > {AS_OF_SQL})
WHERE rn = 1
"""


def _audit_pk_sql():
    parts = []
    for t in COLUMNS:
        ks = PRIMARY_KEYS[t]
        key_text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in ks)
        has_null = " OR ".join(f"{k} IS NULL" for k in ks)
        parts.append(f"""SELECT '{t}' AS table_name,
       CASE WHEN {has_null} THEN 'pk_null' ELSE 'pk_duplicate' END AS rule,
       '{','.join(ks)}' AS column_name, {key_text} AS key_value, count(*) AS n
FROM {t} GROUP BY {', '.join(ks)} HAVING count(*) > 1 OR {has_null}""")
    return "\nUNION ALL\n".join(parts)


def _audit_fk_sql():
    parts = []
    for ct, cc, pt, pc in FOREIGN_KEYS:
        parts.append(f"""SELECT '{ct}' AS table_name, 'fk_orphan' AS rule, '{cc}' AS column_name,
       count({cc}) AS checked,
       count(*) FILTER (WHERE {cc} IS NOT NULL
                        AND {cc} NOT IN (SELECT {pc} FROM {pt} WHERE {pc} IS NOT NULL)) AS n
FROM {ct}""")
    return "\nUNION ALL\n".join(parts)


def _audit_not_null_sql():
    parts = []
    for t in COLUMNS:
        for c in COLUMNS[t].split():
            parts.append(f"SELECT '{t}' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
                         f"CAST(NULL AS VARCHAR) AS key_value, count(*) FILTER (WHERE {c} IS NULL) AS n "
                         f"FROM {t}")
    for c in ("parsed_date", "amount"):
        parts.append(f"SELECT 'loaded_orders' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
                     f"CAST(NULL AS VARCHAR) AS key_value, count(*) FILTER (WHERE {c} IS NULL) AS n "
                     f"FROM ({ORACLE['lenient_cast_load']})")
    return "\nUNION ALL\n".join(parts)


def _audit_check_sql():
    rules = {
        "customer": [("segment_domain", "c_mktsegment",
                      "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
                     ("balance_non_negative", "c_acctbal", "c_acctbal >= 0"),
                     ("name_length_25", "c_name", "length(c_name) <= 25")],
        "orders": [("status_domain", "o_orderstatus", "o_orderstatus IN ('F', 'O', 'P')"),
                   ("price_precision_8_2", "o_totalprice", "abs(o_totalprice) < 1000000")],
        "lineitem": [("returnflag_domain", "l_returnflag", "l_returnflag IN ('A', 'N', 'R')"),
                     ("linestatus_domain", "l_linestatus", "l_linestatus IN ('O', 'F')"),
                     ("discount_range", "l_discount", "l_discount BETWEEN 0 AND 0.1"),
                     ("quantity_positive", "l_quantity", "l_quantity > 0")],
        "part": [("size_range", "p_size", "p_size BETWEEN 1 AND 50")],
    }
    parts = []
    for t, rs in rules.items():
        ks = PRIMARY_KEYS[t]
        key_text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in ks)
        for r, c, ok in rs:
            parts.append(f"SELECT '{t}' AS table_name, '{r}' AS rule, '{c}' AS column_name, "
                         f"{key_text} AS key_value, CAST(1 AS BIGINT) AS n FROM {t} "
                         f"WHERE NOT coalesce({ok}, true)")
    return "\nUNION ALL\n".join(parts)


ORACLE["audit_pk"] = _audit_pk_sql()
ORACLE["audit_fk"] = _audit_fk_sql()
ORACLE["audit_not_null"] = _audit_not_null_sql()
ORACLE["audit_check"] = _audit_check_sql()

ORACLE["layout_year_pruned"] = f"""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders WHERE year(o_orderdate) = {AS_OF.year - 1}
"""

ORACLE["layout_join_key"] = f"""
SELECT c_custkey, count(*) AS orders, sum({K.d('o_totalprice')}) AS total
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
"""

ORACLE["layout_two_columns"] = f"""
SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber FROM lineitem
WHERE l_partkey = 77 AND year(l_shipdate) = {AS_OF.year - 2}
"""


# -- intervals from the data -------------------------------------------------
@_reg("interval_join_status")
def _interval_join_status():
    return """
WITH p AS (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS valid_from,
                  lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS nxt
           FROM orders)
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day, p.o_orderkey AS status_order,
       p.o_orderstatus AS status, p.valid_from
FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
JOIN p ON p.o_custkey = o.o_custkey AND CAST(l_shipdate AS DATE) >= p.valid_from
      AND (p.nxt IS NULL OR CAST(l_shipdate AS DATE) < p.nxt)
"""


_SPANS = f"""SELECT p_brand, p_size, min({K.d('p_retailprice')}) AS lo, max({K.d('p_retailprice')}) AS hi
           FROM part GROUP BY p_brand, p_size"""


@_reg("interval_join_prices")
def _interval_join_prices():
    return f"""
WITH s AS ({_SPANS})
SELECT c_custkey, {K.d('c_acctbal')} AS balance, count(*) AS n_spans, min(hi - lo) AS narrowest
FROM customer JOIN s ON {K.d('c_acctbal')} BETWEEN lo AND hi GROUP BY ALL
"""


def _audit_intervals(rows: str, on: str, gap: str) -> str:
    part, cols = (f"PARTITION BY {on} ", f"{on}, ") if on else ("", "")
    return f"""
WITH i AS ({rows}),
u AS (SELECT {cols}lo, hi, count(*) AS n FROM i GROUP BY ALL),
w AS (SELECT *, max(hi) OVER ({part}ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM u)
SELECT {cols}lo, hi, n, coalesce(prev, hi) AS prev_hi,
       CASE WHEN n > 1 OR lo <= prev THEN 'overlap' ELSE 'gap' END AS issue
FROM w WHERE n > 1 OR lo <= prev OR {gap}
"""


@_reg("interval_audit_deliveries")
def _interval_audit_deliveries():
    return _audit_intervals("""SELECT o_custkey, min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey""",
                            "o_custkey", "lo - prev > 1")


@_reg("interval_audit_prices")
def _interval_audit_prices():
    return _audit_intervals(_SPANS, "", "lo > prev + CAST(0.01 AS DECIMAL(18,2))")


# the same updates on tables cut into key ranges
ORACLE["update_literal_ranged"] = ORACLE["update_literal"]
ORACLE["update_by_aggregate_ranged"] = ORACLE["update_by_aggregate"]
ORACLE["stock_report_layout"] = ORACLE["stock_report"]


@_reg("csv_load")
def _csv_load():
    date = """CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d%m%Y') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
               ELSE strftime(o_orderdate, '%d-%m-%Y') END"""
    amount = f"CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST({K.d('o_totalprice')} AS VARCHAR) END"
    return f"""
WITH l AS (SELECT *, concat_ws(';', CAST(o_orderkey AS VARCHAR),
                    CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END, o_orderstatus, {amount}) AS head,
                  {date} AS day,
                  o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 AS torn FROM orders),
r AS (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN head WHEN o_orderkey % 13 = 0 THEN head || ';' || day || ';extra'
                     ELSE head || ';' || day END AS text,
             CASE WHEN torn THEN 'fields'
                  ELSE concat_ws(', ', CASE WHEN o_orderkey % 17 = 0 THEN 'o_custkey: missing' END,
                                 CASE WHEN o_orderkey % 7 = 0 THEN 'o_totalprice: not decimal(18,2)' END) END AS reasons FROM l)
SELECT CASE WHEN reasons = '' THEN o_orderkey END AS o_orderkey, CASE WHEN reasons = '' THEN o_custkey END AS o_custkey,
       CASE WHEN reasons = '' THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN reasons = '' THEN {K.d('o_totalprice')} END AS o_totalprice,
       CASE WHEN reasons = '' THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
       CASE WHEN reasons <> '' THEN text END AS line, reasons
FROM r
"""


@_reg("audit_fk_keys")
def _audit_fk_keys():
    refs = [(t, c, c, pt, pk) for t, c, pt, pk in FOREIGN_KEYS]
    refs += [("events", "value", "CAST(floor(value) AS BIGINT)", "orders", "o_orderkey"),
             ("part", "p_size", "p_size", "nation", "n_nationkey")]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'fk_orphan' AS rule, '{c}' AS column_name, CAST({e} AS VARCHAR) AS key_value, "
        f"count(*) AS n FROM {t} WHERE {e} IS NOT NULL AND {e} NOT IN (SELECT {pk} FROM {pt}) GROUP BY {e}"
        for t, c, e, pt, pk in refs)


@_reg("audit_on_write")
def _audit_on_write():
    columns = {t: COLUMNS[t] for t in ("customer", "orders", "lineitem", "part")}
    checks = [("customer", "segment_domain", "c_mktsegment",
               "c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"),
              ("customer", "balance_non_negative", "c_acctbal", "c_acctbal < 0"),
              ("customer", "name_length_25", "c_name", "length(c_name) > 25"),
              ("orders", "status_domain", "o_orderstatus", "o_orderstatus NOT IN ('F', 'O', 'P')"),
              ("orders", "price_precision_8_2", "o_totalprice", "abs(o_totalprice) >= 1000000"),
              ("lineitem", "returnflag_domain", "l_returnflag", "l_returnflag NOT IN ('A', 'N', 'R')"),
              ("lineitem", "linestatus_domain", "l_linestatus", "l_linestatus NOT IN ('O', 'F')"),
              ("lineitem", "discount_range", "l_discount", "l_discount < 0 OR l_discount > 0.1"),
              ("lineitem", "quantity_positive", "l_quantity", "l_quantity <= 0"),
              ("part", "size_range", "p_size", "p_size < 1 OR p_size > 50")]
    checks = [(t, "not_null", c, f"{c} IS NULL") for t, own in columns.items() for c in own.split()] + checks
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{r}' AS rule, '{c}' AS column_name, "
                              f"count(*) FILTER (WHERE {bad}) AS n FROM {t}" for t, r, c, bad in checks)


ORACLE["status_at_run_date"] = ORACLE["latest_status"]

ORACLE["approx_distinct"] = f"""
SELECT p_brand, count(DISTINCT o_custkey) AS customers, false AS off
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE year(l_shipdate) >= {AS_OF.year - 4} GROUP BY p_brand
"""

ORACLE["calendar_pruned"] = f"""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS o_year,
       CAST({AS_OF.year} - year(o_orderdate) AS INTEGER) AS years_ago
FROM orders WHERE {AS_OF.year} - year(o_orderdate) BETWEEN 1 AND 2
"""

ORACLE["append_sparse_keys"] = """
SELECT o_orderstatus AS status, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, true AS from_start, true AS on_step,
       CASE WHEN o_orderstatus <> 'F' THEN true END AS above_first
FROM orders GROUP BY o_orderstatus
"""


@_reg("audit_dependence")
def _audit_dependence():
    wanted = [("customer", COLUMNS["customer"], ["c_custkey", "c_nationkey", "c_mktsegment"]),
              ("part", COLUMNS["part"], ["p_partkey", "p_name", "p_type"]), ("orders", COLUMNS["orders"], ["o_custkey"]),
              ("lineitem", "l_orderkey l_linenumber l_suppkey l_returnflag l_linestatus", ["l_orderkey", "l_returnflag"])]
    parts = [f"""SELECT '{t}' AS table_name, '{k}' AS key_column, '{c}' AS column_name, count(*) AS groups,
       count(*) FILTER (WHERE n > 1) AS n
FROM (SELECT {k}, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n FROM {t} GROUP BY {k})"""
             for t, cols, keys in wanted for k in keys for c in cols.split() if c != k]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n > 0"
