"""ANSI SQL for the registered queries, straight on the test tables.

Written from the rules of ``FIXTURES.md`` and the event definitions, not from the plans: contract
terms are computed from the order columns without any text, schedules come from month counts, and
contract states are stepped event by event in a recursive query.
"""

from __future__ import annotations

from cashloom.plans.testdata import BEFORE_ALL, MIDWAY, SHIFTS

CONTRACTS = """
contracts AS (
  SELECT o_orderkey AS k,
    'CT' || o_orderkey AS contract_id,
    CASE WHEN o_orderstatus = 'P' THEN 'RPL' ELSE 'RPA' END AS role,
    CASE WHEN o_orderstatus = 'P' THEN -1e0 ELSE 1e0 END AS sgn,
    o_orderdate::DATE AS ied,
    (o_orderdate::DATE + to_months((12 + 6 * (o_orderkey % 9))::INT))::DATE AS md,
    o_totalprice AS notional,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 1 WHEN '2' THEN 3 WHEN '3' THEN 6 WHEN '4' THEN 12 END AS ip_months,
    CASE left(o_orderpriority, 1) WHEN '1' THEN '1M-' WHEN '2' THEN '1Q-' WHEN '3' THEN '6M-' WHEN '4' THEN '1Y-' END
      AS ip_cycle,
    (10 + 5 * (o_orderkey % 8)) / 1000e0 AS rate,
    (o_orderkey % 4) AS dc,
    CASE o_orderkey % 4 WHEN 0 THEN 'A/365' WHEN 1 THEN 'A/360' WHEN 2 THEN '30E/360' ELSE 'A/A ISDA' END AS day_count,
    CASE o_orderkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'CHF' END AS currency,
    CASE WHEN o_orderkey % 10 = 0 THEN -100e0 ELSE 0e0 END AS premium,
    CASE WHEN o_orderkey % 11 = 0 THEN (o_orderdate::DATE + to_months(5))::DATE END AS prd,
    CASE WHEN o_orderkey % 11 = 0 THEN 0.99::DOUBLE * o_totalprice END AS pprd,
    CASE WHEN o_orderkey % 13 = 0 THEN (o_orderdate::DATE + to_months(9))::DATE END AS td,
    CASE WHEN o_orderkey % 13 = 0 THEN 1.01::DOUBLE * o_totalprice END AS ptd,
    CASE WHEN o_orderkey % 17 = 0 THEN 'MISSING' WHEN o_orderkey % 6 = 1 THEN 'CRV_' || (o_orderkey % 5)
         WHEN o_orderkey % 2 = 1 THEN 'REF_' || (o_orderkey % 5) END AS reset_code,
    5 * (o_orderkey % 3) / 1000e0 AS spread,
    CASE WHEN o_orderkey % 4 = 1 THEN 0.03::DOUBLE END AS next_rate,
    CASE WHEN o_orderkey % 7 = 0 THEN 'IDX_' || (o_orderkey % 5) END AS scaling_code,
    CASE WHEN o_orderkey % 7 = 0 THEN 100e0 END AS scaling_index,
    o_custkey AS custkey
  FROM orders
)"""

MARKET = """
totals AS (
  SELECT n_regionkey AS r, date_trunc('month', l_shipdate)::DATE AS m, count(*) AS n,
    sum(round(l_discount * 100)::BIGINT) AS d, sum(l_quantity::BIGINT) AS q, sum(round(l_tax * 100)::BIGINT) AS t
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL
),
averages AS (
  SELECT r, m, ((2 * d * 10000 + n) // (2 * n))::BIGINT AS d, ((2 * q * 1000000 + n) // (2 * n))::BIGINT AS q,
    ((2 * t * 10000 + n) // (2 * n))::BIGINT AS t
  FROM totals
),
series AS (
  SELECT 'REF_' || r AS code, 'ReferenceRate' AS kind, m, d / 1000000e0 AS v FROM averages
  UNION ALL SELECT 'IDX_' || r, 'ReferenceIndex', m, (q + 100000000) / 1000000e0 FROM averages
  UNION ALL SELECT 'FX_' || r, 'ForeignExchangeRate', m, (t + 1000000) / 1000000e0 FROM averages
),
tenors(pos, tenor, years) AS (
  VALUES (0, '1M', 1 / 12e0), (1, '3M', 3 / 12e0), (2, '6M', 6 / 12e0), (3, '1Y', 1e0), (4, '2Y', 2e0),
         (5, '5Y', 5e0), (6, '10Y', 10e0)
),
curves AS (
  SELECT 'CRV_' || r_regionkey AS code, 'TermStructure' AS kind, pos, tenor, years,
    (5 + r_regionkey + 2 * pos) / 1000e0 AS v
  FROM region, tenors
),
objects AS (
  SELECT code, kind, count(*) AS n FROM series GROUP BY ALL
  UNION ALL SELECT code, kind, count(*) FROM curves GROUP BY ALL
)"""


def money(value: str) -> str:
    return half_up(value, 4)


def half_up(value: str, digits: int) -> str:
    scale = f"1e{digits}"
    return f"(floor(({value}) * {scale} + 0.50001e0) / {scale})"


def years(a: str, b: str, convention: str) -> str:
    """Year fraction; ``convention`` is 0 to 3 in the order of the contract rule."""

    def gone(d: str) -> str:
        return f"((dayofyear({d}) - 1) / dayofyear(make_date(year({d}), 12, 31))::DOUBLE)"

    thirty = (
        f"((year({b}) - year({a})) * 360 + (month({b}) - month({a})) * 30"
        f" + least(day({b}), 30) - least(day({a}), 30)) / 360e0"
    )
    return (
        f"(CASE {convention} WHEN 0 THEN date_diff('day', {a}, {b}) / 365e0"
        f" WHEN 1 THEN date_diff('day', {a}, {b}) / 360e0 WHEN 2 THEN {thirty}"
        f" ELSE (year({b}) - year({a})) + ({gone(b)} - {gone(a)}) END)"
    )


def interest_dates(condition: str) -> str:
    """Interest dates of every contract, the maturity always among them."""
    return f"""
    SELECT k, d FROM (
      SELECT c.*, (ied + to_months(((j + 1) * ip_months)::INT))::DATE AS plain,
        ((ied + to_months(ip_months::INT))::DATE + to_months((j * ip_months)::INT))::DATE AS d
      FROM contracts c, range(0, 61) AS g(j) WHERE ip_months IS NOT NULL
    ) WHERE d > ied AND d < md AND {condition}
    UNION ALL SELECT k, md AS d FROM contracts WHERE {condition.replace(' d ', ' md ')}"""


def schedule(t0: str, full: bool, resets_only: str = "true") -> str:
    """CTEs up to ``steps``: events in order with the rate a reset observes or fixes."""
    term = "td" if full else "NULL::DATE"
    resets = f"""
    SELECT k, d, 4 AS seq FROM (
      SELECT c.*, ((ied + to_months(6))::DATE + to_months((6 * j)::INT))::DATE AS d
      FROM contracts c, range(0, 12) AS g(j) WHERE reset_code IS NOT NULL AND {resets_only}
    ) WHERE d > ied AND d < md""" if full else "SELECT NULL::BIGINT AS k, NULL::DATE AS d, 4 AS seq WHERE false"
    return f"""
terms AS (
  SELECT *, CASE WHEN {term} < md THEN {term} END AS stop, {'prd' if full else 'NULL::DATE'} AS bought FROM contracts
),
paydays AS MATERIALIZED ({interest_dates("1 = 1")}),
planned AS (
  SELECT k, ied AS d, 1 AS seq FROM contracts
  UNION ALL SELECT k, d, 2 FROM paydays
  UNION ALL {resets}
  UNION ALL SELECT k, bought, 5 FROM terms WHERE bought <= coalesce(stop, md)
  UNION ALL SELECT k, stop, 6 FROM terms WHERE stop IS NOT NULL
  UNION ALL SELECT k, md, 7 FROM contracts
),
ahead AS (
  SELECT p.k, p.d, p.seq,
    row_number() OVER (PARTITION BY p.k, p.seq ORDER BY p.d) AS nth
  FROM planned p JOIN terms t ON p.k = t.k
  WHERE p.d > DATE '{t0}' AND (stop IS NULL OR p.d < stop OR (p.d = stop AND p.seq <= 6))
),
named AS (
  SELECT a.k, d, CASE WHEN seq = 4 AND nth = 1 AND next_rate IS NOT NULL THEN 3 ELSE seq END AS seq
  FROM ahead a JOIN contracts c ON a.k = c.k
)"""


def shifts(scenarios: bool) -> str:
    """CTE ``shifts``: what every scenario adds to the rates."""
    rows = SHIFTS if scenarios else {"base": 0.0}
    return "shifts(scenario, shift) AS (VALUES " + ", ".join(f"('{n}', {s}::DOUBLE)" for n, s in rows.items()) + ")"


def observed(scenarios: bool) -> str:
    """CTE ``obs``: the market rate of every reset, by scenario."""
    return f"""
{shifts(scenarios)},
probes AS (
  SELECT n.k, n.d, c.reset_code, c.spread, x.scenario, x.shift
  FROM named n JOIN contracts c ON n.k = c.k, shifts x WHERE n.seq = 4
),
obs AS MATERIALIZED (
  SELECT p.k, p.d, p.scenario, 1.0::DOUBLE * (coalesce(s.v, c.v) + p.shift) + p.spread AS seen
  FROM probes p
  ASOF LEFT JOIN (SELECT * FROM series WHERE kind = 'ReferenceRate') s ON p.reset_code = s.code AND p.d >= s.m
  LEFT JOIN (SELECT * FROM curves WHERE tenor = '6M') c ON p.reset_code = c.code
)"""


UNOBSERVED = f"""
{shifts(False)},
obs AS (SELECT NULL::BIGINT AS k, NULL::DATE AS d, 'base' AS scenario, NULL::DOUBLE AS seen WHERE false)"""


def states(
    t0: str, full: bool, market: bool, scenarios: bool = False, contracts: str = CONTRACTS, resets_only: str = "true"
) -> str:
    """CTEs up to ``events``: every event with value, nominal, accrued and rate after it."""
    parts = [contracts] + ([MARKET] if market else []) + [schedule(t0, full, resets_only)]
    parts.append(observed(scenarios) if market else UNOBSERVED)
    premium = "premium" if full else "0e0"
    step = f"""
steps AS MATERIALIZED (
  SELECT x.scenario, n.k, n.d, n.seq,
    CASE n.seq WHEN 3 THEN c.next_rate WHEN 4 THEN o.seen END AS set_rate,
    row_number() OVER (PARTITION BY x.scenario, n.k ORDER BY n.d, n.seq) AS i
  FROM named n CROSS JOIN shifts x JOIN contracts c ON n.k = c.k
  LEFT JOIN obs o ON n.seq = 4 AND o.k = n.k AND o.d = n.d AND o.scenario = x.scenario
),
opening AS (
  SELECT x.scenario, t.k, 0::BIGINT AS i,
    coalesce((SELECT max(p.d) FROM paydays p WHERE p.k = t.k AND p.d <= DATE '{t0}'), t.ied) AS d
  FROM terms t CROSS JOIN shifts x
),
run AS (
  SELECT o.scenario, o.k, o.i, o.d, 0 AS seq, c.rate AS r, 0e0 AS due, 0e0 AS acc
  FROM opening o JOIN contracts c ON o.k = c.k
  UNION ALL
  SELECT s.scenario, s.k, s.i, s.d, s.seq, coalesce(s.set_rate, p.r) AS r,
    p.acc + {years('p.d', 's.d', 'c.dc')} * p.r * (c.sgn * c.notional) AS due,
    CASE WHEN s.seq IN (2, 6, 7) THEN 0e0
         ELSE p.acc + {years('p.d', 's.d', 'c.dc')} * p.r * (c.sgn * c.notional) END AS acc
  FROM run p JOIN steps s ON s.scenario = p.scenario AND s.k = p.k AND s.i = p.i + 1 JOIN contracts c ON c.k = s.k
),
events AS (
  SELECT run.scenario, t.k, t.contract_id, t.currency, t.custkey, run.i, run.d, run.seq, run.r,
    CASE seq WHEN 1 THEN 'IED' WHEN 2 THEN 'IP' WHEN 3 THEN 'RRF' WHEN 4 THEN 'RR' WHEN 5 THEN 'PRD'
             WHEN 6 THEN 'TD' ELSE 'MD' END AS type,
    CASE seq WHEN 1 THEN -sgn * (notional + {premium}) WHEN 2 THEN due WHEN 5 THEN -sgn * pprd - due
             WHEN 6 THEN sgn * ptd + due WHEN 7 THEN sgn * notional + due ELSE 0e0 END AS value,
    CASE WHEN seq IN (6, 7) THEN 0e0 ELSE sgn * notional END AS nominal,
    acc AS accrued
  FROM run JOIN terms t ON run.k = t.k
  WHERE seq > 0 AND (bought IS NULL OR bought <= DATE '{t0}' OR bought > coalesce(stop, md)
    OR run.d > bought OR (run.d = bought AND seq >= 5))
)"""
    return "WITH RECURSIVE " + ",".join(parts) + "," + step


def event_table(t0: str, full: bool, market: bool, contracts: str = CONTRACTS, resets_only: str = "true") -> str:
    return states(t0, full, market, False, contracts, resets_only) + f"""
SELECT contract_id, d::VARCHAR AS date, type, currency, {money('value')} AS value, {money('nominal')} AS nominal,
  {money('accrued')} AS accrued
FROM events"""


def segments(curve: str) -> str:
    """Straight pieces of the curves in ``curve(key, years, v)``, flat at both ends."""
    return f"""
    SELECT key, years AS lo, coalesce(lead(years) OVER w, 'Infinity'::DOUBLE) AS hi, years AS base, v,
      coalesce((lead(v) OVER w - v) / (lead(years) OVER w - years), 0e0) AS slope
    FROM ({curve}) WINDOW w AS (PARTITION BY key ORDER BY years)
    UNION ALL
    SELECT key, '-Infinity'::DOUBLE, min(years), min(years), arg_min(v, years), 0e0 FROM ({curve}) GROUP BY key"""


def _micro(value: str) -> str:
    return f"floor(({value}) * 10000e0 + 0.50001e0)::BIGINT::VARCHAR"


FULL_TERMS = {
    "status_date": "ied::VARCHAR",
    "role": "role",
    "contract_id": "contract_id",
    "interest_anchor": "(ied + to_months(ip_months::INT))::DATE::VARCHAR",
    "interest_cycle": "ip_cycle",
    "nominal_rate": "rate",
    "day_count": "day_count",
    "currency": "currency",
    "deal_date": "ied::VARCHAR",
    "initial_exchange_date": "ied::VARCHAR",
    "maturity_date": "md::VARCHAR",
    "notional": "notional",
    "purchase_date": "prd::VARCHAR",
    "purchase_price": "pprd",
    "termination_date": "td::VARCHAR",
    "termination_price": "ptd",
    "scaling_code": "scaling_code",
    "scaling_index": "scaling_index",
    "reset_anchor": "CASE WHEN reset_code IS NOT NULL THEN (ied + to_months(6))::DATE::VARCHAR END",
    "reset_cycle": "CASE WHEN reset_code IS NOT NULL THEN '6M-' END",
    "rate_spread": "spread",
    "reset_code": "reset_code",
    "reset_cycle_point": "'B'",
    "fixing_days": "'2D'",
    "next_reset_rate": "next_rate",
    "rate_multiplier": "1e0",
    "rate_term": "'6M'",
    "premium_discount": "premium",
}
SHORT_TERMS = list(FULL_TERMS)[:12]
# The terms that can be absent as numbers: the first absent one ends a truncating parse.
BREAKING = {
    "purchase_price": "pprd IS NULL OR k % 101 = 0",
    "termination_price": "ptd IS NULL",
    "scaling_index": "scaling_index IS NULL",
    "next_reset_rate": "next_rate IS NULL",
}


def _terms(names: list[str]) -> str:
    columns = ", ".join(f"{FULL_TERMS[n]} AS {n}" for n in names)
    return f"WITH {CONTRACTS} SELECT {columns}, '' AS term_errors FROM contracts"


def _truncated() -> str:
    names = list(FULL_TERMS)
    cases = " ".join(f"WHEN {test} THEN {names.index(name)}" for name, test in BREAKING.items())
    errors = " ".join(f"WHEN {test} THEN '{name}'" for name, test in BREAKING.items())
    columns = ", ".join(f"CASE WHEN cut > {i} THEN {FULL_TERMS[n]} END AS {n}" for i, n in enumerate(names))
    return f"""WITH {CONTRACTS},
cuts AS (SELECT *, CASE {cases} ELSE 99 END AS cut, CASE {errors} ELSE '' END AS broken FROM contracts)
SELECT {columns}, broken AS term_errors FROM cuts"""


def _objects(duplicates: bool) -> str:
    repeated = """
  UNION ALL SELECT code, kind, count(*), min(m)::VARCHAR || 'T00', max(m)::VARCHAR || 'T00', 0
  FROM series WHERE kind = 'ReferenceRate' GROUP BY ALL""" if duplicates else ""
    return f"""WITH {MARKET}
SELECT code, kind, count(*) AS n_points, min(m)::VARCHAR || 'T00' AS first_point, max(m)::VARCHAR || 'T00' AS last_point,
  sum(floor(v * 1e6 + 0.5e0)::BIGINT)::BIGINT AS total_micro
FROM series GROUP BY ALL
UNION ALL SELECT code, kind, count(*), arg_min(tenor, pos), arg_max(tenor, pos),
  sum(floor(v * 1e6 + 0.5e0)::BIGINT)::BIGINT
FROM curves GROUP BY ALL{repeated}"""


def _nested() -> str:
    columns = ", ".join(
        f"coalesce(string_agg({expr}, '|' ORDER BY i), '') AS {name}"
        for name, expr in {
            "id": "e.contract_id",
            "date": "e.d::VARCHAR",
            "type": "type",
            "currency": "e.currency",
            "value": _micro("value"),
            "nominal": _micro("nominal"),
            "accrued": _micro("accrued"),
        }.items()
    )
    return states(BEFORE_ALL, True, True) + f"""
SELECT {columns} FROM contracts c LEFT JOIN events e ON c.k = e.k GROUP BY c.k"""


def _status(code: str, kinds: str) -> str:
    return f"""CASE WHEN {code} IS NULL THEN 'none' WHEN o_{code}.kind IS NULL THEN 'missing'
    WHEN o_{code}.kind NOT IN ({kinds}) THEN 'unsupported_type' ELSE 'ok' END"""


def _parts(key: str, texts: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts))
    return f"CASE ({key}) % {len(texts)} {cases} END"


CYCLE_PARSE = f"""
WITH parts AS (
  SELECT o_orderkey, {_parts('o_orderkey // 2', ['', 'P'])} AS p, o_orderkey % 13 AS n,
    {_parts('o_orderkey // 3', list('DWMQHYX'))} AS u,
    {_parts('o_orderkey // 5', ['', '-', '+', 'L0', 'L1', 'L2'])} AS s,
    CASE WHEN o_orderkey % 19 = 0 THEN (o_orderkey // 19) % 8 END AS odd
  FROM orders
), judged AS (SELECT *, n > 0 AND u <> 'X' AND s <> 'L2' AS good FROM parts),
odd_cycles(odd, text, odd_months, odd_days) AS (VALUES
  (0, '3 M -', NULL, NULL), (1, '3 X -', NULL, NULL), (2, '999999999Y', 11999999988, 0), (3, '200000000M', 200000000, 0),
  (4, '9999999999D', 0, 9999999999), (5, '99999999999999999999D', NULL, NULL), (6, '', NULL, NULL), (7, '-3M', NULL, NULL))
SELECT o_orderkey, coalesce(text, p || n || u || s) AS cycle,
  CASE WHEN text IS NOT NULL THEN odd_months
    WHEN good THEN n * CASE u WHEN 'M' THEN 1 WHEN 'Q' THEN 3 WHEN 'H' THEN 6 WHEN 'Y' THEN 12 ELSE 0 END END AS months,
  CASE WHEN text IS NOT NULL THEN odd_days WHEN good THEN n * CASE u WHEN 'D' THEN 1 WHEN 'W' THEN 7 ELSE 0 END END AS days,
  CASE WHEN text IS NOT NULL THEN CASE WHEN odd_months IS NOT NULL THEN 0 END
    WHEN good THEN CASE WHEN s IN ('+', 'L0') THEN 1 ELSE 0 END END AS long_stub
FROM judged LEFT JOIN odd_cycles USING (odd)"""


# The contracts with the texts planted in the terms that the events show.
PLANTED = CONTRACTS.replace("contracts AS (", "plain AS (", 1) + """,
raw AS (SELECT * REPLACE (
    CASE WHEN k % 139 <> 0 THEN contract_id END AS contract_id, CASE WHEN k % 137 <> 0 THEN currency END AS currency,
    CASE WHEN k % 149 <> 0 THEN pprd END AS pprd, CASE WHEN k % 151 <> 0 THEN ptd END AS ptd) FROM plain)"""
# Of the planted texts, those that are a fault of a contract.
FAULTY = """(k % 101 = 0 AND k % 149 <> 0 OR k % 103 = 0 OR k % 107 = 0 OR k % 109 = 0 OR k % 113 = 0 OR k % 127 = 0
  OR k % 137 = 0 OR k % 139 = 0 OR k % 157 = 0 OR k % 163 = 0 OR k % 11 = 0 AND k % 149 = 0 OR k % 13 = 0 AND k % 151 = 0)"""


def _spoiled(policy: str, t0: str = BEFORE_ALL) -> str:
    """Status and number of events of every contract with the planted faults."""
    names = list(FULL_TERMS)
    cuts = {"maturity_date": "k % 103 = 0"} | BREAKING if policy == "truncate" else {}
    cases = " ".join(f"WHEN {test} THEN {names.index(name)}" for name, test in cuts.items())
    cut = f"CASE {cases} ELSE 99 END" if cuts else "99"
    broken = " ".join(f"WHEN {test} THEN 'unreadable {name}'" for name, test in cuts.items())
    unread = "CASE WHEN k % 101 = 0 AND k % 149 <> 0 THEN 'unreadable purchase_price' END"
    errors = [f"CASE {broken} END"] if cuts else ["CASE WHEN k % 103 = 0 THEN 'unreadable maturity_date' END", unread]

    def upto(term: str, value: str) -> str:
        return f"CASE WHEN cut > {names.index(term)} THEN {value} END"

    def without(price: str, date: str, term: str) -> str:
        other = "" if cuts else f" AND NOT (k % 101 = 0 AND k % 149 <> 0 AND '{term}' = 'purchase_price')"
        return f"CASE WHEN cut > {names.index(term)} AND {date} IS NOT NULL AND {price} IS NULL{other} THEN 'missing {term}' END"

    faults = [
        *errors,
        "CASE WHEN k % 139 = 0 THEN 'missing contract_id' END",
        "CASE WHEN k % 137 = 0 THEN 'missing currency' END",
        f"CASE WHEN cut <= {names.index('notional')} THEN 'missing notional' END",
        without("pprd", "prd", "purchase_price"),
        without("ptd", "td", "termination_price"),
        upto("notional", "CASE WHEN k % 157 = 0 THEN 'not finite notional' END"),
        upto("premium_discount", "CASE WHEN k % 163 = 0 THEN 'not finite premium_discount' END"),
        "CASE WHEN k % 107 = 0 OR k % 127 = 0 THEN 'unknown interest_cycle' END",
        "CASE WHEN k % 109 = 0 THEN 'unknown day_count' END",
        "CASE WHEN k % 113 = 0 THEN 'unknown role' END",
    ]
    return f"""WITH {PLANTED},
cut_terms AS (SELECT *, {cut} AS cut FROM raw),
contracts AS (SELECT * REPLACE (
    CASE WHEN k % 103 <> 0 THEN md END AS md, CASE WHEN k % 107 <> 0 AND k % 127 <> 0 THEN ip_months END AS ip_months,
    {upto('purchase_date', 'prd')} AS prd, {upto('termination_date', 'td')} AS td,
    {upto('reset_cycle', "CASE WHEN k % 131 <> 0 OR reset_code IS NOT NULL THEN reset_code END")} AS reset_code,
    {upto('next_reset_rate', 'next_rate')} AS next_rate) FROM cut_terms),
{schedule(t0, True, "(k % 131 <> 0 OR j = 0)")},
given AS (
  SELECT n.k, count(*) AS n FROM named n JOIN terms t ON n.k = t.k
  WHERE md IS NOT NULL AND (bought IS NULL OR bought <= DATE '{t0}' OR bought > coalesce(stop, md) OR n.d > bought
    OR (n.d = bought AND seq >= 5))
  GROUP BY n.k)
SELECT '{policy}' AS policy, contract_id, coalesce(n, 0) AS n_events,
  coalesce(nullif(concat_ws(', ', {', '.join(faults)}), ''), 'ok') AS contract_status
FROM contracts LEFT JOIN given USING (k)"""


def _faulty_files() -> str:
    """Events of the contracts without a fault, and a status of every contract."""
    good = PLANTED + f", contracts AS (SELECT * FROM raw WHERE NOT {FAULTY})"
    events = event_table(MIDWAY, True, True, good, "(k % 131 <> 0 OR j = 0)")
    return f"""
SELECT 'event' AS record, contract_id, date, type, currency, value, nominal, accrued, NULL AS contract_status,
  NULL::BIGINT AS n_events FROM ({events})
UNION ALL
SELECT 'status', contract_id, NULL, NULL, NULL, NULL, NULL, NULL, contract_status, n_events
FROM ({_spoiled('keep_good', MIDWAY)})"""


def _scenario_values() -> str:
    """Sums by scenario, with what accrues as running sums over windows."""
    return f"""WITH {CONTRACTS}, {MARKET}, {schedule(MIDWAY, True)},
scenarios AS (SELECT n_name || '_' || j AS scenario, (n_nationkey * 8 + j - 100) / 10000e0 AS shift FROM nation, range(0, 8) AS g(j)),
seen AS (
  SELECT n.k, n.d, coalesce(s.v, c.v) AS v
  FROM (SELECT n.k, n.d, reset_code FROM named n JOIN contracts c ON n.k = c.k WHERE seq = 4) n
  ASOF LEFT JOIN (SELECT * FROM series WHERE kind = 'ReferenceRate') s ON n.reset_code = s.code AND n.d >= s.m
  LEFT JOIN (SELECT * FROM curves WHERE tenor = '6M') c ON n.reset_code = c.code),
moving AS (SELECT DISTINCT k FROM seen WHERE v IS NOT NULL),
opening AS (
  SELECT t.k, coalesce((SELECT max(p.d) FROM paydays p WHERE p.k = t.k AND p.d <= DATE '{MIDWAY}'), t.ied) AS d FROM terms t),
dated AS (
  SELECT n.k, n.d, n.seq, seen.v, coalesce(lag(n.d) OVER (PARTITION BY n.k ORDER BY n.d, n.seq), o.d) AS before
  FROM named n JOIN opening o ON n.k = o.k LEFT JOIN seen ON n.seq = 4 AND seen.k = n.k AND seen.d = n.d),
spread AS (
  SELECT d.*, s.scenario, s.shift FROM dated d JOIN moving USING (k), scenarios s
  UNION ALL SELECT d.*, '', 0e0 FROM dated d ANTI JOIN moving USING (k)),
rated AS (
  SELECT x.*, coalesce(last_value(CASE x.seq WHEN 3 THEN c.next_rate WHEN 4 THEN v + shift + c.spread END IGNORE NULLS)
      OVER (PARTITION BY x.scenario, x.k ORDER BY x.d, x.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), c.rate) AS r,
    coalesce(sum(CASE WHEN x.seq IN (2, 6, 7) THEN 1 ELSE 0 END)
      OVER (PARTITION BY x.scenario, x.k ORDER BY x.d, x.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stretch
  FROM spread x JOIN contracts c ON x.k = c.k),
owed AS (
  SELECT x.*, sum({years('x.before', 'x.d', 'c.dc')} * r * (c.sgn * c.notional))
    OVER (PARTITION BY x.scenario, x.k, stretch ORDER BY x.d, x.seq ROWS UNBOUNDED PRECEDING) AS due
  FROM rated x JOIN contracts c ON x.k = c.k),
valued AS (
  SELECT scenario, currency, CASE seq WHEN 1 THEN -sgn * (notional + premium) WHEN 2 THEN due WHEN 5 THEN -sgn * pprd - due
    WHEN 6 THEN sgn * ptd + due WHEN 7 THEN sgn * notional + due ELSE 0e0 END AS value
  FROM owed JOIN terms t ON owed.k = t.k
  WHERE bought IS NULL OR bought <= DATE '{MIDWAY}' OR bought > coalesce(stop, md) OR owed.d > bought OR (owed.d = bought AND seq >= 5)),
sums AS (SELECT scenario, currency, count(*) AS n, sum(value) AS total FROM valued GROUP BY ALL),
all_sums AS (
  SELECT * FROM sums WHERE scenario <> ''
  UNION ALL SELECT s.scenario, currency, n, total FROM sums, scenarios s WHERE sums.scenario = '')
SELECT scenario, currency, sum(n)::BIGINT AS n_events, floor(sum(total) / 1000e0 + 0.5e0)::BIGINT AS thousands
FROM all_sums GROUP BY ALL"""


PART_RATES = """rates AS (
  SELECT 'PRT_' || l_partkey AS code, date_trunc('month', l_shipdate)::DATE AS m,
    ((2 * sum(round(l_discount * 100)::BIGINT) * 10000 + count(*)) // (2 * count(*)))::BIGINT / 1000000e0 AS v
  FROM lineitem GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    spans = "SELECT *, l_shipdate::DATE AS a, (l_shipdate::DATE + (l_orderkey % 2000)::INT)::DATE AS b FROM lineitem"
    fractions = ", ".join(
        f"{half_up(years('a', 'b', str(i)), 10)} AS {name}" for i, name in enumerate(["a365", "a360", "e30360", "aa"])
    )
    plain_curve = "SELECT code AS key, years, v FROM curves"
    zero_curve = "SELECT scenario AS key, years, v + shift AS v FROM curves, shifts WHERE code = 'CRV_0'"
    return {
        "contract_parse": _terms(list(FULL_TERMS)),
        "contract_parse_b": _terms(SHORT_TERMS),
        "contract_parse_truncating": _truncated(),
        "analysis_date": f"""WITH {CONTRACTS}, first AS (SELECT min(ied) AS t0 FROM contracts)
SELECT contract_id, t0::VARCHAR AS t0, CASE WHEN t0 >= ied THEN 1 ELSE 0 END AS running FROM contracts, first""",
        "cycle_parse": CYCLE_PARSE,
        "contract_sign": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'RPA' WHEN 'P' THEN 'RPL' ELSE 'BUY' END AS role,
  CASE o_orderstatus WHEN 'F' THEN 1e0 WHEN 'P' THEN -1e0 END AS sign,
  CASE WHEN o_orderstatus IN ('F', 'P') THEN 0 ELSE 1 END AS unknown
FROM orders""",
        "day_count": f"""
SELECT l_orderkey, l_linenumber, a::VARCHAR AS a, b::VARCHAR AS b, {fractions} FROM ({spans})""",
        "riskfactor_parse": _objects(duplicates=True),
        "riskfactor_dedup": _objects(duplicates=False),
        "riskfactor_by_type": f"""WITH {MARKET}
SELECT code, kind, m::VARCHAR AS point, v AS value FROM series
UNION ALL SELECT code, kind, tenor, v FROM curves""",
        "rf_lookup_reset": f"""WITH {CONTRACTS}, {MARKET}
SELECT contract_id, reset_code, kind AS reset_kind, coalesce(n, 0) AS n_points
FROM contracts LEFT JOIN objects ON reset_code = code""",
        "rf_lookup_scaling": f"""WITH {CONTRACTS}, {MARKET}
SELECT contract_id, scaling_code, o.kind AS scaling_kind, coalesce(o.n, 0) AS n_points,
  {half_up('s.v / scaling_index', 8)} AS index_ratio
FROM contracts c LEFT JOIN objects o ON scaling_code = o.code
ASOF LEFT JOIN series s ON c.scaling_code = s.code AND c.ied >= s.m""",
        "rf_status": f"""WITH {CONTRACTS}, {MARKET},
swapped AS (SELECT contract_id, coalesce(scaling_code, reset_code) AS reset, reset_code AS scaling FROM contracts)
SELECT contract_id, {_status('reset', "'TermStructure', 'ReferenceRate'")} AS reset_status,
  {_status('scaling', "'ReferenceIndex'")} AS scaling_status
FROM swapped LEFT JOIN objects o_reset ON reset = o_reset.code LEFT JOIN objects o_scaling ON scaling = o_scaling.code""",
        "rate_asof": f"""WITH {MARKET}, probes AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'MISSING' ELSE 'REF_' || (o_orderkey % 5) END AS code,
    (o_orderdate::DATE + to_months((6 * (o_orderkey % 20) - 12)::INT))::DATE AS date
  FROM orders)
SELECT o_orderkey, p.code, date::VARCHAR AS date, s.v AS rate
FROM probes p ASOF LEFT JOIN series s ON p.code = s.code AND p.date >= s.m""",
        "curve_interpolate": f"""WITH {MARKET}, pieces AS ({segments(plain_curve)}),
probes AS (SELECT o_orderkey, 'CRV_' || (o_orderkey % 5) AS curve, o_orderkey % 4380 AS days FROM orders)
SELECT o_orderkey, curve, days, {half_up('v + (days / 365e0 - base) * slope', 10)} AS rate
FROM probes LEFT JOIN pieces ON curve = key AND days / 365e0 >= lo AND days / 365e0 < hi""",
        "asof_events": """WITH types AS (SELECT *, CASE event_type WHEN 'click' THEN 'error' WHEN 'error' THEN 'purchase'
    WHEN 'purchase' THEN 'signup' WHEN 'signup' THEN 'view' ELSE 'click' END AS asked FROM events),
seen AS (SELECT user_id, event_type, ts, max(value) AS value FROM events GROUP BY ALL)
SELECT event_id, t.user_id, asked, s.value AS earlier_value
FROM types t ASOF LEFT JOIN seen s ON t.user_id = s.user_id AND t.asked = s.event_type AND t.ts > s.ts""",
        "period_lookup": f"""WITH {CONTRACTS},
paydays AS ({interest_dates("1 = 1")}),
bounds AS (SELECT k, ied AS d FROM contracts UNION ALL SELECT k, d FROM paydays),
periods AS (SELECT k, d AS lo, lead(d) OVER (PARTITION BY k ORDER BY d) AS hi FROM bounds)
SELECT l_orderkey, l_linenumber, l_shipdate::DATE::VARCHAR AS shipped, lo::VARCHAR AS period_start, hi::VARCHAR AS period_end
FROM lineitem JOIN periods ON l_orderkey = k AND l_shipdate::DATE >= lo AND l_shipdate::DATE < hi""",
        "pam_schedule": states(BEFORE_ALL, True, False)
        + " SELECT contract_id, d::VARCHAR AS date, type FROM events",
        "pam_rate_path": states(BEFORE_ALL, True, True)
        + f""", unseen AS (
  SELECT DISTINCT s.k FROM steps s WHERE seq = 4 AND set_rate IS NULL
)
SELECT e.contract_id, d::VARCHAR AS date, type, {half_up('r', 10)} AS rate,
  CASE WHEN o.kind IS NULL THEN 'missing' WHEN u.k IS NOT NULL THEN 'no_observation' ELSE 'ok' END AS reset_status
FROM events e JOIN contracts c ON e.k = c.k LEFT JOIN objects o ON c.reset_code = o.code LEFT JOIN unseen u ON u.k = e.k
WHERE type IN ('RR', 'RRF')""",
        "pam_events_fixed": event_table(BEFORE_ALL, full=False, market=False),
        "pam_events_running": event_table(MIDWAY, full=False, market=False),
        "pam_events_floating": event_table(MIDWAY, full=True, market=True),
        "states_from_rows": event_table(MIDWAY, full=True, market=True),
        "pam_purchase_termination": event_table(BEFORE_ALL, full=True, market=False),
        "event_counts": states(MIDWAY, False, False)
        + """
SELECT c.contract_id, count(e.k) AS n_events FROM contracts c LEFT JOIN events e ON c.k = e.k GROUP BY ALL""",
        "events_nested": _nested(),
        "events_text_lines": _nested(),
        "events_regrouped": _nested(),
        "events_flat": states(BEFORE_ALL, True, True, scenarios=True)
        + f""", pieces AS ({segments(zero_curve)})
SELECT e.scenario AS "riskScenario", c_mktsegment AS portfolio, contract_id AS id, d::VARCHAR AS date, type, currency,
  {money('value')} AS value, {money('nominal')} AS nominal, {money('accrued')} AS accrued,
  {half_up(f"pow(1 + v + (date_diff('day', DATE '{BEFORE_ALL}', d) / 365e0 - base) * slope, "
           f"-(date_diff('day', DATE '{BEFORE_ALL}', d) / 365e0))", 8)} AS discount
FROM events e LEFT JOIN customer ON custkey = c_custkey
LEFT JOIN pieces p ON e.scenario = p.key AND date_diff('day', DATE '{BEFORE_ALL}', d) / 365e0 >= lo
  AND date_diff('day', DATE '{BEFORE_ALL}', d) / 365e0 < hi""",
        "events_spoiled": f"SELECT * FROM ({_spoiled('keep_good')}) UNION ALL SELECT * FROM ({_spoiled('truncate')})",
        "events_from_files": event_table(MIDWAY, full=True, market=True),
        "events_from_faulty_files": _faulty_files(),
        "rf_lookup_large": """WITH probes AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'PRT_1' ELSE 'PRT_' || o_custkey END AS code,
    (o_orderdate::DATE + to_months(12))::DATE AS date FROM orders),
rates AS (
  SELECT 'PRT_' || l_partkey AS code, date_trunc('month', l_shipdate)::DATE AS m,
    ((2 * sum(round(l_discount * 100)::BIGINT) * 10000 + count(*)) // (2 * count(*)))::BIGINT / 1000000e0 AS v
  FROM lineitem GROUP BY ALL)
SELECT way, o_orderkey, p.code, date::VARCHAR AS date, r.v AS rate
FROM probes p ASOF LEFT JOIN rates r ON p.code = r.code AND p.date >= r.m, (VALUES ('broadcast'), ('merged')) AS ways(way)""",
        "lookup_bucketed": f"""WITH probes AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'PRT_1' ELSE 'PRT_' || o_custkey END AS code,
    (o_orderdate::DATE + to_months(12))::DATE AS date FROM orders), {PART_RATES}
SELECT o_orderkey, p.code, date::VARCHAR AS date, r.v AS rate
FROM probes p ASOF LEFT JOIN rates r ON p.code = r.code AND p.date >= r.m""",
        "lookup_filtered": f"""WITH probes AS (
  SELECT o_orderkey, 'PRT_' || (100 * (o_custkey % 20) + 1) AS code, (o_orderdate::DATE + to_months(12))::DATE AS date
  FROM orders), {PART_RATES},
used AS (SELECT count(*) AS n FROM (SELECT DISTINCT code FROM rates) SEMI JOIN probes USING (code))
SELECT o_orderkey, p.code, date::VARCHAR AS date, r.v AS rate, (SELECT n FROM used) AS lines_parsed
FROM probes p ASOF LEFT JOIN rates r ON p.code = r.code AND p.date >= r.m""",
        "scenario_values": _scenario_values(),
        "discount_factor": f"""WITH {CONTRACTS}, {MARKET}, {shifts(True)},
pieces AS ({segments(zero_curve)}),
ahead AS (SELECT contract_id, md, date_diff('day', DATE '{MIDWAY}', md) / 365e0 AS y FROM contracts WHERE md > DATE '{MIDWAY}')
SELECT contract_id, key AS scenario, md::VARCHAR AS date, {half_up('pow(1 + v + (y - base) * slope, -y)', 8)} AS discount
FROM ahead JOIN pieces ON y >= lo AND y < hi""",
        "csv_append_roundtrip": states(BEFORE_ALL, False, False)
        + f"""
SELECT contract_id AS id, d::VARCHAR AS date, type, currency, {money('value')} AS value, {money('nominal')} AS nominal,
  {money('accrued')} AS accrued
FROM events, range(0, 2)""",
        "csv_append_once": states(BEFORE_ALL, False, False)
        + f"""
SELECT contract_id AS id, d::VARCHAR AS date, type, currency, {money('value')} AS value, {money('nominal')} AS nominal,
  {money('accrued')} AS accrued
FROM events""",
        "catalog_roundtrip": "SELECT o_orderkey::INT AS id, strftime(o_orderdate, '%d.%m.%Y') AS datum FROM orders",
        "run_log_table": f"""WITH {MARKET}
SELECT 'events' AS class_name, 'parquet' AS output, '4g' AS ram, count(*)::VARCHAR AS contracts,
  (SELECT count(*) FROM objects)::VARCHAR AS risk_factors, '8' AS nodes, o_orderpriority AS run,
  date_diff('day', min(o_orderdate::DATE), max(o_orderdate::DATE)) AS elapsed
FROM orders GROUP BY o_orderpriority""",
        "token_map": """WITH cut AS (
  SELECT doc_id, CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN [] ELSE string_split(rtrim(text, ' '), ' ') END
    AS tokens FROM documents)
SELECT doc_id, len(tokens) AS n_tokens, tokens[2] AS second, md5(array_to_string(tokens, '|')) AS digest FROM cut""",
        "token_flatmap": """WITH cut AS (
  SELECT CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN [] ELSE string_split(rtrim(text, ' '), ' ') END
    AS tokens FROM documents)
SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM cut) GROUP BY token""",
        "monte_carlo_ratio": """WITH raw AS (
  SELECT (l_orderkey * 8 + l_linenumber) * 0.6180339887498949::DOUBLE AS a,
    (l_partkey * 8 + l_linenumber) * 0.41421356237309515::DOUBLE AS b FROM lineitem
), points AS (SELECT (a - floor(a)) * 2e0 - 1e0 AS x, (b - floor(b)) * 2e0 - 1e0 AS y FROM raw),
totals AS (SELECT sum(CASE WHEN x * x + y * y < 1 THEN 1 ELSE 0 END)::BIGINT AS hits, count(*) AS n FROM points)
SELECT hits, n, 4e0 * hits / n AS ratio FROM totals""",
    }
