"""The registered queries as DuckDB SQL over the same test tables.

Each query names the relations it reads; ``sql()`` puts the needed ones in a WITH list. The
statements are formulated independently of the Spark plans (range joins, native as-of joins,
unions) so that agreement means something.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from ledgerline.dims import TAG_ALIASES

LEVERAGE_HEADING = "Leverage/liquidity trend across the FULL history, including the hiking cycle itself:"
NOTE = (
    "Note: these fits compare changes, since two levels that trend go together whatever their relation. "
    "Each company adds few observations, so take R^2 and p as hints; no fit here shows a cause."
)

RELATIONS: dict[str, str] = {}
QUERIES: dict[str, str] = {}

FLOWS = {"revenues": "revenue", "operating_income": "operating_income", "net_income": "net_income"}
FLOWS["depreciation_amortization"] = "depreciation_amortization"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


# ---- raw tables from the test tables ---------------------------------------------------

RELATIONS["f_quarter"] = """
    SELECT k, qs,
           CAST(sum(c) AS BIGINT) AS rev,
           CAST(sum(CASE WHEN flag <> 'R' THEN c ELSE 0 END) AS BIGINT) AS opi,
           CAST(sum(CASE WHEN flag = 'N' THEN c ELSE 0 END) AS BIGINT) AS net,
           CAST(sum(1000 * q) AS BIGINT) AS da
    FROM (SELECT l_suppkey AS k, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS qs, l_returnflag AS flag,
                 CAST(round(l_extendedprice * 100) AS BIGINT) AS c, CAST(round(l_quantity) AS BIGINT) AS q
          FROM lineitem)
    GROUP BY k, qs"""

RELATIONS["f_dated"] = """
    SELECT *, CAST(qs + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS qe,
           CAST(year(CASE WHEN k % 2 = 1 THEN qs + INTERVAL 3 MONTH ELSE qs END) AS INTEGER) AS fy
    FROM f_quarter"""

RELATIONS["f_year"] = """
    SELECT k, fy, count(*) = 4 AS complete, min(qs) AS fy_start, max(qe) AS fy_last,
           CAST(sum(rev) AS BIGINT) AS fy_rev, CAST(sum(opi) AS BIGINT) AS fy_opi,
           CAST(sum(net) AS BIGINT) AS fy_net, CAST(sum(da) AS BIGINT) AS fy_da
    FROM f_dated GROUP BY k, fy"""

RELATIONS["f_base"] = """
    SELECT d.*, y.complete, y.fy_start, y.fy_last, y.fy_rev, y.fy_opi, y.fy_net, y.fy_da,
           y.complete AND d.qe = y.fy_last AS closing,
           CAST(sum(d.rev) OVER run AS BIGINT) AS run_rev, CAST(sum(d.opi) OVER run AS BIGINT) AS run_opi,
           month(d.qe) AS m
    FROM f_dated d JOIN f_year y USING (k, fy)
    WINDOW run AS (PARTITION BY d.k ORDER BY d.qs ROWS UNBOUNDED PRECEDING)"""

_ITEMS = [
    ("revenues", "rev", "fy_rev", "true"),
    ("operating_income", "opi", "fy_opi", "true"),
    ("net_income", "net", "fy_net", "true"),
    ("depreciation_amortization", "da", "fy_da", "k <> 11"),
    ("assets", "run_rev + run_opi", "NULL", "NOT (k % 13 = 0 AND m = 3)"),
    ("assets_current", "rev", "NULL", "true"),
    ("liabilities", "run_rev", "NULL", "k % 5 <> 0"),
    ("liabilities_current", "CASE WHEN k % 17 = 0 AND m = 6 THEN 0 ELSE opi END", "NULL", "true"),
    ("stockholders_equity", "run_opi", "NULL", "true"),
    ("long_term_debt", "net", "NULL", "k % 7 <> 0"),
    ("short_term_debt", "da", "NULL", "true"),
    ("cash_and_equivalents", "net // 2", "NULL", "true"),
]
RELATIONS["f_item"] = "\n    UNION ALL ".join(
    f"SELECT *, '{concept}' AS concept, CAST({val} AS BIGINT) AS amount, CAST({year} AS BIGINT) AS year_amount, "
    f"'{TAG_ALIASES[concept][0]}' AS tag, {str(year != 'NULL').lower()} AS flow FROM f_base WHERE {keep}"
    for concept, val, year, keep in _ITEMS
)

RELATIONS["f_version"] = """
    SELECT *, '10-Q' AS form, CASE WHEN flow THEN qs END AS p_start,
           qe + CAST(35 + k % 5 + CASE WHEN k % 9 = 0 AND m = 3 THEN 91 ELSE 0 END AS INTEGER) AS p_filed, amount AS val
    FROM f_item WHERE NOT flow OR NOT closing
    UNION ALL
    SELECT *, '10-Q', qs, qe + CAST(400 + k % 5 AS INTEGER),
           amount + CASE WHEN k % 3 = 0 AND concept = 'revenues' THEN 1 ELSE 0 END
    FROM f_item WHERE flow AND NOT closing AND k % 2 = 0
    UNION ALL
    SELECT *, '10-K', fy_start, qe + 60, year_amount
    FROM f_item WHERE flow AND closing AND NOT (k % 10 = 9 AND fy >= 2001)
    UNION ALL
    SELECT *, '8-K', qs, qe + 500, 0 FROM f_item WHERE flow AND NOT closing AND k % 4 = 0"""

RELATIONS["fact_entries"] = f"""
    SELECT 'S' || k AS ticker, concept, tag, form, fy, 'Q' || quarter(qe) AS fp, CAST(p_start AS VARCHAR) AS "start",
           CAST(qe AS VARCHAR) AS "end", CAST(p_filed AS VARCHAR) AS filed, val
    FROM f_version
    UNION ALL
    SELECT 'S' || k, concept, '{TAG_ALIASES["revenues"][1]}', form, fy, 'Q' || quarter(qe), CAST(p_start AS VARCHAR),
           CAST(qe AS VARCHAR), CAST(p_filed AS VARCHAR), val + 7
    FROM f_version WHERE k % 6 = 0 AND concept = 'revenues' AND form <> '8-K'"""

RELATIONS["alias_list"] = "SELECT * FROM (VALUES {}) AS a(concept, tag, rank)".format(
    _values([(concept, tag, i) for concept, tags in TAG_ALIASES.items() for i, tag in enumerate(tags)])
)


def _best_tag(source: str) -> str:
    return f"""
    SELECT e.* FROM {source} e JOIN alias_list a USING (concept, tag)
    QUALIFY a.rank = min(a.rank) OVER (PARTITION BY e.ticker, e.concept)"""


RELATIONS["raw_facts"] = _best_tag("fact_entries")

RELATIONS["raw_prices"] = """
    SELECT CAST(l_shipdate AS DATE) AS "date", max(l_extendedprice) AS "close",
           CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS volume, 'S' || l_suppkey AS ticker
    FROM lineitem GROUP BY 1, l_suppkey"""

RELATIONS["raw_snapshot"] = """
    SELECT 'S' || s_suppkey AS ticker, s_suppkey * 1000 + 1000000 AS shares_outstanding
    FROM supplier WHERE s_suppkey % 19 <> 18"""

RELATIONS["observed"] = """
    SELECT CAST(month AS VARCHAR) AS "date", CAST(rate AS VARCHAR) AS value, series_id
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, (count(*) % 24) * 0.25::DOUBLE AS rate
          FROM orders GROUP BY 1), (VALUES ('FEDFUNDS'), ('DGS10')) AS s(series_id)
    UNION ALL
    SELECT DISTINCT CAST(CAST(date_trunc('year', o_orderdate) AS DATE) + 14 AS VARCHAR), '.', 'FEDFUNDS'
    FROM orders WHERE month(o_orderdate) = 1"""

RELATIONS["raw_series"] = 'SELECT "date", TRY_CAST(value AS DOUBLE) AS value, series_id FROM observed'

RELATIONS["company"] = """
    SELECT CAST(s_suppkey AS INTEGER) AS position, 'S' || s_suppkey AS ticker, s_name AS name, CAST(s_suppkey AS VARCHAR) AS number
    FROM supplier UNION ALL SELECT -1, 'S-NONE', 'No filings', '0'"""

# ---- staging ---------------------------------------------------------------------------

RELATIONS["facts"] = """
    SELECT ticker, concept, tag, form, fy, fp, CAST("start" AS DATE) AS period_start, CAST("end" AS DATE) AS period_end,
           CAST(filed AS DATE) AS filed, val,
           CAST(date_diff('day', CAST("start" AS DATE), CAST("end" AS DATE)) AS INTEGER) AS period_length_days
    FROM raw_facts WHERE form = '10-Q' OR form = '10-K'
    QUALIFY row_number() OVER (PARTITION BY ticker, concept, ifnull("start", ''), "end"
        ORDER BY filed DESC NULLS LAST, form ASC NULLS FIRST, fy DESC NULLS LAST, fp ASC NULLS FIRST, tag ASC NULLS FIRST,
                 val DESC NULLS LAST) = 1"""

RELATIONS["prices"] = """
    SELECT ticker, "date" AS price_date, "close" AS close_price, volume FROM raw_prices WHERE "close" IS NOT NULL"""

RELATIONS["series"] = """
    SELECT series_id, CAST("date" AS DATE) AS obs_date, value FROM raw_series WHERE value IS NOT NULL"""

# ---- marts -----------------------------------------------------------------------------


def _cells(names: dict[str, str], suffix: str = "") -> str:
    return ", ".join(f"max(val) FILTER (WHERE concept = '{c}') AS {out}{suffix}" for c, out in names.items())


RELATIONS["balance"] = f"""
    SELECT ticker, period_end, filed_date, total_assets, current_assets,
           ifnull(liab, total_assets - stockholders_equity) AS total_liabilities, current_liabilities,
           stockholders_equity, ifnull(lt, 0) + ifnull(st, 0) AS total_debt, cash_and_equivalents
    FROM (SELECT ticker, period_end, max(filed) AS filed_date, {_cells({
        "assets": "total_assets", "assets_current": "current_assets", "liabilities": "liab",
        "liabilities_current": "current_liabilities", "stockholders_equity": "stockholders_equity",
        "long_term_debt": "lt", "short_term_debt": "st", "cash_and_equivalents": "cash_and_equivalents"})}
          FROM facts WHERE period_start IS NULL GROUP BY ticker, period_end HAVING total_assets IS NOT NULL)"""

RELATIONS["reported_quarter"] = f"""
    SELECT ticker, period_start, period_end, max(filed) AS filed_date, {_cells(FLOWS)}
    FROM facts WHERE period_length_days >= 80 AND period_length_days <= 100
    GROUP BY ticker, period_start, period_end"""

RELATIONS["reported_year"] = f"""
    SELECT ticker, period_end AS fiscal_year_end, max(filed) AS year_filed, {_cells(FLOWS, "_year")}
    FROM facts WHERE period_length_days >= 350 AND period_length_days <= 380
    GROUP BY ticker, period_end"""

# The bucket of a quarter is the first annual end not before it: a forward as-of join.
RELATIONS["bucketed"] = """
    SELECT q.*, y.fiscal_year_end FROM reported_quarter q
    ASOF JOIN reported_year y ON q.ticker = y.ticker AND q.period_end <= y.fiscal_year_end"""

RELATIONS["bucket"] = """
    SELECT ticker, fiscal_year_end, count(*) AS quarters, max(period_end) AS last_quarter_end, {}
    FROM bucketed GROUP BY ticker, fiscal_year_end""".format(
    ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}_total" for c in FLOWS.values())
)

RELATIONS["fourth"] = """
    SELECT ticker, fiscal_year_end, last_quarter_end AS period_start, fiscal_year_end AS period_end,
           year_filed AS filed_date, {}
    FROM bucket JOIN reported_year USING (ticker, fiscal_year_end) WHERE quarters = 3""".format(
    ", ".join(f"{c}_year - {c}_total AS {c}" for c in FLOWS.values())
)

RELATIONS["fiscal_quarter_rows"] = """
    SELECT ticker, fiscal_year_end, period_start, period_end, filed_date, {0} FROM bucketed
    UNION ALL SELECT ticker, fiscal_year_end, period_start, period_end, filed_date, {0} FROM fourth""".format(
    ", ".join(FLOWS.values())
)

RELATIONS["income"] = """
    SELECT ticker, fiscal_year_end,
           'Q' || row_number() OVER (PARTITION BY ticker, fiscal_year_end ORDER BY period_end, period_start) AS fiscal_quarter,
           period_start, period_end, filed_date, revenue, operating_income, net_income, depreciation_amortization, ebitda,
           CAST(sum(ebitda) OVER last4 AS BIGINT) AS ebitda_ttm, count(*) OVER last4 AS trailing_quarters_available
    FROM (SELECT *, operating_income + ifnull(depreciation_amortization, 0) AS ebitda
          FROM fiscal_quarter_rows WHERE operating_income IS NOT NULL)
    WINDOW last4 AS (PARTITION BY ticker ORDER BY period_end, period_start ROWS 3 PRECEDING)"""

RELATIONS["quarters"] = """
    SELECT ticker, period_end, greatest(b.filed_date, i.filed_date) AS filed_date, total_assets, current_assets,
           total_liabilities, current_liabilities, stockholders_equity, total_debt, cash_and_equivalents,
           round(current_assets / nullif(current_liabilities, 0), 2) AS current_ratio,
           round(total_debt / nullif(stockholders_equity, 0), 2) AS debt_to_equity,
           round(total_liabilities / nullif(total_assets, 0), 2) AS liabilities_to_assets,
           revenue, operating_income, net_income, ebitda,
           if(trailing_quarters_available = 4, i.ebitda_ttm, NULL) AS ebitda_ttm
    FROM balance b LEFT JOIN income i USING (ticker, period_end)"""

RELATIONS["public_quarter"] = """
    SELECT ticker, filed_date, period_end, ebitda_ttm, total_debt, cash_and_equivalents
    FROM quarters WHERE ebitda_ttm IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY ticker, filed_date ORDER BY period_end DESC) = 1"""

RELATIONS["policy_rate"] = "SELECT obs_date, value FROM series WHERE series_id = 'FEDFUNDS'"

RELATIONS["valued"] = """
    SELECT p.ticker, p.price_date, p.close_price, p.close_price * s.shares_outstanding AS market_cap_approx,
           f.period_end AS latest_filed_period_end, f.ebitda_ttm, f.total_debt AS reported_total_debt, f.cash_and_equivalents
    FROM prices p JOIN raw_snapshot s USING (ticker)
    ASOF LEFT JOIN public_quarter f ON p.ticker = f.ticker AND p.price_date >= f.filed_date"""

RELATIONS["valuation"] = """
    SELECT v.*, market_cap_approx + ifnull(reported_total_debt, 0) - ifnull(cash_and_equivalents, 0) AS enterprise_value_approx,
           round(enterprise_value_approx / nullif(ebitda_ttm, 0), 2) AS ev_to_ebitda_approx, r.value AS fed_funds_rate
    FROM valued v ASOF LEFT JOIN policy_rate r ON v.price_date >= r.obs_date"""

# ---- with missing quarters: every third company lacks one in each fourth year -------------------

RELATIONS["gap_facts"] = """
    SELECT * FROM facts WHERE NOT (CAST(substr(ticker, 2) AS BIGINT) % 3 = 1 AND year(period_end) % 4 = 3 AND month(period_end) = 6)"""
_INCOME = ["reported_quarter", "reported_year", "bucketed", "bucket", "fourth", "fiscal_quarter_rows", "income"]
for _name in _INCOME:
    RELATIONS[f"gap_{_name}"] = re.sub(rf"\b(FROM|JOIN) (facts|{'|'.join(_INCOME)})\b", r"\1 gap_\2", RELATIONS[_name])

# ---- what was known on each filing date: the same relations over the facts filed by then -------

RELATIONS["version_row"] = """
    SELECT ticker, concept, tag, form, fy, fp, CAST(nullif("start", '') AS DATE) AS period_start, CAST("end" AS DATE) AS period_end,
           CAST(filed AS DATE) AS filed, val,
           CAST(date_diff('day', CAST(nullif("start", '') AS DATE), CAST("end" AS DATE)) AS INTEGER) AS period_length_days
    FROM raw_facts WHERE (form = '10-Q' OR form = '10-K') AND filed IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY ticker, concept, ifnull("start", ''), "end", filed
        ORDER BY form ASC NULLS FIRST, fy DESC NULLS LAST, fp ASC NULLS FIRST, tag ASC NULLS FIRST, val DESC NULLS LAST) = 1"""

RELATIONS["filing_day"] = "SELECT DISTINCT ticker AS who, filed AS day FROM version_row"

RELATIONS["known_facts"] = """
    SELECT v.* REPLACE (v.ticker || '@' || CAST(d.day AS VARCHAR) AS ticker)
    FROM filing_day d JOIN version_row v ON v.ticker = d.who AND v.filed <= d.day
    QUALIFY row_number() OVER (PARTITION BY d.who, d.day, concept, period_start, period_end ORDER BY filed DESC) = 1"""

_STATEMENTS = [
    "facts", "balance", "reported_quarter", "reported_year", "bucketed", "bucket", "fourth", "fiscal_quarter_rows", "income", "quarters",
]
for _name in _STATEMENTS[1:]:
    RELATIONS[f"known_{_name}"] = re.sub(rf"\b(FROM|JOIN) ({'|'.join(_STATEMENTS)})\b", r"\1 known_\2", RELATIONS[_name])

RELATIONS["state_quarter"] = """
    SELECT split_part(ticker, '@', 1) AS ticker, CAST(split_part(ticker, '@', 2) AS DATE) AS known_from, * EXCLUDE (ticker)
    FROM known_quarters"""

RELATIONS["state_best"] = """
    SELECT d.who AS ticker, d.day, q.period_end, q.ebitda_ttm, q.total_debt, q.cash_and_equivalents
    FROM filing_day d LEFT JOIN (SELECT * FROM state_quarter WHERE ebitda_ttm IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY ticker, known_from ORDER BY period_end DESC) = 1) q
      ON q.ticker = d.who AND q.known_from = d.day"""

# ---- changes and fits ------------------------------------------------------------------

RELATIONS["month_last"] = """
    SELECT ticker, CAST(date_trunc('month', price_date) AS DATE) AS month,
           arg_max(market_cap_approx, price_date) FILTER (WHERE market_cap_approx IS NOT NULL) AS market_cap_approx,
           arg_max(ev_to_ebitda_approx, price_date) FILTER (WHERE ev_to_ebitda_approx IS NOT NULL) AS ev_to_ebitda_approx,
           arg_max(fed_funds_rate, price_date) AS fed_funds_rate
    FROM valuation WHERE fed_funds_rate IS NOT NULL GROUP BY 1, 2"""

RELATIONS["month_grid"] = """
    SELECT g.ticker, g.month AS price_date, market_cap_approx, ev_to_ebitda_approx, fed_funds_rate
    FROM (SELECT ticker, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
          FROM month_last GROUP BY ticker) g
    LEFT JOIN month_last l ON l.ticker = g.ticker AND l.month = g.month"""

RELATIONS["month_change"] = """
    SELECT * FROM (
        SELECT price_date, market_cap_approx, ev_to_ebitda_approx, fed_funds_rate, ticker,
               (market_cap_approx / nullif(lag(market_cap_approx) OVER seq, 0) - 1) * 100 AS market_cap_pct_change,
               (ev_to_ebitda_approx / nullif(lag(ev_to_ebitda_approx) OVER seq, 0) - 1) * 100 AS ev_ebitda_pct_change,
               fed_funds_rate - lag(fed_funds_rate) OVER seq AS rate_change_pp
        FROM month_grid WINDOW seq AS (PARTITION BY ticker ORDER BY price_date))
    WHERE rate_change_pp IS NOT NULL"""

RELATIONS["rate_day"] = """
    SELECT DISTINCT price_date, fed_funds_rate FROM valuation WHERE price_date IS NOT NULL AND fed_funds_rate IS NOT NULL"""

RELATIONS["quarter_change"] = """
    SELECT * FROM (
        SELECT period_end, debt_to_equity, current_ratio, price_date, fed_funds_rate, ticker,
               debt_to_equity - lag(debt_to_equity) OVER seq AS de_change,
               current_ratio - lag(current_ratio) OVER seq AS cr_change,
               fed_funds_rate - lag(fed_funds_rate) OVER seq AS rate_change_pp
        FROM (SELECT q.ticker, q.period_end, q.debt_to_equity, q.current_ratio, d.price_date, d.fed_funds_rate
              FROM quarters q ASOF LEFT JOIN rate_day d ON q.period_end >= d.price_date)
        WINDOW seq AS (PARTITION BY ticker ORDER BY period_end, debt_to_equity, current_ratio))
    WHERE rate_change_pp IS NOT NULL"""


def _p_value(n: str, r2: str) -> str:
    """Two-sided t tail through the finite series for even and odd degrees of freedom."""
    nu = f"CAST({n} - 2 AS BIGINT)"
    even = (
        f"sqrt({r2}) * list_sum([exp(lgamma(j + 0.5) - lgamma(j + 1.0) - 0.5 * ln(pi())) * pow(1 - {r2}, j) "
        f"FOR j IN range(0, {nu} // 2)])"
    )
    odd = (
        f"2 / pi() * (asin(sqrt({r2})) + sqrt({r2} * (1 - {r2})) * list_sum([exp(lgamma(j + 1.0) - lgamma(j + 1.5) "
        f"+ 0.5 * ln(pi()) - ln(2)) * pow(1 - {r2}, j) FOR j IN range(0, ({nu} - 1) // 2)]))"
    )
    tail = f"least(greatest(1 - CASE WHEN {nu} % 2 = 0 THEN {even} ELSE {odd} END, 0), 1)"
    return f"CASE WHEN {r2} IS NOT NULL THEN {tail} END"


def _fit(y: str, source: str, by: str = "", extra: str = "") -> str:
    """n, beta, r2 and p of one response on the rate change; degenerate fits are null."""
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
    SELECT {lead}{extra} n, round(beta, 6) AS beta, round(r2, 6) AS r2, round({_p_value("n", "r2")}, 6) AS pvalue
    FROM (SELECT {lead}{extra.replace("n_companies", "count(DISTINCT ticker) AS n_companies")}
                 CAST(regr_count({y}, rate_change_pp) AS BIGINT) AS n,
                 CASE WHEN regr_count({y}, rate_change_pp) >= 6 AND regr_sxx({y}, rate_change_pp) > 0
                      THEN regr_slope({y}, rate_change_pp) END AS beta,
                 CASE WHEN regr_count({y}, rate_change_pp) >= 6 AND regr_sxx({y}, rate_change_pp) > 0
                       AND regr_syy({y}, rate_change_pp) > 0 THEN regr_r2({y}, rate_change_pp) END AS r2
          FROM {source} {group})"""


_RESPONSES = {
    "cap": ("market_cap", "market_cap_pct_change", "month_change"),
    "mult": ("ev_ebitda", "ev_ebitda_pct_change", "month_change"),
    "debt": ("debt_to_equity", "de_change", "quarter_change"),
    "liq": ("current_ratio", "cr_change", "quarter_change"),
}
for _short, (_, _y, _source) in _RESPONSES.items():
    RELATIONS[f"fit_{_short}"] = _fit(_y, _source, by="ticker")
    RELATIONS[f"pool_{_short}"] = _fit(_y, _source, extra="n_companies,")


def _by_ticker(first: str, second: str, count_as: str) -> str:
    a, b = _RESPONSES[first][0], _RESPONSES[second][0]
    return f"""
    SELECT ticker, x.n AS {count_as}, x.beta AS {a}_beta, x.r2 AS {a}_r2, x.pvalue AS {a}_pvalue,
           y.beta AS {b}_beta, y.r2 AS {b}_r2, y.pvalue AS {b}_pvalue
    FROM fit_{first} x JOIN fit_{second} y USING (ticker)"""


def _pooled(*shorts: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{_RESPONSES[s][0]}' AS response, n, beta, r2 AS r_squared, pvalue AS p_value, n_companies FROM pool_{s}"
        for s in shorts
    )


# ---- summaries -------------------------------------------------------------------------

RELATIONS["rate_facts"] = """
    SELECT min(fed_funds_rate) AS low, max(fed_funds_rate) AS peak, min(price_date) AS first_date,
           max(price_date) AS last_date, arg_max(fed_funds_rate, price_date) AS latest FROM rate_day"""

RELATIONS["cap_facts"] = """
    SELECT ticker, min(price_date) AS first_date, max(price_date) AS last_date,
           (arg_max(market_cap_approx, price_date) / nullif(arg_min(market_cap_approx, price_date), 0) - 1) * 100 AS pct_change
    FROM valuation WHERE market_cap_approx IS NOT NULL GROUP BY ticker"""

RELATIONS["lever_facts"] = """
    SELECT ticker, first_row.period_end AS first_period, first_row.debt_to_equity AS first_debt_to_equity,
           first_row.current_ratio AS first_current_ratio, last_row.period_end AS last_period,
           last_row.debt_to_equity AS last_debt_to_equity, last_row.current_ratio AS last_current_ratio,
           peak AS peak_debt_to_equity, peak_period
    FROM (SELECT ticker, arg_min(q, period_end) AS first_row, arg_max(q, period_end) AS last_row, max(debt_to_equity) AS peak
          FROM quarters q WHERE debt_to_equity IS NOT NULL GROUP BY ticker) e
    JOIN (SELECT ticker, debt_to_equity AS peak, min(period_end) AS peak_period FROM quarters GROUP BY 1, 2) p USING (ticker, peak)"""

# ---- the registered queries ------------------------------------------------------------

QUERIES["flatten_payloads"] = _best_tag("""(SELECT * FROM fact_entries WHERE form <> '8-K' AND "end" >= '1996-01-01')""")
QUERIES["flatten_series"] = "SELECT * FROM raw_series"
QUERIES["shape_prices"] = "SELECT * FROM raw_prices"
QUERIES["shape_snapshot"] = """
    SELECT 'S' || s_suppkey AS ticker, CASE WHEN s_suppkey % 3 = 0 THEN CAST(round(s_acctbal * 100) AS BIGINT) END AS market_cap,
           CAST(NULL AS BIGINT) AS enterprise_value, CASE WHEN s_suppkey % 4 = 0 THEN (s_suppkey % 50) * 0.5::DOUBLE END AS trailing_pe,
           CAST(NULL AS DOUBLE) AS forward_pe, CAST(NULL AS DOUBLE) AS ev_to_ebitda,
           s_suppkey * 1000 + 1000000 AS shares_outstanding, CAST(NULL AS BIGINT) AS total_debt, CAST(NULL AS BIGINT) AS total_cash
    FROM supplier"""
QUERIES["union_tolerant"] = "SELECT * FROM fact_entries"
QUERIES["alias_resolution"] = _best_tag("""(SELECT * FROM fact_entries WHERE "end" >= '1996-01-01')""")
QUERIES["missing_concepts_report"] = """
    SELECT c.ticker, a.concept FROM company c, (SELECT DISTINCT concept FROM alias_list) a
    WHERE NOT EXISTS (SELECT 1 FROM raw_facts r WHERE r.ticker = c.ticker AND r.concept = a.concept)"""
QUERIES["company_dim"] = "SELECT position, ticker, name, lpad(number, 10, '0') AS cik FROM company"
QUERIES["load_counts"] = """
    SELECT 'raw_edgar_facts' AS table_name, count(*) AS n_rows FROM raw_facts
    UNION ALL SELECT 'raw_yfinance_prices', count(*) FROM raw_prices
    UNION ALL SELECT 'raw_yfinance_valuation_snapshot', count(*) FROM raw_snapshot
    UNION ALL SELECT 'raw_fred_series', count(*) FROM raw_series"""
QUERIES["loaded_tables"] = QUERIES["load_counts"]
QUERIES["read_concept_files"] = QUERIES["flatten_payloads"]
QUERIES["read_series_files"] = QUERIES["flatten_series"]
QUERIES["read_price_files"] = """SELECT "date", "close", volume, lpad(substr(ticker, 2), 6, '0') AS ticker FROM raw_prices"""
QUERIES["read_snapshot_files"] = QUERIES["shape_snapshot"]
QUERIES["sorted_mart"] = "SELECT ticker, period_end, revenue, true AS in_order FROM quarters"
QUERIES["warehouse_counts"] = """
    SELECT 'fct_balance_sheet_quarterly' AS table_name, count(*) AS n_rows FROM balance
    UNION ALL SELECT 'fct_income_statement_quarterly', count(*) FROM income
    UNION ALL SELECT 'fct_financials_quarterly', count(*) FROM quarters
    UNION ALL SELECT 'fct_valuation_daily', count(*) FROM valuation"""
QUERIES["stage_facts"] = "SELECT * FROM facts"
QUERIES["stage_prices"] = "SELECT * FROM prices"
QUERIES["stage_series"] = "SELECT * FROM series"
QUERIES["stage_snapshot"] = """
    SELECT ticker, CAST(NULL AS BIGINT) AS market_cap, CAST(NULL AS BIGINT) AS enterprise_value, CAST(NULL AS DOUBLE) AS trailing_pe,
           CAST(NULL AS DOUBLE) AS forward_pe, CAST(NULL AS DOUBLE) AS ev_to_ebitda_asof_today, shares_outstanding,
           CAST(NULL AS BIGINT) AS total_debt, CAST(NULL AS BIGINT) AS total_cash
    FROM raw_snapshot"""
QUERIES["balance_sheet"] = "SELECT * FROM balance"
QUERIES["fiscal_year_buckets"] = """
    SELECT ticker, fiscal_year_end, prior_fiscal_year_end, quarters, last_quarter_end, {}
    FROM bucket JOIN (SELECT ticker, fiscal_year_end, lag(fiscal_year_end) OVER (PARTITION BY ticker ORDER BY fiscal_year_end)
                             AS prior_fiscal_year_end FROM reported_year) USING (ticker, fiscal_year_end)""".format(
    ", ".join(f"{c}_total" for c in FLOWS.values())
)
QUERIES["q4_derived"] = "SELECT * FROM fourth"
QUERIES["income_statement"] = "SELECT * FROM income"
QUERIES["financials"] = "SELECT * FROM quarters"
QUERIES["asof_keyed"] = """
    SELECT p.ticker, p.price_date, p.close_price, f.filed_date, f.period_end, f.total_assets
    FROM prices p ASOF LEFT JOIN
         (SELECT * FROM quarters QUALIFY row_number() OVER (PARTITION BY ticker, filed_date ORDER BY period_end DESC) = 1) f
      ON p.ticker = f.ticker AND p.price_date >= f.filed_date"""
QUERIES["asof_keyless"] = """
    SELECT p.ticker, p.price_date, r.obs_date, r.value FROM prices p ASOF LEFT JOIN policy_rate r ON p.price_date >= r.obs_date"""
QUERIES["valuation_daily"] = "SELECT * FROM valuation"
QUERIES["income_statement_contiguous"] = """
    SELECT i.* EXCLUDE (ebitda_ttm, trailing_quarters_available), CAST(w.total AS BIGINT) AS ebitda_ttm, w.n AS trailing_quarters_available
    FROM gap_income i JOIN (
        SELECT a.ticker, a.period_start, a.period_end, sum(b.ebitda) AS total, count(*) AS n
        FROM gap_income a JOIN gap_income b
          ON a.ticker = b.ticker AND b.period_end <= a.period_end AND b.period_end >= a.period_end - 290
        GROUP BY ALL) w ON i.ticker = w.ticker AND i.period_start = w.period_start AND i.period_end = w.period_end"""
QUERIES["fact_versions"] = """
    SELECT *, filed AS known_from, lead(filed) OVER (PARTITION BY ticker, concept, period_start, period_end ORDER BY filed) AS known_to
    FROM version_row"""
# A row reads the same as in the company's state before when all its columns do; runs of such states are one row.
QUERIES["financials_first_filed"] = """
    SELECT any_value(x.r.ticker) AS ticker, {0}, min(x.day) AS known_from, CASE WHEN count(x.until) = count(*) THEN max(x.until) END AS known_to FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY r.ticker, r.period_end ORDER BY day) AS run FROM (
            SELECT q.r, s.day, s.until, CASE WHEN lag(s.nth) OVER w = s.nth - 1 AND lag(q.read) OVER w = q.read THEN 0 ELSE 1 END AS fresh
            FROM (SELECT state_quarter AS r, CAST(row({1}) AS VARCHAR) AS read FROM state_quarter) q
            JOIN (SELECT who, day, row_number() OVER c AS nth, lead(day) OVER c AS until FROM filing_day
                  WINDOW c AS (PARTITION BY who ORDER BY day)) s ON q.r.ticker = s.who AND q.r.known_from = s.day
            WINDOW w AS (PARTITION BY q.r.ticker, q.r.period_end ORDER BY s.day))) x
    GROUP BY x.r.ticker, x.r.period_end, x.run"""
_READ = [
    "period_end", "filed_date", "total_assets", "current_assets", "total_liabilities", "current_liabilities", "stockholders_equity",
    "total_debt", "cash_and_equivalents", "current_ratio", "debt_to_equity", "liabilities_to_assets", "revenue", "operating_income",
    "net_income", "ebitda", "ebitda_ttm",
]
QUERIES["financials_first_filed"] = QUERIES["financials_first_filed"].format(
    ", ".join(f"any_value(x.r.{c}) AS {c}" for c in _READ), ", ".join(_READ)
)
QUERIES["valuation_first_filed"] = """
    SELECT v.*, market_cap_approx + ifnull(reported_total_debt, 0) - ifnull(cash_and_equivalents, 0) AS enterprise_value_approx,
           round(enterprise_value_approx / nullif(ebitda_ttm, 0), 2) AS ev_to_ebitda_approx, r.value AS fed_funds_rate
    FROM (SELECT p.ticker, p.price_date, p.close_price, p.close_price * s.shares_outstanding AS market_cap_approx,
                 f.period_end AS latest_filed_period_end, f.ebitda_ttm, f.total_debt AS reported_total_debt, f.cash_and_equivalents
          FROM prices p JOIN raw_snapshot s USING (ticker)
          ASOF LEFT JOIN state_best f ON p.ticker = f.ticker AND p.price_date >= f.day) v
    ASOF LEFT JOIN policy_rate r ON v.price_date >= r.obs_date"""
QUERIES["not_null_checks"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {source}"
    for table, source, columns in [
        ("fct_balance_sheet_quarterly", "balance", ["ticker", "period_end", "total_assets"]),
        ("fct_income_statement_quarterly", "income", ["ticker", "period_end"]),
        ("fct_financials_quarterly", "quarters", ["ticker", "period_end", "current_ratio", "debt_to_equity"]),
        ("fct_valuation_daily", "valuation", ["ticker", "price_date"]),
    ]
    for c in columns
)
QUERIES["monthly_resample"] = "SELECT * FROM month_grid"
QUERIES["monthly_changes"] = "SELECT * FROM month_change"
QUERIES["quarterly_leverage_changes"] = "SELECT * FROM quarter_change"
QUERIES["ols_valuation_by_ticker"] = _by_ticker("cap", "mult", "months")
QUERIES["ols_valuation_pooled"] = _pooled("cap", "mult")
QUERIES["ols_valuation_selected"] = QUERIES["ols_valuation_pooled"]
QUERIES["ols_leverage_by_ticker"] = _by_ticker("debt", "liq", "quarters")
QUERIES["ols_leverage_pooled"] = _pooled("debt", "liq")


def _line(source: str, y: str) -> str:
    return f"""
    SELECT ticker, round(rate_change_pp, 6) AS rate_change_pp, round({y}, 6) AS {y},
           round(a + b * rate_change_pp, 6) AS trend
    FROM {source}, (SELECT regr_slope({y}, rate_change_pp) AS b, regr_intercept({y}, rate_change_pp) AS a FROM {source})
    WHERE {y} IS NOT NULL"""


QUERIES["trendline"] = _line("month_change", "market_cap_pct_change")
QUERIES["trendline_leverage"] = _line("quarter_change", "de_change")
QUERIES["trend_rate"] = "SELECT * FROM rate_facts"
QUERIES["trend_market_cap"] = "SELECT * FROM cap_facts"
QUERIES["trend_leverage"] = "SELECT * FROM lever_facts"

QUERIES["trend_summary_text"] = f"""
    SELECT CAST(section AS INTEGER) AS section, ticker, line FROM (
    SELECT 1 AS section, '' AS ticker, printf('Fed funds rate: %.2f%% (low) to %.2f%% (peak) over %s to %s; most recent value %.2f%%.',
           low, peak, CAST(first_date AS VARCHAR), CAST(last_date AS VARCHAR), latest) AS line FROM rate_facts
    UNION ALL
    SELECT 2, ticker, printf('%s: approx. market cap changed %+.0f%% from %s to %s.', ticker, pct_change,
           CAST(first_date AS VARCHAR), CAST(last_date AS VARCHAR)) FROM cap_facts
    UNION ALL SELECT 3, '', '' UNION ALL SELECT 4, '', '{LEVERAGE_HEADING}'
    UNION ALL
    SELECT 5, ticker, printf('%s: debt/equity was %.2f as of %s, peaked at %.2f (%s), now %.2f (%s). Current ratio: ', ticker,
           first_debt_to_equity, CAST(first_period AS VARCHAR), peak_debt_to_equity, CAST(peak_period AS VARCHAR),
           last_debt_to_equity, CAST(last_period AS VARCHAR)) || ifnull(printf('%.2f', first_current_ratio), 'nan') || ' -> '
           || ifnull(printf('%.2f', last_current_ratio), 'nan') || ' over the same window.' FROM lever_facts
    UNION ALL SELECT 6, '', ''
    UNION ALL
    SELECT 7, '', printf('Regression (month-over-month changes, pooled across all %d companies, n=%d company-months): a 1 percentage point change in the Fed funds rate is associated with a %+.2f percentage point change in market cap that same month (R^2=%.3f, p=%.3f).',
           n_companies, n, beta, r2, pvalue) FROM pool_cap WHERE beta IS NOT NULL
    UNION ALL
    SELECT 8, '', printf('Same regression against EV/EBITDA: %+.2f pp change in EV/EBITDA per 1pp rate change (R^2=%.3f, p=%.3f).',
           beta, r2, pvalue) FROM pool_mult WHERE beta IS NOT NULL
    UNION ALL
    SELECT 9, '', printf('Regression (quarter-over-quarter changes, pooled, n=%d company-quarters): a 1 percentage point change in the Fed funds rate is associated with a %+.3f change in debt-to-equity that quarter (R^2=%.3f, p=%.3f).',
           n, beta, r2, pvalue) FROM pool_debt WHERE beta IS NOT NULL
    UNION ALL
    SELECT 10, '', printf('Same regression against the current ratio: %+.3f change per 1pp rate change (R^2=%.3f, p=%.3f).',
           beta, r2, pvalue) FROM pool_liq WHERE beta IS NOT NULL
    UNION ALL SELECT 11, '', '{NOTE.replace("'", "''")}'
    UNION ALL SELECT 12, ticker, printf('%s=%+.2f', ticker, beta) FROM fit_cap WHERE beta IS NOT NULL
    UNION ALL SELECT 13, ticker, printf('%s=%+.3f', ticker, beta) FROM fit_debt WHERE beta IS NOT NULL)"""

QUERIES["latest_snapshot"] = """
    SELECT c.position, c.ticker, b.period_end, b.current_ratio, b.debt_to_equity, b.liabilities_to_assets, r.revenue, r.ebitda_ttm
    FROM company c
    LEFT JOIN (SELECT * FROM quarters QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC) = 1) b USING (ticker)
    LEFT JOIN (SELECT * FROM quarters WHERE revenue IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC) = 1) r USING (ticker)"""
QUERIES["report_text"] = f"""
    SELECT string_agg(line, chr(10) ORDER BY section, ticker, line) AS text FROM (
        SELECT section, ticker, line FROM ({QUERIES["trend_summary_text"]}) WHERE section < 12
        UNION ALL
        SELECT section, '', CASE section WHEN 12 THEN 'Per-company beta (market cap %-change per 1pp rate change): '
               ELSE 'Per-company beta (debt-to-equity change per 1pp rate change): ' END || string_agg(line, ', ' ORDER BY line)
        FROM ({QUERIES["trend_summary_text"]}) WHERE section >= 12 GROUP BY section)"""
QUERIES["report_without_data"] = """
    SELECT '(no valuation/Fed rate data available)' AS text FROM (SELECT count(*) AS n FROM valuation WHERE ticker = 'S-NONE') WHERE n = 0"""
QUERIES["ratio_lines"] = """
    SELECT period_end, ticker, 'debt_to_equity' AS ratio, debt_to_equity AS value FROM quarters
    UNION ALL SELECT period_end, ticker, 'current_ratio', current_ratio FROM quarters"""
QUERIES["indexed_series"] = """
    SELECT price_date, ticker, market_cap_approx / first_value(market_cap_approx) OVER (PARTITION BY ticker ORDER BY price_date) * 100
           AS market_cap_indexed FROM valuation"""
QUERIES["rate_series"] = "SELECT * FROM rate_day"
QUERIES["multiple_series"] = "SELECT price_date, ticker, ev_to_ebitda_approx FROM valuation WHERE ev_to_ebitda_approx IS NOT NULL"
QUERIES["grounding_table"] = """
    SELECT ticker, period_end, revenue, net_income, ebitda, ebitda_ttm, current_ratio, debt_to_equity, liabilities_to_assets,
           total_assets, total_debt, stockholders_equity FROM quarters"""
QUERIES["grounding_csv"] = QUERIES["grounding_table"]
QUERIES["latest_event_per_user"] = """
    SELECT user_id, event_id, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
QUERIES["status_pivot"] = """
    SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS max_open,
           max(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS max_filled,
           max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS max_pending
    FROM orders GROUP BY o_custkey"""

_ORDER = list(RELATIONS)

# Queries over a picked list of companies, as in fixtures.queries.display_list.
_PICKED = {"ols_valuation_selected", "report_text"}
_PICK = "(SELECT ticker FROM company WHERE position > 0 ORDER BY position LIMIT 5)"


def _needed(text: str, relations: Mapping[str, str]) -> set[str]:
    found: set[str] = set()
    pending = [text]
    while pending:
        # only relation positions count: names following FROM, JOIN or a comma
        for name in set(re.findall(r"(?:FROM|JOIN|,)\s+\(?(\w+)", pending.pop())) & relations.keys() - found:
            found.add(name)
            pending.append(relations[name])
    return found


def sql(name: str, stored: Mapping[str, str] | None = None) -> str:
    """The statement of a query; ``stored`` replaces relations by reads of tables written before."""
    body = QUERIES[name]
    texts = {**RELATIONS, **(stored or {})}
    needed = _needed(body, texts)
    if not needed:
        return body.strip()
    if name in _PICKED:
        needed |= {"company"}
        for rel in ("quarters", "valuation"):
            texts[rel] = f"SELECT * FROM ({texts[rel]}) WHERE ticker IN {_PICK}"
    how = "AS MATERIALIZED" if stored else "AS"
    parts = ",\n".join(f"{rel} {how} ({texts[rel]})" for rel in sorted(needed, key=_ORDER.index))
    return f"WITH {parts}\n{body.strip()}"


def all_sql() -> dict[str, str]:
    return {name: sql(name) for name in QUERIES}
