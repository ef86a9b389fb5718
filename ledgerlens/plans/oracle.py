"""DuckDB SQL for each query of the catalog, over the same tables."""

from __future__ import annotations

from ledgerlens.operators.profile import SHAPE_SENTENCE
from ledgerlens.schema import HOME_COUNTRY
from ledgerlens.sources import segments as names

_SALES = f"""
items AS (SELECT l_orderkey, sum(l_quantity) AS items FROM lineitem GROUP BY l_orderkey),
one_copy AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS invoice_no,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS customer_id,
    CAST(o_orderdate AS TIMESTAMP) AS invoice_ts,
    CASE WHEN o_custkey % 4 <> 0 OR o_orderkey % 9 = 0 THEN '{HOME_COUNTRY}' ELSE n_name END AS country,
    CAST(coalesce(items, 0) AS BIGINT) * CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE 1 END AS quantity,
    replace(CAST(CASE WHEN o_orderkey % 11 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2))
                      ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS VARCHAR), '.', ',') AS amount_txt
  FROM orders LEFT JOIN items ON l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey),
sales AS (
  SELECT * EXCLUDE (o_orderkey) FROM one_copy
  UNION ALL SELECT * EXCLUDE (o_orderkey) FROM one_copy WHERE o_orderkey % 50 = 1),
"""

_CLEAN = (
    _SALES
    + f"""
kept AS (
  SELECT DISTINCT * FROM sales WHERE quantity IS NULL OR quantity >= 0),
clean AS (
  SELECT invoice_no, customer_id, invoice_ts, country, quantity,
    CAST(replace(amount_txt, ',', '.') AS DECIMAL(18,2)) AS amount,
    CAST(date_trunc('month', invoice_ts) AS DATE) AS month, country = '{HOME_COUNTRY}' AS is_home
  FROM kept
  WHERE invoice_no IS NOT NULL AND customer_id IS NOT NULL AND invoice_ts IS NOT NULL
    AND country IS NOT NULL AND quantity IS NOT NULL AND amount_txt IS NOT NULL),
"""
)

_COHORT = (
    _CLEAN
    + """
firsts AS (SELECT customer_id, min(month) AS cohort_month FROM clean GROUP BY customer_id),
cohorted AS (
  SELECT clean.*, cohort_month,
    CAST((year(month) - year(cohort_month)) * 12 + month(month) - month(cohort_month) + 1 AS INTEGER) AS cohort_index
  FROM clean JOIN firsts USING (customer_id)),
scoped AS (
  SELECT 'all' AS scope, * FROM cohorted
  UNION ALL SELECT CASE WHEN is_home THEN 'home' ELSE 'away' END, * FROM cohorted),
counts AS (
  SELECT scope, cohort_month, cohort_index, count(DISTINCT customer_id) AS customers
  FROM scoped GROUP BY scope, cohort_month, cohort_index),
lowest AS (SELECT scope, min(cohort_index) AS cohort_index FROM counts GROUP BY scope),
sizes AS (
  SELECT scope, cohort_month, customers AS cohort_size FROM counts JOIN lowest USING (scope, cohort_index)),
rates AS (
  SELECT counts.*, cohort_size, CAST(customers AS DOUBLE) / cohort_size AS rate
  FROM counts LEFT JOIN sizes USING (scope, cohort_month)),
"""
)

_MONTHLY = (
    _CLEAN
    + """
monthly AS (
  SELECT month, count(DISTINCT invoice_no) AS invoices, count(DISTINCT customer_id) AS customers,
    CAST(sum(quantity) AS BIGINT) AS items, CAST(sum(amount) AS DOUBLE) AS revenue
  FROM clean GROUP BY month),
"""
)

_COUNTRY = (
    _CLEAN
    + """
panorama AS (
  SELECT country, count(DISTINCT customer_id) AS customers, count(DISTINCT invoice_no) AS invoices,
    CAST(min(amount) AS DOUBLE) AS min_amount, CAST(max(amount) AS DOUBLE) AS max_amount,
    CAST(sum(amount) AS DOUBLE) / count(*) AS mean_amount, CAST(sum(amount) AS DOUBLE) AS revenue,
    CAST(sum(quantity) AS BIGINT) AS items
  FROM clean GROUP BY country),
"""
)

_BASE = (
    _CLEAN
    + """
base AS (
  SELECT customer_id, max(invoice_ts) AS last_ts, min(invoice_ts) AS first_ts,
    count(invoice_no) AS frequency, sum(amount) AS monetary
  FROM clean GROUP BY customer_id),
rfm AS (
  SELECT *, CAST(floor((epoch_us(TIMESTAMP '2001-08-02') - epoch_us(last_ts)) / 86400000000.0) AS BIGINT) AS recency
  FROM base),
"""
)


def _edges_of(measure: str) -> str:
    edges = ", ".join(
        f"round(quantile_cont(CAST({measure} AS DOUBLE), {p / 100}), 4) AS p{p}" for p in (25, 50, 75)
    )
    return f"SELECT '{measure}' AS measure, {edges}, CAST(max({measure}) AS DOUBLE) AS max FROM rfm"


def _score_of(measure: str, score: str) -> str:
    bins = " ".join(
        f"WHEN {measure} <= (SELECT p{p} FROM edges WHERE measure = '{measure}') THEN {i}"
        for i, p in enumerate((25, 50, 75), 1)
    )
    return f"CAST(CASE {bins} ELSE 4 END AS INTEGER) AS {score}"


_SCORED = (
    _BASE
    + "edges AS ("
    + " UNION ALL ".join(_edges_of(m) for m in ("recency", "frequency", "monetary"))
    + "),\nscored AS (SELECT *, "
    + ", ".join(_score_of(m, s) for m, s in (("recency", "r"), ("frequency", "f"), ("monetary", "m")))
    + " FROM rfm),\n"
    + f"""
labelled AS (
  SELECT *, CAST(r AS VARCHAR) || CAST(f AS VARCHAR) || CAST(m AS VARCHAR) AS rfm_code,
    CASE WHEN r <= 2 AND f = 1 THEN '{names.NEW}'
         WHEN r <= 2 AND m <= 2 THEN '{names.PROMISING}'
         WHEN r <= 2 AND f = 2 THEN '{names.POTENTIAL_LOYAL}'
         WHEN r = 1 AND f = 4 AND m = 4 THEN '{names.BEST}'
         WHEN r <= 2 THEN '{names.LOYAL}'
         WHEN f >= 3 AND m >= 3 THEN '{names.NEEDS_ATTENTION}'
         WHEN r = 3 THEN '{names.ABOUT_TO_HIBERNATE}'
         WHEN f + m <= 3 THEN '{names.LOST}'
         ELSE '{names.HIBERNATING}' END AS category
  FROM scored),
summary AS (
  SELECT category, count(DISTINCT customer_id) AS customers, sum(monetary) AS revenue
  FROM labelled GROUP BY category),
"""
)

_KPIS = """
SELECT {by} count(*) AS customers, CAST(sum(spend) AS DOUBLE) AS revenue,
  CAST(count(*) FILTER (WHERE invoices > 1) AS BIGINT) AS repeat_customers,
  CAST(sum(spend) AS DOUBLE) / count(*) AS avg_customer_spend,
  CAST(count(*) FILTER (WHERE invoices > 1) AS DOUBLE) / count(*) AS repeat_rate
FROM (SELECT {by} customer_id, sum(amount) AS spend, count(DISTINCT invoice_no) AS invoices
      FROM clean GROUP BY {by} customer_id) {group}
"""

_CURVE = (
    _BASE
    + """
curve AS (
  SELECT monetary, count(*) AS customers,
    CAST(sum(count(*)) OVER (ORDER BY monetary DESC) AS BIGINT) AS top_customers,
    sum(sum(monetary)) OVER (ORDER BY monetary DESC) AS top_revenue,
    CAST(sum(count(*)) OVER () AS BIGINT) AS all_customers, sum(sum(monetary)) OVER () AS all_revenue
  FROM base GROUP BY monetary),
"""
)

_RAW_TYPES = {
    "invoice_no": "string",
    "customer_id": "bigint",
    "invoice_ts": "timestamp_ntz",
    "country": "string",
    "quantity": "bigint",
    "amount_txt": "string",
}
_ROW = "invoice_no, customer_id, invoice_ts, country, quantity"
_CLEAN_ROW = f"{_ROW}, CAST(amount AS DOUBLE) AS amount"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip().rstrip(',')}\n{select}"


def _per_column(select: str) -> str:
    return " UNION ALL ".join(select.format(column=c, type=t) for c, t in _RAW_TYPES.items())


def _counts(scope: str) -> str:
    return _with(_COHORT, f"SELECT cohort_month, cohort_index, customers FROM counts WHERE scope = '{scope}'")


def _rates(scope: str, select: str = "cohort_month, cohort_index, customers, cohort_size, rate") -> str:
    return _with(_COHORT, f"SELECT {select} FROM rates WHERE scope = '{scope}'")


def _pivot(scope: str) -> str:
    cells = ", ".join(
        f'CAST(max(customers) FILTER (WHERE cohort_index = {i}) AS DOUBLE) AS "{i}"' for i in range(1, 81)
    )
    return _with(_COHORT, f"SELECT cohort_month, {cells} FROM counts WHERE scope = '{scope}' GROUP BY cohort_month")


def _wide(scope: str, places: int | None = None) -> str:
    rate = "max(rate) FILTER (WHERE cohort_index = {i})"
    cell = rate if places is None else f"round_even({rate}, {places})"
    cells = ", ".join(f'{cell.format(i=i)} AS "{i}"' for i in range(1, 81))
    return _with(_COHORT, f"SELECT cohort_month, {cells} FROM rates WHERE scope = '{scope}' GROUP BY cohort_month")


def _bars(revenue: str) -> str:
    return (
        f"CAST(customers AS DOUBLE) / max(customers) OVER () AS \"Clientes_bar\", "
        f"{revenue} / max({revenue}) OVER () AS \"Faturamento_bar\", {_currency(revenue)} AS \"Faturamento_text\""
    )


_SIDE_MONTHLY = (
    _CLEAN
    + """
side_monthly AS (
  SELECT is_home, month, count(DISTINCT invoice_no) AS invoices, count(DISTINCT customer_id) AS customers,
    CAST(sum(quantity) AS BIGINT) AS items, CAST(sum(amount) AS DOUBLE) AS revenue
  FROM clean GROUP BY is_home, month),
"""
)


def _currency(column: str) -> str:
    return f"format('£{{:,.2f}}', {column})"


_PERCENT = "printf('%.0f', rate * 100) || '%'"
_INTENSITY = "CASE WHEN rate > 0.5 THEN 0.5 WHEN rate < 0 THEN 0.0 ELSE rate END / 0.5"

_DIRTY = _SALES + """
dirty AS (
  SELECT invoice_no, customer_id, country, quantity, invoice_ts AS ts, amount_txt AS amount_of,
    CASE WHEN CAST(invoice_no AS BIGINT) % 13 = 0 THEN strftime(invoice_ts, '%Y-%m-%d')
         ELSE strftime(invoice_ts, '%d/%m/%Y %H:%M') END AS invoice_ts,
    CASE WHEN CAST(invoice_no AS BIGINT) % 17 = 0 THEN '1.' || amount_txt ELSE amount_txt END AS amount_txt,
    concat_ws(',', CASE WHEN CAST(invoice_no AS BIGINT) % 13 = 0 THEN 'bad_date' END,
      CASE WHEN CAST(invoice_no AS BIGINT) % 17 = 0 THEN 'bad_amount' END) AS reason
  FROM sales),
whole AS (
  SELECT DISTINCT * FROM dirty
  WHERE quantity >= 0 AND invoice_no IS NOT NULL AND customer_id IS NOT NULL AND ts IS NOT NULL AND country IS NOT NULL),
"""

ORACLE = {
    "sink_month_restated": _with(_CLEAN, f"SELECT {_CLEAN_ROW}, month, is_home FROM clean"),
    "profile_stored": _with(
        _SALES,
        _per_column(
            "SELECT '{column}' AS \"column\", '{type}' AS type, count({column}) AS non_null, count(*) AS rows "
            "FROM sales"
        ),
    ),
    "drop_duplicates_by_digest": _with(_SALES, "SELECT DISTINCT * FROM sales"),
    "quarantine_rejects": _with(
        _DIRTY,
        "SELECT invoice_no, customer_id, invoice_ts, country, quantity, amount_txt, reason FROM whole WHERE reason <> ''",
    ),
    "quarantine_accepted": _with(
        _DIRTY,
        "SELECT invoice_no, customer_id, date_trunc('minute', ts) AS invoice_ts, country, quantity, "
        "CAST(replace(amount_of, ',', '.') AS DOUBLE) AS amount, CAST(date_trunc('month', ts) AS DATE) AS month, "
        f"country = '{HOME_COUNTRY}' AS is_home FROM whole WHERE reason = ''",
    ),
    "country_customers_merged": _with(
        _CLEAN, "SELECT country, count(DISTINCT customer_id) AS customers FROM clean GROUP BY country"
    ),
    "monthly_customers_merged": _with(
        _CLEAN, "SELECT month, count(DISTINCT customer_id) AS customers FROM clean GROUP BY month"
    ),
    "scan_sales": _with(
        _SALES,
        "SELECT invoice_no, customer_id, strftime(invoice_ts, '%d/%m/%Y %H:%M') AS invoice_ts, country, quantity, "
        "amount_txt FROM sales",
    ),
    "scan_segments": _with(
        _SCORED, "SELECT rfm_code AS rfm, category, count(*) AS customers FROM labelled GROUP BY ALL"
    ),
    "sink_report": _with(_MONTHLY, "SELECT * FROM monthly"),
    "profile_columns": _with(
        _SALES,
        _per_column(
            "SELECT '{column}' AS \"column\", '{type}' AS type, count({column}) AS non_null, count(*) AS rows "
            "FROM sales"
        ),
    ),
    "profile_shape": _with(
        _CLEAN,
        f"SELECT count(*) AS rows, 6 AS columns, printf('{SHAPE_SENTENCE}', count(*), 6) AS sentence FROM clean",
    ),
    "profile_missing": _with(
        _SALES, _per_column("SELECT '{column}' AS \"column\", count(*) - count({column}) AS missing FROM sales")
    ),
    "audit_zero_amount": _with(
        _CLEAN,
        "SELECT count(*) FILTER (WHERE amount = 0) AS zero_rows, count(*) AS rows, "
        "CAST(count(*) FILTER (WHERE amount = 0) AS DOUBLE) / count(*) AS zero_share FROM clean",
    ),
    "preview": _with(
        _CLEAN, f"SELECT {_CLEAN_ROW}, month, is_home FROM clean ORDER BY invoice_no, customer_id LIMIT 10"
    ),
    "drop_negative": _with(_SALES, "SELECT * FROM sales WHERE quantity IS NULL OR quantity >= 0"),
    "drop_duplicates": _with(_SALES, "SELECT DISTINCT * FROM sales"),
    "drop_missing": _with(
        _SALES, "SELECT * FROM sales WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _RAW_TYPES)
    ),
    "parse_invoice_ts": _with(
        _SALES,
        "SELECT invoice_no, ts_txt, strptime(ts_txt, '%d/%m/%Y %H:%M') AS parsed_ts "
        "FROM (SELECT invoice_no, strftime(invoice_ts, '%d/%m/%Y %H:%M') AS ts_txt FROM sales)",
    ),
    "parse_decimal_comma": _with(
        _SALES,
        "SELECT invoice_no, amount_txt, CAST(replace(amount_txt, ',', '.') AS DOUBLE) AS amount FROM sales",
    ),
    "clean_sales": _with(_CLEAN, f"SELECT {_CLEAN_ROW} FROM clean"),
    "clean_audit": _with(
        _CLEAN,
        "SELECT CAST(position AS INTEGER) AS position, step, rows, "
        "coalesce(lag(rows) OVER (ORDER BY position) - rows, 0) AS removed FROM ("
        "SELECT 1 AS position, 'raw' AS step, count(*) AS rows FROM sales "
        "UNION ALL SELECT 2, 'drop_negative', count(*) FROM sales WHERE quantity IS NULL OR quantity >= 0 "
        "UNION ALL SELECT 3, 'drop_duplicates', count(*) FROM kept "
        "UNION ALL SELECT 4, 'drop_missing', count(*) FROM clean)",
    ),
    "clean_audit_observed": _with(
        _CLEAN,
        "SELECT CAST(position AS INTEGER) AS position, step, rows, "
        "coalesce(lag(rows) OVER (ORDER BY position) - rows, 0) AS removed FROM ("
        "SELECT 1 AS position, 'raw' AS step, count(*) AS rows FROM sales "
        "UNION ALL SELECT 2, 'drop_negative', count(*) FROM sales WHERE quantity IS NULL OR quantity >= 0 "
        "UNION ALL SELECT 3, 'drop_duplicates', count(*) FROM kept "
        "UNION ALL SELECT 4, 'drop_missing', count(*) FROM clean)",
    ),
    "month_floor": _with(_CLEAN, "SELECT invoice_no, invoice_ts, month FROM clean"),
    "date_parts": _with(
        _CLEAN,
        "SELECT invoice_no, CAST(year(invoice_ts) AS INTEGER) AS year, "
        "CAST(month(invoice_ts) AS INTEGER) AS month_of_year, CAST(day(invoice_ts) AS INTEGER) AS day FROM clean",
    ),
    "assign_cohort": _with(_COHORT, "SELECT invoice_no, customer_id, month, cohort_month FROM cohorted"),
    "cohort_index": _with(_COHORT, "SELECT invoice_no, cohort_month, cohort_index FROM cohorted"),
    "home_flag": _with(_CLEAN, "SELECT invoice_no, country, is_home FROM clean"),
    "recency_days": _with(_BASE, "SELECT customer_id, last_ts, recency FROM rfm"),
    "rfm_code": _with(_SCORED, "SELECT customer_id, rfm_code FROM labelled"),
    "cast_types": _with(
        _SCORED,
        "SELECT customer_id, CAST(frequency AS VARCHAR) AS frequency_txt, CAST(rfm_code AS INTEGER) AS code_number, "
        "CAST(monetary AS DOUBLE) AS spend FROM labelled",
    ),
    "rename_columns": _with(
        _COUNTRY,
        'SELECT country AS "Pais", customers AS "Clientes", invoices AS "Vendas", min_amount AS "ValorMinimo", '
        'max_amount AS "ValorMaximo", mean_amount AS "ValorMedia", revenue AS "Faturamento", items AS "ItensVendidos" '
        "FROM panorama",
    ),
    "drop_column": _with(_SCORED, "SELECT customer_id, rfm_code, category FROM labelled"),
    "month_label": _with(
        _COHORT,
        "SELECT strftime(cohort_month, '%Y-%m') AS cohort, cohort_index, customers FROM counts WHERE scope = 'all'",
    ),
    "round_rate": _rates("all", "cohort_month, cohort_index, round_even(rate, 3) AS rate_3"),
    "format_currency": _with(
        _COUNTRY,
        "SELECT country, "
        + ", ".join(f"{_currency(c)} AS {c}_text" for c in ("min_amount", "max_amount", "mean_amount", "revenue"))
        + " FROM panorama",
    ),
    "format_percent": _rates("all", f"cohort_month, cohort_index, {_PERCENT} AS label"),
    "bar_fraction": _with(
        _COUNTRY,
        "SELECT country, revenue / max(revenue) OVER () AS revenue_bar, "
        "CAST(customers AS DOUBLE) / max(customers) OVER () AS customers_bar FROM panorama",
    ),
    "heat_intensity": _rates("all", f"cohort_month, cohort_index, {_INTENSITY} AS intensity"),
    "join_segments": _with(_SCORED, "SELECT customer_id, rfm_code, rfm_code AS rfm, category FROM labelled"),
    "cohort_size_join": _rates("all"),
    "country_panorama": _with(_COUNTRY, "SELECT * FROM panorama ORDER BY revenue DESC, country"),
    "monthly_sales": _with(_MONTHLY, "SELECT * FROM monthly ORDER BY month"),
    "cohort_counts": _counts("all"),
    "cohort_counts_home": _counts("home"),
    "cohort_counts_away": _counts("away"),
    "rfm_base": _with(
        _BASE, "SELECT customer_id, last_ts, first_ts, frequency, CAST(monetary AS DOUBLE) AS monetary FROM base"
    ),
    "rfm_edges": _with(_SCORED, "SELECT * FROM edges"),
    "rfm_scores": _with(
        _SCORED,
        "SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, r, f, m FROM scored",
    ),
    "segment_summary": _with(
        _SCORED,
        "SELECT category, customers, CAST(revenue AS DOUBLE) AS revenue FROM summary ORDER BY revenue DESC, category",
    ),
    "cohort_pivot": _pivot("all"),
    "cohort_pivot_home": _pivot("home"),
    "cohort_pivot_away": _pivot("away"),
    "retention": _rates("all"),
    "retention_home": _rates("home"),
    "retention_away": _rates("away"),
    "share_of_total": _with(
        _SCORED,
        "SELECT category, customers, CAST(customers AS DOUBLE) / sum(customers) OVER () AS share FROM summary",
    ),
    "peak_month": _with(_MONTHLY, "SELECT * FROM monthly ORDER BY invoices DESC, month LIMIT 1"),
    "top_customers": _with(
        _BASE,
        "SELECT customer_id, last_ts, first_ts, frequency, CAST(monetary AS DOUBLE) AS monetary FROM base "
        "ORDER BY base.monetary DESC, customer_id LIMIT 10",
    ),
    "split_home": _with(_CLEAN, f"SELECT {_CLEAN_ROW}, month, is_home FROM clean WHERE is_home"),
    "split_away": _with(_CLEAN, f"SELECT {_CLEAN_ROW}, month, is_home FROM clean WHERE NOT is_home"),
    "avg_month_revenue": _with(
        _CLEAN,
        "SELECT CAST(sum(amount) AS DOUBLE) AS revenue, count(DISTINCT month) AS months, "
        "CAST(sum(amount) AS DOUBLE) / count(DISTINCT month) AS avg_month_revenue FROM clean",
    ),
    "avg_customer_spend": _with(
        _CLEAN,
        "SELECT customers, revenue, avg_customer_spend FROM (" + _KPIS.format(by="", group="") + ")",
    ),
    "repeat_rate": _with(
        _CLEAN, "SELECT customers, repeat_customers, repeat_rate FROM (" + _KPIS.format(by="", group="") + ")"
    ),
    "kpis_by_home": _with(
        _CLEAN,
        "SELECT * FROM ("
        + _KPIS.format(by="is_home,", group="GROUP BY is_home")
        + ") JOIN (SELECT is_home, count(DISTINCT month) AS months, "
        "CAST(sum(amount) AS DOUBLE) / count(DISTINCT month) AS avg_month_revenue FROM clean GROUP BY is_home) "
        "USING (is_home)",
    ),
    "pareto_curve": _with(
        _CURVE,
        "SELECT CAST(monetary AS DOUBLE) AS monetary, customers, top_customers, "
        "CAST(top_revenue AS DOUBLE) AS top_revenue, all_customers, CAST(all_revenue AS DOUBLE) AS all_revenue "
        "FROM curve",
    ),
    "pareto_customers": _with(
        _BASE,
        "SELECT percent, CAST(percent * n // 100 AS BIGINT) AS customers, "
        "CAST(coalesce(upto, 0) AS DOUBLE) AS revenue, "
        "CAST(coalesce(upto, 0) AS DOUBLE) / CAST(total AS DOUBLE) AS revenue_share "
        "FROM range(1, 101) AS p(percent) CROSS JOIN (SELECT count(*) AS n, sum(monetary) AS total FROM base) "
        "LEFT JOIN (SELECT row_number() OVER (ORDER BY monetary DESC, customer_id) AS position, "
        "sum(monetary) OVER (ORDER BY monetary DESC, customer_id ROWS UNBOUNDED PRECEDING) AS upto FROM base) "
        "ON position = percent * n // 100",
    ),
    "segment_cum_share": _with(
        _SCORED,
        "SELECT category, CAST(revenue AS DOUBLE) AS revenue, "
        "CAST(row_number() OVER (ORDER BY summary.revenue DESC, category) AS INTEGER) AS position, "
        "CAST(sum(summary.revenue) OVER (ORDER BY summary.revenue DESC, category ROWS UNBOUNDED PRECEDING) AS DOUBLE) "
        "/ CAST(sum(summary.revenue) OVER () AS DOUBLE) AS cum_share FROM summary",
    ),
    "retention_drop": _with(
        _COHORT,
        "SELECT now.cohort_month, now.cohort_index, now.rate, now.rate - before.rate AS change FROM rates AS now "
        "LEFT JOIN rates AS before ON before.scope = now.scope AND before.cohort_month = now.cohort_month "
        "AND before.cohort_index = now.cohort_index - 1 WHERE now.scope = 'all'",
    ),
    "weakest_cohort": _with(
        _COHORT,
        "SELECT cohort_month, cohort_size, CAST(sum(customers) AS BIGINT) AS later_customers, "
        "count(*) AS later_months, CAST(sum(customers) AS DOUBLE) / (cohort_size * count(*)) AS mean_rate "
        "FROM rates WHERE scope = 'all' AND cohort_index >= 2 AND cohort_size IS NOT NULL "
        "GROUP BY cohort_month, cohort_size ORDER BY mean_rate, cohort_month LIMIT 1",
    ),
    "monthly_sales_from_csv": _with(_MONTHLY, "SELECT * FROM monthly"),
    "monthly_sales_by_home": _with(_SIDE_MONTHLY, "SELECT * FROM side_monthly"),
    "peak_month_by_home": _with(
        _SIDE_MONTHLY,
        "SELECT * FROM side_monthly QUALIFY row_number() OVER (PARTITION BY is_home ORDER BY invoices DESC, month) = 1",
    ),
    "top_customers_by_home": _with(
        _CLEAN,
        "SELECT customer_id, is_home, last_ts, first_ts, frequency, CAST(monetary AS DOUBLE) AS monetary FROM ("
        "SELECT customer_id, is_home, max(invoice_ts) AS last_ts, min(invoice_ts) AS first_ts, "
        "count(invoice_no) AS frequency, sum(amount) AS monetary FROM clean GROUP BY customer_id, is_home) AS side "
        "QUALIFY row_number() OVER (PARTITION BY is_home ORDER BY side.monetary DESC, customer_id) <= 10",
    ),
    "retention_wide": _wide("all"),
    "retention_wide_home": _wide("home"),
    "retention_wide_away": _wide("away"),
    "retention_wide_rounded": _wide("all", 3),
    "retention_wide_rounded_home": _wide("home", 3),
    "retention_wide_rounded_away": _wide("away", 3),
    "month_table": _with(
        _MONTHLY,
        'SELECT month AS "Mes-Ano", invoices AS "Vendas", customers AS "Clientes", items AS "ProdutosVendidos", '
        f'revenue AS "Faturamento", {_bars("revenue")} FROM monthly',
    ),
    "segment_table": _with(
        _SCORED,
        'SELECT category AS "Categoria", customers AS "Clientes", CAST(revenue AS DOUBLE) AS "Faturamento", '
        f'{_bars("CAST(revenue AS DOUBLE)")} FROM summary',
    ),
    "segments_by_home": _with(
        _SCORED,
        "SELECT is_home, category, customers, CAST(revenue AS DOUBLE) AS revenue, "
        "CAST(customers AS DOUBLE) / sum(customers) OVER (PARTITION BY is_home) AS customer_share, "
        "CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY is_home) AS DOUBLE) AS revenue_share "
        "FROM (SELECT is_home, category, count(DISTINCT customer_id) AS customers, sum(amount) AS revenue "
        "FROM clean JOIN labelled USING (customer_id) GROUP BY is_home, category)",
    ),
    "new_vs_returning": _with(
        _COHORT,
        "SELECT month, count(DISTINCT invoice_no) AS invoices, "
        "count(DISTINCT customer_id) FILTER (WHERE cohort_index = 1) AS new_customers, "
        "count(DISTINCT customer_id) FILTER (WHERE cohort_index > 1) AS returning_customers, "
        "CAST(count(DISTINCT invoice_no) AS DOUBLE) / count(DISTINCT customer_id) AS invoices_per_customer "
        "FROM cohorted GROUP BY month",
    ),
    "partial_period_flag": _with(
        _CLEAN,
        "SELECT month, last_ts, last_ts = max(last_ts) OVER () AND CAST(last_ts AS DATE) < last_day(month) "
        "AS is_partial FROM (SELECT month, max(invoice_ts) AS last_ts FROM clean GROUP BY month)",
    ),
    "series_monthly": _with(
        _MONTHLY,
        "SELECT month, 'invoices' AS series, invoices AS value FROM monthly "
        "UNION ALL SELECT month, 'customers', customers FROM monthly",
    ),
    "series_items": _with(_MONTHLY, "SELECT month, items FROM monthly"),
    "heatmap_cells": _with(
        _COHORT,
        "SELECT scope, strftime(cohort_month, '%Y-%m') AS cohort, cohort_index, rate, "
        f"{_PERCENT} AS label, {_INTENSITY} AS intensity FROM rates",
    ),
    "treemap_cells": _with(
        _SCORED,
        "SELECT category, customers, CAST(customers AS DOUBLE) / sum(customers) OVER () AS share FROM summary",
    ),
}
