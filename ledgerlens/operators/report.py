"""Tables behind tables and charts: display text, bars, cells, series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ledgerlens.functions.dates import month_label
from ledgerlens.functions.numbers import format_currency, format_percent, heat_intensity, round_rate
from ledgerlens.operators.cohort import cohort_counts_by_scope, cohort_pivot, retention
from ledgerlens.operators.metrics import ratio
from ledgerlens.operators.rfm import share_of_total

# Column headings of the three report tables, in order.
COUNTRY_HEADINGS = [
    "Pais",
    "Clientes",
    "Vendas",
    "ValorMinimo",
    "ValorMaximo",
    "ValorMedia",
    "Faturamento",
    "ItensVendidos",
]
MONTH_HEADINGS = ["Mes-Ano", "Vendas", "Clientes", "ProdutosVendidos", "Faturamento"]
SEGMENT_HEADINGS = ["Categoria", "Clientes", "Faturamento"]


def rename_columns(df: DataFrame, headings: list[str]) -> DataFrame:
    """Replace all column names, by position."""
    return df.toDF(*headings)


def decimals_to_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for the edge of the system."""
    return df.select(
        *[F.col(f"`{c}`").cast("double").alias(c) if t.startswith("decimal") else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def with_currency_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_text": format_currency(c) for c in columns})


def bar_fraction(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add each column divided by its maximum. For small results."""
    whole = W.partitionBy()
    return df.withColumns({f"{c}_bar": ratio(c, F.max(c).over(whole)) for c in columns})


def month_table(monthly: DataFrame) -> DataFrame:
    """Monthly sales under their headings, with revenue as text and bars."""
    return _table(monthly.select("month", "invoices", "customers", "items", "revenue"), MONTH_HEADINGS)


def segment_table(summary: DataFrame) -> DataFrame:
    """Segments under their headings, with revenue as text and bars."""
    return _table(summary.select("category", "customers", "revenue"), SEGMENT_HEADINGS)


def _table(df: DataFrame, headings: list[str]) -> DataFrame:
    """Under ``headings``, with the last column as text and bars of customers and of it."""
    table = rename_columns(df, headings)
    customers, revenue = "Clientes", headings[-1]
    return with_currency_text(bar_fraction(table, [customers, revenue]), [revenue])


def retention_wide(rates: DataFrame, indexes: Sequence[int], places: int | None = None) -> DataFrame:
    """Cohorts as rows, their rates by index as columns, rounded to ``places`` for display."""
    wide = cohort_pivot(rates, "rate", indexes)
    if places is None:
        return wide
    return wide.select("cohort_month", *[round_rate(f"`{i}`", places).alias(str(i)) for i in indexes])


def heatmap_cells(months: DataFrame) -> DataFrame:
    """Retention cells of the three heat maps, from one pass over customers."""
    rates = retention(cohort_counts_by_scope(months), by=["scope"])
    return rates.select(
        "scope",
        month_label("cohort_month").alias("cohort"),
        "cohort_index",
        "rate",
        format_percent("rate").alias("label"),
        heat_intensity("rate").alias("intensity"),
    )


def treemap_cells(summary: DataFrame) -> DataFrame:
    """Segment, customers, share of all customers (the area)."""
    return share_of_total(summary, "customers").select("category", "customers", "share")


def series_monthly(monthly: DataFrame) -> DataFrame:
    """Invoices and customers per month in long form, for a line chart."""
    return monthly.unpivot(["month"], ["invoices", "customers"], "series", "value")


def series_items(monthly: DataFrame) -> DataFrame:
    return monthly.select("month", "items")
