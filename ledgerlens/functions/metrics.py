"""Financial metrics found in report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.expr import as_column

# Where each metric stands in lower-cased text; the first match counts.
METRIC_PATTERNS = {
    "revenue_dollar": r"\$?\s*(\d+(?:\.\d+)?)\s*(?:million|billion|m|b)?\s*(?:in)?\s*(?:revenue|sales)",
    "profit_dollar": r"\$?\s*(\d+(?:\.\d+)?)\s*(?:million|billion|m|b)?\s*(?:in)?\s*(?:profit|net income)",
    "eps_dollar": r"(?:earnings per share|eps).{1,50}?\$?\s*(\d+\.\d+)",
    "growth_percentage": r"(?:growth|increase).{1,20}?\s*(\d+(?:\.\d+)?)\s*%",
    "margin_percentage": r"(?:margin).{1,20}?\s*(\d+(?:\.\d+)?)\s*%",
}


def financial_metrics(text: Column | str) -> dict[str, Column]:
    """One nullable text column per metric."""
    low = F.lower(as_column(text))
    return {
        name: F.nullif(F.regexp_extract(low, pattern, 1), F.lit("")).alias(name)
        for name, pattern in METRIC_PATTERNS.items()
    }


def metric_group(metric: Column | str) -> Column:
    """Dollar amounts, percentages and the rest, by the name of the metric."""
    col = as_column(metric)
    return F.when(col.contains("dollar"), "dollar").when(col.contains("percentage"), "percentage").otherwise("other")


def metric_number(value: Column | str) -> Column:
    """Number in a metric text; NULL when it does not read as one."""
    return F.regexp_replace(as_column(value), "[$%BM]", "").try_cast("double")


def metric_label(metric: Column | str) -> Column:
    """Title of a metric: ``eps_dollar`` becomes ``Eps Dollar``."""
    return F.initcap(F.replace(as_column(metric), F.lit("_"), F.lit(" ")))
