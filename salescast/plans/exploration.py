"""Exploration as SQL text over the contract tables, with named parameters.

``{sales}`` and its like stand for DataFrames or catalog tables, ``:name`` for a parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

UNITS = """
SELECT {column}, CAST(SUM(sales) AS BIGINT) AS total_units
FROM {{sales}} GROUP BY {column} ORDER BY total_units DESC, {column}
"""
STATEMENTS = {
    "scale": "SELECT COUNT(DISTINCT id) AS n_series, COUNT(DISTINCT d) AS n_days, COUNT(*) AS n_rows FROM {sales}",
    "zero_share": "SELECT AVG(IF(sales = 0, 1.0D, 0.0D)) AS zero_sales_share FROM {sales}",
    "units_state": UNITS.format(column="state_id"),
    "units_store": UNITS.format(column="store_id"),
    "units_cat": UNITS.format(column="cat_id"),
    "units_dept": UNITS.format(column="dept_id"),
    "top_series": UNITS.format(column="id") + "LIMIT :top",
    "daily_units": """
SELECT s.d, c.date, CAST(SUM(s.sales) AS BIGINT) AS total_units
FROM {sales} s JOIN {calendar} c ON c.day = s.d
WHERE :state = '' OR s.state_id = :state GROUP BY s.d, c.date
""",
}


def explore(spark: SparkSession, name: str, tables: dict[str, DataFrame], **parameters) -> DataFrame:
    """Run one statement over the given tables."""
    text = STATEMENTS[name]
    used = {k: v for k, v in tables.items() if "{" + k + "}" in text}
    return spark.sql(text, args={k: v for k, v in parameters.items() if f":{k}" in text}, **used)
