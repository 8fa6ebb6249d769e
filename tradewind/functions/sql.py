"""The library's column functions for SQL users, as temporary SQL functions: their bodies become part of the plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "tw_band": """(value DOUBLE, limits ARRAY<DOUBLE>) RETURNS INT
        COMMENT '0 above the first limit, 1 above the second, ...; as many as there are limits at or below the last'
        RETURN CASE WHEN value IS NOT NULL THEN size(filter(limits, x -> value <= x)) END""",
    "tw_pick": """(number INT, choices ARRAY<STRING>) RETURNS STRING
        COMMENT 'the entry of a list at a band number'
        RETURN element_at(choices, number + 1)""",
    "tw_cents": """(price DOUBLE) RETURNS BIGINT
        COMMENT 'whole cents of a price; one with fractions of a cent fails the query'
        RETURN CASE WHEN price IS NULL THEN NULL
            WHEN abs(price * 100) <= 1e14 AND abs(price * 100 - floor(price * 100 + 0.5)) < 0.05
            THEN CAST(floor(price * 100 + 0.5) AS BIGINT)
            ELSE CAST(raise_error(concat('no price in whole cents: ', CAST(price AS STRING))) AS BIGINT) END""",
    "tw_month_start": """(day DATE) RETURNS DATE
        COMMENT 'first day of the month'
        RETURN trunc(day, 'MM')""",
    "tw_month_label": """(month INT) RETURNS STRING
        COMMENT 'Jan ... Dec for 1 ... 12'
        RETURN date_format(make_date(2000, month, 1), 'MMM')""",
    "tw_months": """(first_day DATE, last_day DATE) RETURNS TABLE (month DATE)
        COMMENT 'first days of all months from one day to another'
        RETURN SELECT explode(sequence(trunc(first_day, 'MM'), trunc(last_day, 'MM'), interval 1 month))""",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to a session; returns their names."""
    for name, definition in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition}")
    return list(FUNCTIONS)
