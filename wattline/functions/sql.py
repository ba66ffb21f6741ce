"""Functions callable from SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Each body is plain SQL, so Catalyst inlines it into the calling plan.
SQL_FUNCTIONS = {
    "date_key_of": "(t TIMESTAMP) RETURNS INT RETURN CAST(year(t) * 10000 + month(t) * 100 + day(t) AS INT)",
    "season_of": (
        "(t TIMESTAMP) RETURNS STRING RETURN CASE WHEN month(t) IN (12, 1, 2) THEN 'winter' "
        "WHEN month(t) <= 5 THEN 'spring' WHEN month(t) <= 8 THEN 'summer' ELSE 'autumn' END"
    ),
    "severity_of": (
        "(z DOUBLE, threshold DOUBLE) RETURNS STRING RETURN CASE WHEN z > threshold * 2 THEN 'high' "
        "WHEN z > threshold * 1.5 THEN 'medium' ELSE 'low' END"
    ),
}


def register(spark: SparkSession) -> None:
    """Make the date-key, season and severity helpers available to ``spark.sql``."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
