"""The scalar functions by name for SQL text. They are SQL functions: Catalyst inlines their
bodies, so calling them costs no more than writing the expression out."""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "concat_long_string": (
        "num BIGINT, txt STRING, sep STRING",
        "concat(coalesce(cast(num AS STRING), 'null'), sep, coalesce(txt, 'null'))",
    ),
    "json_field": ("doc STRING, field STRING", "get_json_object(doc, concat('$.', field))"),
    "random_prefix": (
        "val STRING, n INT",
        "concat(cast(floor(rand() * n) AS STRING), '_', val)",
    ),
    "remove_random_prefix": ("val STRING", "regexp_replace(val, '^[0-9]+_', '')"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (params, body) in _FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS STRING RETURN {body}"
        )
    return list(_FUNCTIONS)
