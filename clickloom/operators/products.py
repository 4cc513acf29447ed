"""Most clicked products per area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import concat_long_string, group_concat_distinct, json_field
from clickloom.operators.chunks import CHUNK_BYTES, chunked_values
from clickloom.operators.ranking import top_n_per_group

# Level by area; every other area has the last level.
AREA_LEVELS = {
    "China North": "A Level",
    "China East": "A Level",
    "China South": "B Level",
    "China Middle": "B Level",
    "West North": "C Level",
    "West South": "C Level",
}
OTHER_LEVEL = "D Level"

PRODUCT_STATUS = {"0": "Self"}
OTHER_STATUS = "Third Party"


def _lookup(value: Column, table: dict[str, str], default: str) -> Column:
    by_result: dict[str, list[str]] = {}
    for key, result in table.items():
        by_result.setdefault(result, []).append(key)
    chain = F
    for result, keys in by_result.items():
        chain = chain.when(value.isin(keys), result)
    return chain.otherwise(default)


def area_level(area: Column, levels: dict[str, str] | None = None) -> Column:
    return _lookup(area, AREA_LEVELS if levels is None else levels, OTHER_LEVEL)


def product_status(extend_info: Column) -> Column:
    """Own or third-party goods by the JSON field; missing or broken means third party."""
    return _lookup(json_field(extend_info, "product_status"), PRODUCT_STATUS, OTHER_STATUS)


def _city_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks per (area, product, city), the city as ``id:name``.

    Clicks are counted per (city, product) before they meet the cities. The join and all later
    steps then see at most cities times products rows, whatever the number of clicks and
    however they are spread over the cities.
    """
    per_city = clicks.groupBy("city_id", "product_id").agg(F.count("*").alias("_clicks"))
    return per_city.join(cities, "city_id").select(
        "area", "product_id", "_clicks",
        concat_long_string(F.col("city_id"), F.col("city_name")).alias("_city"),
    )


def area_product_clicks(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and the list of cities (``id:name``) per (area, product)."""
    return (
        _city_clicks(clicks, cities)
        .groupBy("area", "product_id")
        .agg(
            F.sum("_clicks").alias("click_count"),
            group_concat_distinct("_city").alias("city_infos"),
        )
    )


def area_product_city_chunks(
    clicks: DataFrame, cities: DataFrame, chunk_bytes: int = CHUNK_BYTES, **detect
) -> DataFrame:
    """The city lists of :func:`area_product_clicks` as texts of bounded size, for catalogs in which
    a list outgrows its row: area, product_id, chunk, position, city_infos."""
    chunks = chunked_values(_city_clicks(clicks, cities), ["area", "product_id"], "_city", chunk_bytes, **detect)
    return chunks.select("area", "product_id", "chunk", "position", F.array_join("values", ",").alias("city_infos"))


def area_top_products(
    area_clicks: DataFrame,
    products: DataFrame,
    n: int = 3,
    levels: dict[str, str] | None = None,
) -> DataFrame:
    """The ``n`` most clicked known products of each area with name, status and area level."""
    named = area_clicks.join(products, "product_id").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "extend_info",
    )
    # The status is read from its JSON only for the products that are listed.
    top = top_n_per_group(named, "area", [F.desc("click_count"), F.asc("product_id")], n)
    return top.select(
        "area", area_level(F.col("area"), levels).alias("area_level"), "product_id",
        "click_count", "city_infos", "product_name",
        product_status(F.col("extend_info")).alias("product_status"),
    )
