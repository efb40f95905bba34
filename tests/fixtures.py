"""Small hand-made inputs."""

from datetime import date
from decimal import Decimal

from shelfwise.operators.cleaning import add_age, add_date_parts, add_sale_id
from shelfwise.schema import FACT_COLUMNS, RAW_COLUMNS, RAW_SCHEMA

RAW_DEFAULTS = {
    "item_identifier": "FDX32", "item_weight": "10.5", "item_fat_content": "Low Fat", "item_visibility": "0.05",
    "item_type": "Dairy", "outlet_identifier": "OUT010", "outlet_establishment_year": "1998", "outlet_size": "Small",
    "outlet_location_type": "Tier 1", "outlet_type": "Grocery Store", "sales": "100.0000", "rating": "4.0",
    "order_date": "2022-03-05",
}


def raw(spark, *rows: dict):
    return spark.createDataFrame([tuple({**RAW_DEFAULTS, **r}[c] for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


TYPED = (
    "item_identifier string, item_weight decimal(6,3), item_fat_content string, item_visibility decimal(9,6), "
    "item_type string, outlet_identifier string, outlet_establishment_year int, outlet_size string, "
    "outlet_location_type string, outlet_type string, sales decimal(10,4), rating decimal(3,2), order_date date, "
    "item_weight_imputed int, item_visibility_imputed int")


def fact(spark, *rows: dict):
    defaults = {**RAW_DEFAULTS, "item_weight_imputed": 0, "item_visibility_imputed": 0}

    def typed(name, value):
        if value is None:
            return None
        if name in ("item_weight", "item_visibility", "sales", "rating"):
            return Decimal(str(value))
        if name == "order_date":
            return date.fromisoformat(value)
        return int(value) if name.endswith(("_year", "imputed")) else value

    names = [*RAW_COLUMNS, "item_weight_imputed", "item_visibility_imputed"]
    data = [tuple(typed(c, {**defaults, **r}[c]) for c in names) for r in rows]
    frame = spark.createDataFrame(data, TYPED)
    return frame.transform(add_age).transform(add_date_parts).transform(add_sale_id).select(FACT_COLUMNS)
