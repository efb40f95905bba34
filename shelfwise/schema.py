"""Column names, types and integrity rules of the raw extract and the fact table."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the raw extract and the column it fills, in file order.
RAW_HEADER = {
    "Item Identifier": "item_identifier",
    "Item Weight": "item_weight",
    "Item Fat Content": "item_fat_content",
    "Item Visibility": "item_visibility",
    "Item Type": "item_type",
    "Outlet Identifier": "outlet_identifier",
    "Outlet Establishment Year": "outlet_establishment_year",
    "Outlet Size": "outlet_size",
    "Outlet Location Type": "outlet_location_type",
    "Outlet Type": "outlet_type",
    "Sales": "sales",
    "Rating": "rating",
    "Order Date": "order_date",
}
RAW_COLUMNS = list(RAW_HEADER.values())
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# The stored type, the declared type and the role of every raw column.
COLUMN_ROLES = {
    "item_identifier": ("text", "VARCHAR(10)", "Product key (dimension)"),
    "item_weight": ("text w/ blanks", "DECIMAL(6,3)", "Product attribute"),
    "item_fat_content": ("text", "VARCHAR(10)", "Category (needs cleaning)"),
    "item_visibility": ("text", "DECIMAL(9,6)", "Shelf-share metric"),
    "item_type": ("text", "VARCHAR(40)", "Category (dimension)"),
    "outlet_identifier": ("text", "CHAR(6)", "Store key (dimension)"),
    "outlet_establishment_year": ("text", "SMALLINT", "Store attribute"),
    "outlet_size": ("text w/ blanks", "VARCHAR(10)", "Category (dimension)"),
    "outlet_location_type": ("text", "VARCHAR(10)", "Category (dimension)"),
    "outlet_type": ("text", "VARCHAR(25)", "Category (dimension)"),
    "sales": ("text", "DECIMAL(10,4)", "Primary measure (INR)"),
    "rating": ("text", "DECIMAL(3,2)", "Measure (1-5 scale)"),
    "order_date": ("text", "DATE", "Time dimension"),
}

# Canonical label of every known fat-content spelling, upper-cased.
FAT_CONTENT_LABELS = {
    "LF": "Low Fat",
    "LOW FAT": "Low Fat",
    "REG": "Regular",
    "REGULAR": "Regular",
}

# Allowed labels of the enumerated columns.
ALLOWED_VALUES = {
    "item_fat_content": ["Low Fat", "Regular"],
    "outlet_size": ["Small", "Medium", "High", "Unknown"],
    "outlet_location_type": ["Tier 1", "Tier 2", "Tier 3"],
    "outlet_type": ["Grocery Store", "Supermarket Type1", "Supermarket Type2", "Supermarket Type3"],
}

# Row conditions of the fact table; NULL passes, as in a SQL CHECK.
CHECKS = {
    "sales_positive": "sales > 0",
    "rating_range": "rating BETWEEN 1 AND 5",
    "visibility_range": "item_visibility BETWEEN 0 AND 1",
    "weight_positive": "item_weight > 0",
    "month_range": "order_month BETWEEN 1 AND 12",
}

BASE_YEAR = 2024  # store age is counted to this year
UNKNOWN = "Unknown"
GRAIN = ["item_identifier", "outlet_identifier"]
OUTLET_ATTRIBUTES = [
    "outlet_identifier", "outlet_type", "outlet_size", "outlet_location_type",
    "outlet_establishment_year", "outlet_age_years",
]

FACT_SCHEMA = T.StructType([
    T.StructField("sale_id", T.StringType()),
    T.StructField("item_identifier", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("item_fat_content", T.StringType()),
    T.StructField("item_weight", T.DecimalType(6, 3)),
    T.StructField("item_weight_imputed", T.IntegerType()),
    T.StructField("item_visibility", T.DecimalType(9, 6)),
    T.StructField("item_visibility_imputed", T.IntegerType()),
    T.StructField("outlet_identifier", T.StringType()),
    T.StructField("outlet_establishment_year", T.IntegerType()),
    T.StructField("outlet_age_years", T.IntegerType()),
    T.StructField("outlet_size", T.StringType()),
    T.StructField("outlet_location_type", T.StringType()),
    T.StructField("outlet_type", T.StringType()),
    T.StructField("sales", T.DecimalType(10, 4)),
    T.StructField("rating", T.DecimalType(3, 2)),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_year", T.IntegerType()),
    T.StructField("order_month", T.IntegerType()),
    T.StructField("order_month_name", T.StringType()),
    T.StructField("order_quarter", T.IntegerType()),
    T.StructField("order_year_month", T.StringType()),
    T.StructField("order_weekday", T.StringType()),
    T.StructField("is_weekend", T.IntegerType()),
])
FACT_COLUMNS = FACT_SCHEMA.fieldNames()
# Everything but the weight must be present in a clean row.
REQUIRED_COLUMNS = [c for c in FACT_COLUMNS if c != "item_weight"]
# Columns the report layer reads.
REPORT_COLUMNS = [
    "item_identifier", "item_type", "item_fat_content", "item_weight", "item_visibility",
    "outlet_identifier", "outlet_establishment_year", "outlet_size", "outlet_location_type",
    "outlet_type", "sales", "rating", "order_date", "order_year", "order_month",
    "order_month_name", "order_year_month", "order_quarter",
]
