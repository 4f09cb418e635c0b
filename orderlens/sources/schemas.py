"""Declared schemas of the two comma-delimited reference dimensions.

Both files are plain delimited text without header or quoting; the column list and types
are part of the table definition, never inferred from the data.
"""

from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType

ARTICLE_SCHEMA = StructType(
    [
        StructField("productid", StringType()),
        StructField("productname", StringType()),
        StructField("commercialproductname", StringType()),
        StructField("level3", StringType()),
        StructField("level4", StringType()),
        StructField("description", StringType()),
        StructField("facevalue", FloatType()),
        StructField("level3_order", IntegerType()),
    ]
)

SHOP_SCHEMA = StructType(
    [
        StructField("shopname", StringType()),
        StructField("area", StringType()),
        StructField("shoptype", StringType()),
        StructField("longitude", FloatType()),
        StructField("latitude", FloatType()),
        StructField("area1", StringType()),
        StructField("type", StringType()),
        StructField("counters", IntegerType()),
    ]
)
