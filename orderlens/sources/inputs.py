"""The set of input views the report reads.

``Inputs`` is a plain bundle of DataFrames with the column layout of the CRM, warehouse and
point-of-sale tables.  ``orderlens.__main__.bind`` reads each from the catalog, Parquet or delimited files on a cluster;
``orderlens.sources.adapter.from_testdata`` derives it from the generated parquet tables.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Inputs:
    order_item: DataFrame  # one row per order line (CRM)
    order_head: DataFrame  # one row per order (CRM)
    order_ext_2: DataFrame  # order extension: shop, channel, sales user
    order_ext_x: DataFrame  # order extension: dealer attribute
    order_item_om: DataFrame  # service dates per order line, several versions per line
    product_crm: DataFrame  # CRM product master
    dim_subscriber: DataFrame
    dim_billing: DataFrame
    dim_product: DataFrame
    dim_user: DataFrame
    dim_article: DataFrame  # article reference file (level3/level4/face value)
    dim_shop: DataFrame  # shop reference file (declared, never joined)
    dim_sub_type: DataFrame  # subscriber type per subscriber
    pos_sale: DataFrame  # point-of-sale gross sales
    pos_order: DataFrame  # point-of-sale order details (links POS journal to CRM order)

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]
