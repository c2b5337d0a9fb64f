"""Equi-joins of the star schema.

No join carries a broadcast hint and no plan depends on a row count: facts are
aggregated first, and the planner (or AQE, from measured bytes) broadcasts a
small dimension or splits a skewed partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """fact ⋈ dim on ``on``."""
    return fact.join(dim, on, how)


def join_fact_seller(fact: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Adds ``seller_name``; orders of unknown sellers drop out."""
    return join_dim(fact, dim_seller.select("seller_id", F.col("name").alias("seller_name")), "seller_id")


def join_fact_product(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Adds ``category``."""
    return join_dim(fact, dim_product.select("product_id", "category"), "product_id")


def orphan_orders(orders: DataFrame, sellers: DataFrame) -> DataFrame:
    """D3: orders whose seller is not known; a NULL seller_id is an orphan.

    Orders without a seller need no join, so they do not meet in one task.
    """
    keys = sellers.select("seller_id").where(F.col("seller_id").isNotNull())
    known = F.col("seller_id").isNotNull()
    return orders.where(known).join(keys, "seller_id", "left_anti").select(orders.columns).unionByName(orders.where(~known))


def orphan_count(orders: DataFrame, sellers: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Number of orphan orders (per ``by``): counted per seller before the
    anti-join, so a seller or NULL holding a third of all orders is one row."""
    by = by or []
    per = orders.groupBy(*by, "seller_id").agg(F.count(F.lit(1)).alias("n"))
    keys = sellers.select("seller_id").where(F.col("seller_id").isNotNull())
    return per.join(keys, "seller_id", "left_anti").groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_orphans"))


def new_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL ``key`` values of ``source`` absent from ``target``."""
    src = source.select(key).where(F.col(key).isNotNull()).distinct()
    return src.join(target.select(key), key, "left_anti")
