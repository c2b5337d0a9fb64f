"""Map the benchmark tables onto the order-analytics data model.

seller  <- supplier joined with nation (country = nation name)
product <- part (category = p_type)
customer<- customer
order   <- lineitem joined with orders; one order = one line
           (order_id = "<l_orderkey>-<l_linenumber>")

(l_orderkey, l_linenumber) is not unique in the line table, so the fact
keeps one row per pair: the smallest by (l_partkey, l_suppkey,
l_extendedprice, l_quantity, l_returnflag, l_linestatus).  That dedup is an
aggregation, so copies collapse in the map-side partial aggregate before
any shuffle, however many copies one pair has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk import schemas as S
from souk.operators.joins import join_dim


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def status_of(returnflag: Column, linestatus: Column) -> Column:
    """Order status from the line flags (1/2 completed, 1/6 each other)."""
    return (F.when((returnflag == "R") & (linestatus == "F"), F.lit("refunded"))
             .when(returnflag == "R", F.lit("cancelled"))
             .when((returnflag == "N") & (linestatus == "O"), F.lit("pending"))
             .otherwise(F.lit("completed")))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name").withColumnRenamed("n_nationkey", "s_nationkey")
    return (join_dim(sup, nat, "s_nationkey")
            .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                    F.col("s_name").alias("name"),
                    F.col("n_name").alias("country"),
                    F.lit(None).cast("date").alias("joined_date")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_retailprice").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(S.PRICE).alias("base_price"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension rows; attributes are unknown, as in the source."""
    return read_table(spark, sf_dir, "customer", "c_custkey").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("date").alias("signup_date"))


def _order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate").withColumnRenamed(
        "o_orderkey", "l_orderkey")


def _to_orders(lines: DataFrame, header: DataFrame, with_key: bool = False) -> DataFrame:
    """lines ⋈ headers on the order key -> the ORDERS schema."""
    cols = [
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("dt"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(S.MONEY).alias("total_amount"),
        status_of(F.col("l_returnflag"), F.col("l_linestatus")).alias("status"),
    ]
    if with_key:
        cols += [F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line_no")]
    return lines.join(header, "l_orderkey").select(*cols)


_LINE_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
              "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus")


def raw_orders(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Orders as delivered by the source: duplicates kept."""
    lines = read_table(spark, sf_dir, "lineitem", *_LINE_COLS)
    return _to_orders(lines, _order_header(spark, sf_dir), with_key)


def dedup_lines(lines: DataFrame) -> DataFrame:
    """One line per (l_orderkey, l_linenumber): the smallest by the tie-break order.

    min(struct) is a lexicographic minimum computed as a partial + final
    aggregate, so a pair with any number of copies is reduced map-side.
    """
    order = ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus")
    best = (lines.groupBy("l_orderkey", "l_linenumber")
            .agg(F.min(F.struct(*order)).alias("b")))
    return best.select("l_orderkey", "l_linenumber", *[F.col(f"b.{c}").alias(c) for c in order])


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order fact: raw orders with one row per order_id."""
    lines = dedup_lines(read_table(spark, sf_dir, "lineitem", *_LINE_COLS))
    return _to_orders(lines, _order_header(spark, sf_dir))


def orders_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with planted faults for the data-quality rules.

    Fixed fault plan (k = order key):
      order_id     NULL       where line 7 and k % 50 = 0
      total_amount negated    where k % 97 = 0
      status       'lost'     where k % 101 = 0; NULL where k % 103 = 0
      seller_id    'none'     where k % 89 = 0;  NULL where k % 83 = 0
    """
    o = raw_orders(spark, sf_dir, with_key=True)
    k = F.col("k")
    return o.select(
        F.when((F.col("line_no") == 7) & (k % 50 == 0), F.lit(None).cast("string")).otherwise(F.col("order_id")).alias("order_id"),
        F.when(k % 89 == 0, F.lit("none")).when(k % 83 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("seller_id")).alias("seller_id"),
        "customer_id", "product_id", "dt", "quantity",
        F.when(k % 97 == 0, -F.col("total_amount")).otherwise(F.col("total_amount")).cast(S.MONEY).alias("total_amount"),
        F.when(k % 101 == 0, F.lit("lost")).when(k % 103 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("status")).alias("status"),
    )


class Fixture:
    """Lazily built frames of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def sellers(self) -> DataFrame:
        return sellers(self.spark, self.sf_dir)

    @property
    def products(self) -> DataFrame:
        return products(self.spark, self.sf_dir)

    @property
    def customers(self) -> DataFrame:
        return customers(self.spark, self.sf_dir)

    @property
    def raw_orders(self) -> DataFrame:
        return raw_orders(self.spark, self.sf_dir)

    @property
    def fact(self) -> DataFrame:
        return fact_orders(self.spark, self.sf_dir)

    @property
    def latest_dt(self):
        """MAX(dt) of the fact as a lazy scalar subquery.

        The dedup keeps at least one line per order key, so the fact has the
        same dates as lines joined to orders: the subquery skips the dedup.
        """
        lines = read_table(self.spark, self.sf_dir, "lineitem", "l_orderkey")
        dates = lines.join(_order_header(self.spark, self.sf_dir), "l_orderkey")
        return dates.select(F.max(F.col("o_orderdate").cast("date"))).scalar()

    @property
    def order_dates(self) -> DataFrame:
        """The dates of the fact: those of the order headers that have a line."""
        lines = read_table(self.spark, self.sf_dir, "lineitem", "l_orderkey")
        head = _order_header(self.spark, self.sf_dir)
        return head.join(lines, "l_orderkey", "left_semi").select(F.col("o_orderdate").cast("date").alias("dt")).distinct()

    @property
    def orders_faulty(self) -> DataFrame:
        return orders_faulty(self.spark, self.sf_dir)
