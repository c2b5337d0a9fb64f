"""Data-quality rules and constraint checks.

A rule is a scalar query with an expected value.  ``rule_frame`` compiles any
number of rules to ONE lazy frame: every rule is a scalar subquery of a
single-row query and every comparison a Column expression, so all rules are
evaluated by one Spark job.  The five order rules are aggregates over the
predicates of ``souk.functions``; those over the orders share one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk import schemas as S
from souk.functions import status_not_in
from souk.operators.joins import orphan_count
from souk.session import shared_dir

# How an actual value is held against the expected one.  A missing value (a
# query without rows) only passes "!=".
COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "==": lambda a, b: a.eqNullSafe(b),
    "!=": lambda a, b: ~a.eqNullSafe(b),
    "<": lambda a, b: F.coalesce(a < b, F.lit(False)),
    "<=": lambda a, b: F.coalesce(a <= b, F.lit(False)),
    ">": lambda a, b: F.coalesce(a > b, F.lit(False)),
    ">=": lambda a, b: F.coalesce(a >= b, F.lit(False)),
}


class DataQualityError(Exception):
    """One or more rules do not hold; the message has a line for each."""


class Rule(NamedTuple):
    """``query``: SQL text, or a frame; its first column's first row counts."""

    name: str
    query: str | DataFrame
    expected: Any = 0
    comparison: str = "=="


def as_rule(spec: Rule | Mapping[str, Any]) -> Rule:
    """A rule from a mapping with ``name``, ``sql`` and optional ``expected``, ``comparison``."""
    if not isinstance(spec, Rule):
        spec = Rule(spec["name"], spec["sql"], spec.get("expected", 0), spec.get("comparison", "=="))
    if spec.comparison not in COMPARE:
        raise KeyError(f"rule {spec.name}: comparison {spec.comparison!r} is not one of {sorted(COMPARE)}")
    return spec


def rule_frame(spark: SparkSession, rules: Iterable[Rule | Mapping[str, Any]], params: Mapping[str, Any] | None = None,
               frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """J1, lazy: ``name, actual, expected, comparison, passed`` per rule.

    SQL text may use bound parameters (``:dt``) and frames (``{orders}``).
    """
    rules = [as_rule(r) for r in rules]
    values = []
    for r in rules:
        q = spark.sql(r.query, args=dict(params or {}) or None, **dict(frames or {})) if isinstance(r.query, str) else r.query
        values.append(q.select(q[q.columns[0]]).limit(1).scalar())
    wide = spark.range(1).select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    verdicts = [F.struct(
        F.lit(r.name).alias("name"), F.col(f"v{i}").cast("bigint").alias("actual"), F.lit(r.expected).cast("bigint").alias("expected"),
        F.lit(r.comparison).alias("comparison"), COMPARE[r.comparison](F.col(f"v{i}"), F.lit(r.expected)).alias("passed"))
        for i, r in enumerate(rules)]
    return wide.select(F.inline(F.array(*verdicts)))


def gate(report: DataFrame) -> list[dict]:
    """The report's rows (one per rule); an error names those that failed."""
    rows = [r.asDict() for r in report.collect()]
    broken = [r for r in rows if not r["passed"]]
    if broken:
        raise DataQualityError("\n".join(
            f"[{r['name']}] value={r['actual']}, not {r['comparison']} {r['expected']}" for r in broken))
    return rows


def run_rules(spark: SparkSession, rules: Iterable[Rule | Mapping[str, Any]], params: Mapping[str, Any] | None = None,
              frames: Mapping[str, DataFrame] | None = None, fail_on_first_error: bool = False,
              raise_on_failure: bool = True) -> list[dict]:
    """The evaluated rules, by one job; with ``fail_on_first_error`` one
    after another, and none after the first that fails."""
    rules = [as_rule(r) for r in rules]
    batches = [[r] for r in rules] if fail_on_first_error else [rules] if rules else []
    out: list[dict] = []
    for batch in batches:
        report = rule_frame(spark, batch, params, frames)
        out += gate(report) if raise_on_failure else [r.asDict() for r in report.collect()]
        if fail_on_first_error and not out[-1]["passed"]:
            break
    return out


# J2-J5 as aggregates over the orders; J6 needs the sellers.
ORDER_CHECKS: dict[str, Callable[[], Column]] = {
    "not_null_order_id": lambda: F.count_if(F.col("order_id").isNull()),
    "no_duplicate_orders": lambda: F.count(F.lit(1)) - F.count_distinct("order_id"),
    "positive_amount": lambda: F.count_if(F.col("total_amount") <= 0),
    "valid_status": lambda: F.count_if(status_not_in("status")),
}
SELLER_CHECK = "referential_seller"
RULE_NAMES = (*ORDER_CHECKS, SELLER_CHECK)


def _on(orders: DataFrame, ds) -> DataFrame:
    from souk.operators.metrics import as_date
    return orders if ds is None else orders.where(F.col("dt") == as_date(ds))


def order_rules(orders: DataFrame, sellers: DataFrame, names: Iterable[str] = RULE_NAMES, ds=None) -> list[Rule]:
    """J2-J6 as rules for the runner; every one reads only what it needs."""
    day = _on(orders, ds)
    return [Rule(n, orphan_count(day, sellers) if n == SELLER_CHECK else day.agg(ORDER_CHECKS[n]())) for n in names]


def order_rule_report(orders: DataFrame, sellers: DataFrame, ds=None) -> DataFrame:
    """J2-J6 fused: one aggregate and one anti-join; one row per rule."""
    day = _on(orders, ds)
    counts = day.agg(*[c().alias(n) for n, c in ORDER_CHECKS.items()]).crossJoin(   # one row each
        orphan_count(day, sellers).toDF(SELLER_CHECK))
    return _report(counts, [])


def order_rule_report_by_date(orders: DataFrame, sellers: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """The report per ``dt``: the gate of a set of dates judges each date alone.

    What only few rows can break is looked for among few rows: orders of unknown
    sellers by the sellers that are unknown, and copies of an id by ``repeated``
    (``dt, order_id, n``: every id of a date that comes more than once; counted
    here if not given).  Neither shuffles a row per order.
    """
    if repeated is None:
        repeated = orders.where(F.col("order_id").isNotNull()).groupBy("dt", "order_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    checks = {n: c for n, c in ORDER_CHECKS.items() if n != "no_duplicate_orders"}
    counts = orders.groupBy("dt").agg(*[c().alias(n) for n, c in checks.items()], F.count_if(F.col("seller_id").isNull()).alias("_no_seller"))
    parts = [counts, repeated.groupBy("dt").agg(F.sum(F.col("n") - 1).alias("_copies"))]
    unknown = unknown_keys(orders, {"seller_id": (sellers, "seller_id")})
    if unknown is not None:
        per = orders.select("dt", F.col("seller_id").alias("value")).where(F.col("value").isNotNull()).groupBy("dt", "value").agg(F.count(F.lit(1)).alias("n"))
        parts.append(per.join(unknown, "value", "left_semi").groupBy("dt").agg(F.sum("n").alias("_orphans")))
    names = [*checks, "_no_seller", "_copies", "_orphans"]
    rows = [p.select("dt", *[F.col(c) if c in p.columns else F.lit(0).cast("long").alias(c) for c in names]) for p in parts]
    wide = reduce(DataFrame.unionByName, rows).groupBy("dt").agg(*[F.sum(c).alias(c) for c in names])        # a few rows per date
    return _report(wide.withColumns({        # a null id counts as a copy, an order without seller as an orphan
        "no_duplicate_orders": F.col("_copies") + F.col("not_null_order_id"), SELLER_CHECK: F.col("_orphans") + F.col("_no_seller")}), ["dt"])


def unknown_keys(fact: DataFrame, fks: Mapping[str, tuple[DataFrame, str]]) -> DataFrame | None:
    """``name, value``: the key values (NULL aside) of the fact's columns that their
    dimension has not, stored; None if there are none.

    One shuffle of distinct values, fact and dimensions as tagged rows; a value that
    very many orders have is one row per task before it.
    """
    tagged = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in fks]))
    rows = fact.select(tagged).where(F.col("value").isNotNull()).select("name", "value", F.lit(False).alias("known"))
    for c, (dim, key) in fks.items():
        rows = rows.unionByName(dim.where(F.col(key).isNotNull()).select(
            F.lit(c).alias("name"), F.col(key).cast("string").alias("value"), F.lit(True).alias("known")))
    missing = rows.groupBy("name", "value").agg(F.max("known").alias("known")).where(~F.col("known")).select("name", "value")
    path = shared_dir(fact.sparkSession, "unknown")
    missing.write.parquet(path)
    stored = fact.sparkSession.read.schema(missing.schema).parquet(path)
    return None if stored.isEmpty() else stored


def _report(counts: DataFrame, by: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("bigint").alias("actual")) for n in RULE_NAMES])
    return counts.select(*by, F.inline(rows)).select(
        *by, "name", "actual", F.lit(0).cast("bigint").alias("expected"), F.lit("==").alias("comparison"),
        (F.col("actual") == 0).alias("passed"))


def check_primary_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are NULL or occur more than once, with their count."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
              .where((F.col("n") > 1) | any_null))


def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """J7 companion: one row per key, the smallest by ``order`` then the other columns.

    A lexicographic min(struct) aggregate: copies of one key collapse in the
    map-side partial aggregate (no row_number over a hot group).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in order + rest]).select(*df.columns)


def check_foreign_keys(fact: DataFrame, dims: Mapping[str, DataFrame],
                       fks: Mapping[str, tuple[str, str]] = S.FACT_FOREIGN_KEYS) -> DataFrame:
    """Per foreign key, the number of non-NULL fact keys missing from the dimension."""
    parts = []
    for col, (dim_name, key) in fks.items():
        keys = dims[dim_name].select(F.col(key).alias(col)).where(F.col(col).isNotNull())
        counted = fact.select(col).where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        missing = counted.join(keys, col, "left_anti")       # one row per key value: no hot key
        parts.append(missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_orphans"))
                     .select(F.lit(dim_name).alias("dim"), F.lit(col).alias("fk_column"), "n_orphans"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_domains(df: DataFrame, varchar: Mapping[str, int] | None = None,
                  numeric: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Per column rule, the number of values outside VARCHAR(n) / NUMERIC(p,s)."""
    pairs = []
    for c, n in (varchar or {}).items():
        pairs.append((f"{c}:varchar({n})", F.count_if(F.length(c) > n)))
    for c, (p, s) in (numeric or {}).items():
        bad = F.col(c).isNotNull() & F.col(c).try_cast(T.DecimalType(p, s)).isNull()
        pairs.append((f"{c}:numeric({p},{s})", F.count_if(bad)))
    aggs = [col.alias(f"c{i}") for i, (_, col) in enumerate(pairs)]
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").cast("bigint").alias("n")) for i, (n, _) in enumerate(pairs)])
    return df.agg(*aggs).select(F.inline(rows))


def with_limits(marked: DataFrame, varchar: Mapping[str, int]) -> DataFrame:
    """J9 on staged records: a value longer than its column joins ``reject_reason``."""
    long = [F.when(F.length(c) > n, F.lit(f"{c} longer than {n}")) for c, n in varchar.items()]
    return marked.withColumn("reject_reason", F.concat_ws("; ", F.when(F.col("reject_reason") != "", F.col("reject_reason")), *long))


def domain_report_by_date(df: DataFrame, varchar: Mapping[str, int], numeric: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """J9 per ``dt``: ``dt, name, actual`` for every limit that a date breaks; one aggregate."""
    rules = [(f"{c}:varchar({n})", F.length(c) > n) for c, n in varchar.items()]
    rules += [(f"{c}:numeric({p},{s})", F.col(c).isNotNull() & F.col(c).try_cast(T.DecimalType(p, s)).isNull())
              for c, (p, s) in (numeric or {}).items()]
    counts = df.groupBy("dt").agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, bad) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"c{i}").cast("bigint").alias("actual")) for i, (n, _) in enumerate(rules)])
    return counts.select("dt", F.inline(rows)).where(F.col("actual") > 0)


def foreign_key_report_by_date(fact: DataFrame, dims: Mapping[str, DataFrame],
                               fks: Mapping[str, tuple[str, str]] = S.FACT_FOREIGN_KEYS) -> DataFrame:
    """J8 per ``dt``: ``dt, name, actual`` with the key values (NULL aside) that a
    date has and the dimension has not.

    Unknown values are found first; without any, no fact row is looked at again.
    A value that very many orders have is one row per task and date before a shuffle.
    """
    unknown = unknown_keys(fact, {c: (dims[dim], key) for c, (dim, key) in fks.items()})
    if unknown is None:
        return fact.sparkSession.createDataFrame([], "dt date, name string, actual long")
    tagged = F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in fks]))
    pairs = fact.select("dt", tagged).where(F.col("value").isNotNull()).distinct()
    label = F.concat(F.col("name"), F.lit(":"), F.element_at(F.create_map(*[F.lit(x) for c, (dim, _) in fks.items() for x in (c, dim)]), F.col("name")))
    return (pairs.join(unknown, ["name", "value"], "left_semi").where(F.col("dt").isNotNull())      # as collect_set: no null date
            .groupBy("dt", "name").agg(F.count(F.lit(1)).alias("actual")).select("dt", label.alias("name"), "actual"))
