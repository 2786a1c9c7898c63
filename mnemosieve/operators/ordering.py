"""What comes before a row, along an order within keys, without a task that holds a whole key.

Rows are dealt in ranges of (keys, order) and written once. A range's own part of a prefix is a window within (keys, range); what earlier ranges add comes from
a table with one row for each key and range. So a key with any share of all rows is spread over as many tasks as it has ranges.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemosieve.operators.scoring import fits
from mnemosieve.sources.tables import written

Aggregate = Callable[[Column], Column]


def ranged(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """rows as a table, with the range (_range) of each."""
    return written(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")


def before(rows: DataFrame, keys: list[str], order: list[str], named: dict[str, tuple[Aggregate, Column, Callable[[Column, Column], Column]]]) -> DataFrame:
    """rows (of ranged) with the aggregates of all rows of the key that come before: name: (aggregate, column, how two parts of it join). The first row of a
    key has nulls. order must tell the rows of a key apart. Null keys are a key."""
    whole, earlier = [*keys, "_range"], Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*whole).agg(*(agg(col).alias(f"_part_{n}") for n, (agg, col, _) in named.items()))
    parts = written(parts.select(*(F.col(c).alias(f"_key_{c}") for c in whole), *(agg(F.col(f"_part_{n}")).over(earlier).alias(f"_before_{n}") for n, (agg, _, _) in named.items())), "range-sums")
    own = Window.partitionBy(*whole).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select("*", *(agg(col).over(own).alias(f"_own_{n}") for n, (agg, col, _) in named.items()))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in whole))
    found = inside.join(F.broadcast(parts) if fits(parts) else parts, same)

    def joined(n: str, how: Callable[[Column, Column], Column]) -> Column:
        a, b = F.col(f"_before_{n}"), F.col(f"_own_{n}")
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(how(a, b)).alias(n)

    return found.select(*rows.columns, *(joined(n, how) for n, (_, _, how) in named.items()))


def add(a: Column, b: Column) -> Column:
    return a + b


def placed(rows: DataFrame, keys: list[str], order: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """rows with place, from 1 within each key, and, for each column of sums, running_<column>, the sum up to and with the row."""
    named = {"place": (F.sum, F.lit(1).cast("long"), add)} | {f"running_{c}": (F.sum, F.coalesce(F.col(c), F.lit(0)), add) for c in sums}
    found = before(ranged(rows, keys, order), keys, order, named)
    one = {"place": F.coalesce("place", F.lit(0)) + 1} | {f"running_{c}": F.coalesce(F.col(f"running_{c}"), F.lit(0)) + F.coalesce(F.col(c), F.lit(0)) for c in sums}
    return found.withColumns(one).drop("_range")


def islands(rows: DataFrame, keys: list[str], order: list[str], reach: Column, start: Column) -> DataFrame:
    """rows with island, a number from 1 within each key: one begins where `start` is at or beyond the furthest `reach` of all rows before."""
    found = before(ranged(rows, keys, order), keys, order, {"_reach": (F.max, reach, F.greatest)})
    found = written(found.withColumn("_opens", F.when(F.col("_reach").isNull() | (start >= F.col("_reach")), 1).otherwise(0).cast("long")).drop("_reach"), "islands")
    found = before(found, keys, order, {"island": (F.sum, F.col("_opens"), add)})
    return found.withColumn("island", F.coalesce("island", F.lit(0)) + F.col("_opens")).drop("_opens", "_range")
