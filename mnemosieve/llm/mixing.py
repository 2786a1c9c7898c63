"""Mixing sources to target weights by systematic sampling. DataFrame functions only.

Weights share a total over the sources; a target stops at `most` times its source's size and the excess is shared anew, which a fill
level solves at once: target = min(most * size, level * weight). Every document of a source expects target / source size copies; their
prefix sum, shifted by one random offset, gives a copy for each whole number it crosses. Documents stand in order of size class, then of a
hash of doc_id, so any stretch of the prefix sum holds its share of long and short ones and the words taken come near the target.

Defined results: null texts have size 0; a null source is a source, the last; a source without words has target 0 and gives nothing;
repeated rows are rows of their own; ties of the order go by doc_id; an empty table gives no rows; further columns are ignored, or carried unchanged by
the mix, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mnemosieve.llm.common import carried, read_table, restored, written

WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2, "mix-1"
#: Rows that one task ranks at most, about: groups of more are split by hash into runs.
RANK_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["_none", "_source"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: str) -> Column:
    """Sizes under 32 are classes of their own; above, each doubling has 16 classes."""
    return F.expr(f"CASE WHEN {size} < 32 THEN {size} ELSE 32 + (length(bin({size})) - 6) * 16 + shiftright({size}, length(bin({size})) - 5) - 16 END").cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sizes: KEY, source_size. One row for each source goes to one task."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(Window.orderBy(*KEY)) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")
    order = Window.orderBy(F.col("source_size") / F.col("weight"), *KEY)
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    cap = F.lit(most) * F.col("source_size")
    total = F.col("_total").cast("double") * share
    ranked = (
        sizes.withColumn("weight", weight).withColumn("_total", F.sum("source_size").over(whole))
        .withColumn("_given", F.coalesce(F.sum(cap).over(before), F.lit(0))).withColumn("_open", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_full", (total - F.col("_given")) * F.col("weight") > cap.cast("double") * F.col("_open"))
    )
    given = F.sum(F.when(F.col("_full"), cap).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(0)).over(whole)
    level = (total - given) * F.col("weight") / open_weight
    return ranked.withColumn("target", F.when(F.col("_full"), cap.cast("double")).otherwise(level)).select(*KEY, "source_size", "weight", "target")


def mixed(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> DataFrame:
    """rows (doc_id, source, size and others) with source_size, target and copies, which take the place of columns of these names."""
    columns = [c for c in rows.columns if c not in ("source_size", "target", "copies")]
    group = [*KEY, "_class"]
    keyed = carried(rows.select(*(F.col(f"`{c}`") for c in columns)), F.col("doc_id"), F.col("source"), F.col("size")).withColumns({
        "_none": F.col("source").isNull(), "_source": F.coalesce(F.col("source").cast("string"), F.lit("")), "_class": size_class("size"),
        "_tie": content_hash(rows, [c for c in columns if c not in ("doc_id", "source", "size")]),
        "_hash": F.pmod(F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)).cast("long"), F.lit(1 << 31)) * F.lit(2654435761), F.lit(1 << 32)),
    })
    counts = written(keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "mix-counts")
    limit = max(RANK_ROWS, (counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // 2000)
    usual = -(-limit // RANK_ROWS)  # runs of a group that isn't among the largest
    runs = counts.where(F.col("n") > limit).select(*group, F.ceil(F.col("n") / RANK_ROWS).cast("long").alias("_runs"))  # 2000 rows at most
    run = lambda of: F.shiftright(F.col("_hash") * of, 32)
    salted = keyed.join(F.broadcast(runs), group, "left").withColumn("_salt", run(F.coalesce("_runs", F.lit(usual)))).drop("_runs")
    group = [*group, "_salt"]
    if usual == 1 and runs.isEmpty():
        fine = counts.select(*KEY, "_class", "n").withColumn("_salt", F.lit(0).cast("long"))
    else:
        fine = salted.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*KEY).orderBy("_class", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(counts.groupBy(*KEY).agg(F.sum("words").alias("source_size")), weights, share, most)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.when(F.col("_none"), "n").otherwise("s"), F.col("_source"))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    places = fine.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(targets, KEY).withColumn("_offset", offset).withColumn("_each", each).select(*group, "_before", "_offset", "_each", "source_size", "target")
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("_hash", "doc_id", "size", "_tie"))
    crossed = lambda i: F.floor(i * F.col("_each") + F.col("_offset"))
    at = F.col("_rank").cast("double")
    return (
        salted.withColumn("_rank", rank).join(places, group).withColumn("_rank", F.col("_rank") + F.col("_before"))
        .withColumn("copies", (crossed(at) - crossed(at - 1)).cast("long"))
        .select(*(F.col("_own").getField(c).alias(c) for c in columns), "source_size", "target", "copies")
    )


def content_hash(rows: DataFrame, columns: list[str]) -> Column:
    """A hash of further columns (in `_own`), so that rows that share a doc_id have an order of their own. Maps have no hash and don't count."""
    hashed = []
    for c in columns:
        kind, own = rows.schema[c].dataType, F.col("_own").getField(c)
        fields = [(f.dataType, own.getField(f.name)) for f in kind.fields] if isinstance(kind, StructType) else [(kind, own)]
        hashed += [x for k, x in fields if "map<" not in k.simpleString()]
    return F.xxhash64(*hashed) if hashed else F.lit(0).cast("long")


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken."""
    chosen = mixed(carried(docs, F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size")).withColumnRenamed("_own", "_docs")).where("copies > 0")
    return restored(chosen.select(F.col("_docs").alias("_own"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), docs)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    slim = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    return mixed(slim).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ((((doc_id % 2147483648) + 2147483648) % 2147483648) * 2654435761) % 4294967296 AS h FROM documents
), c AS (
  SELECT *, CASE WHEN size < 32 THEN size ELSE 32 + (length(bin(size)) - 6) * 16 + (size >> (length(bin(size)) - 5)) - 16 END AS class FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM c GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, (sum(source_size) OVER ())::DOUBLE * 1.5 AS total FROM s
), f AS (
  SELECT *, (total - coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
    > (2 * source_size)::DOUBLE * (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped
  FROM w
), t AS (
  SELECT source, source_size, CASE WHEN capped THEN (2 * source_size)::DOUBLE
    ELSE (total - sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER ()) * weight / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () END AS target,
    ('0x' || substr(md5('mix-1' || CASE WHEN source IS NULL THEN 'n' ELSE 's' END || coalesce(source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM f
), r AS (
  SELECT c.doc_id, c.size, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e,
    (row_number() OVER (PARTITION BY c.source ORDER BY c.class, c.h, c.doc_id, c.size))::DOUBLE AS i
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (floor(i * e + u) - floor((i - 1) * e + u))::BIGINT * size AS taken FROM r
"""
