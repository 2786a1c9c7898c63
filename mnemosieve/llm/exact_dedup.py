"""Exact duplicates by an extendible-hash index on shared files. DataFrame functions only.

Keys are SHA-256 digests; a key's leading bits address a slot of the directory, which names a bucket. A bucket with more keys than its capacity is split
by one more bit, which doubles the directory where that bit is new. Where the directory has reached its largest depth, an overfull bucket gets pages
instead, told apart by further bits of the key, so a page's number of keys is bounded at any size. A bucket's page, which
is a range of keys, has one owner. The owner's task gets the rows, groups them by digest *and* text, so texts that share a digest are chained apart by
comparing bytes, and writes its part of the index. Copies of texts with very many copies are counted where they are, before they move. Rows find their
group by addressing the directory: slot, bucket, page and key.

Defined results: null counts as empty, and all empty texts are equal; of equal texts the row with the largest doc_id stays (a null
doc_id only if the group has no other), and of rows that repeat both doc_id and text one stays; an empty table gives no rows; texts of any
length are compared whole; further columns are ignored, or carried unchanged by `deduplicated`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mnemosieve.llm.common import LOWER, UPPER, attach_groups, carried, hot_limit, lower_ascii, read_table, restored, written

#: Keys of a bucket before it is split; bits of the directory at most, which bounds it to 65,536 slots.
CAPACITY, DEPTH = 500, 16
KEY_BITS = 60


class Directory:
    """Slots by the leading bits of a key, and the buckets they name. Buckets are numbered in the order of their keys in the end."""

    def __init__(self, depth: int = DEPTH) -> None:
        self.most, self.depth, self.slots = depth, 0, [0]  # the bucket of each slot
        self.local = [0]  # bits that a bucket's keys share

    def split(self, slot: int) -> None:
        """Splits the bucket of a slot by one more bit; doubles the directory where that bit is new."""
        bucket = self.slots[slot]
        if self.local[bucket] == self.depth:
            self.slots = [x for x in self.slots for _ in (0, 1)]
            self.depth, slot = self.depth + 1, slot * 2
        self.local[bucket] += 1
        self.local.append(self.local[bucket])
        width = 1 << (self.depth - self.local[bucket])  # slots of each half
        first = slot >> (width.bit_length()) << (width.bit_length())
        self.slots[first + width : first + 2 * width] = [len(self.local) - 1] * width

    def grown(self, histogram: dict[int, int], capacity: int) -> Directory:
        """Split until no bucket holds more than `capacity` keys or shares all bits. histogram: keys by their first `most` bits."""
        sums = [0]
        for prefix in range(1 << self.most):
            sums.append(sums[-1] + histogram.get(prefix, 0))
        open_ = [0]  # first slot, in bits of `most`
        while open_:
            at = open_.pop()
            slot = at >> (self.most - self.depth)
            bits = self.local[self.slots[slot]]
            width = 1 << (self.most - bits)
            if bits < self.most and sums[at + width] - sums[at] > capacity:
                self.split(slot)
                open_ += [at, at + width // 2]
        return self

    def table(self, histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int]]:
        """slot, bucket, pages. Buckets are numbered in the order of their slots."""
        number: dict[int, int] = {}
        keys: dict[int, int] = {}
        for prefix, n in histogram.items():
            bucket = self.slots[prefix >> (self.most - self.depth)]
            keys[bucket] = keys.get(bucket, 0) + n
        return [(slot, number.setdefault(bucket, len(number)), max(1, -(-keys.get(bucket, 0) // capacity))) for slot, bucket in enumerate(self.slots)]


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return docs.select(F.col("doc_id"), lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_text")).withColumn("text_sha256", digest(F.col("_text")))


ADDRESS = ["bucket", "page", "text_sha256"]


def build_index(docs: DataFrame, digest: Callable[[Column], Column] = sha256, capacity: int = CAPACITY, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """The index as a shared table (bucket, page, text_sha256, chain, keep_id, group_size), and each row's (doc_id, bucket, page, text_sha256)."""
    spark = docs.sparkSession
    keyed = _keyed(docs, digest)
    slim = written(keyed.select("doc_id", "text_sha256"), "dedup-keys")
    copies = written(slim.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")), "dedup-copies")
    bits = lambda first, n: F.conv(F.rpad(F.substring("text_sha256", first, n // 4), n // 4, "0"), 16, 10).cast("long")
    prefix = F.shiftright(bits(1, KEY_BITS), KEY_BITS - depth).alias("slot")
    histogram = {r[0]: r[1] for r in copies.groupBy(prefix).count().collect()}  # 2**depth rows at most
    grown = Directory(depth).grown(histogram, capacity)
    table = spark.createDataFrame(grown.table(histogram, capacity), "slot long, bucket int, pages int")

    def addressed(rows: DataFrame) -> DataFrame:
        at = rows.withColumn("slot", F.shiftright(bits(1, KEY_BITS), KEY_BITS - grown.depth)).join(F.broadcast(table), "slot")
        return at.withColumn("page", F.pmod(bits(KEY_BITS // 4 + 1, 32), F.col("pages")).cast("int")).drop("slot", "pages")

    limit = hot_limit(slim.count())
    hot = F.broadcast(copies.where(F.col("n") > limit).select("text_sha256"))  # 2000 rows at most
    owned = addressed(keyed)
    groups = lambda rows: rows.groupBy("owner", *ADDRESS, "_text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    owned = owned.withColumn("owner", F.concat_ws("/", "bucket", "page"))
    counted = groups(owned.join(hot, "text_sha256", "left_semi"))
    moved = owned.join(hot, "text_sha256", "left_anti").repartition("owner")  # to the owner of the bucket
    texts = groups(moved).unionByName(counted).drop("_text", "owner")
    chain = F.row_number().over(Window.partitionBy(*ADDRESS).orderBy(F.col("keep_id").desc_nulls_last()))
    return written(texts.withColumn("chain", chain), "dedup-index"), addressed(slim)


def marked(docs: DataFrame, digest: Callable[[Column], Column] = sha256, capacity: int = CAPACITY, depth: int = DEPTH) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row."""
    index, slim = build_index(docs, digest, capacity, depth)
    found = index.select(*ADDRESS, "keep_id", "group_size")
    clashing = index.where("chain > 1").select(*ADDRESS).distinct()
    if clashing.isEmpty():
        out = attach_groups(slim, found, ADDRESS, "group_size")
    else:  # different texts with one digest: their rows are joined by the text itself
        single = attach_groups(slim.join(clashing, ADDRESS, "left_anti"), found.join(clashing, ADDRESS, "left_anti"), ADDRESS, "group_size")
        rows = _keyed(docs, digest).join(clashing.select("text_sha256"), "text_sha256", "left_semi")
        groups = rows.groupBy("text_sha256", "_text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        out = single.drop("bucket", "page").unionByName(attach_groups(rows, groups, ["text_sha256", "_text"], "group_size").drop("_text"))
    first = F.row_number().over(Window.partitionBy("doc_id", "text_sha256", "keep_id").orderBy("group_size"))
    kept = (F.col("doc_id").eqNullSafe(F.col("keep_id"))) & (first == 1)
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), kept.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    keep = written(marked(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")), "dedup-kept")
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = carried(docs, F.col("doc_id"), sha256(text).alias("_key"), F.xxhash64(text).alias("_text"))
    out = rows.join(keep, rows["doc_id"].eqNullSafe(keep["_id"]) & (rows["_key"] == keep["_sha"]), "left_semi")
    if not docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        out = out.dropDuplicates(["doc_id", "_key", "_text"])
    return restored(out, docs)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""
