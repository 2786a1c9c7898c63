"""The source of records: snapshot, digest, side columns, frames, and records made of the documents table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.functions.digests import Chained, library
from mnemosieve.functions.text import parse_envelope, text_of
from mnemosieve.operators.ordering import placed
from mnemosieve.sources.tables import read_table, written

FIELDS = ["id", "updated_at", "title", "content", "type", "project", "scope"]


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records made of documents, one for one: the same mapping for every query."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("id"), F.substring(F.substring_index(text_of(F.col("text")), "\n", 1), 1, 80).alias("title"), F.col("text").alias("content"),
        F.col("lang").alias("type"), F.col("source").alias("project"), F.when(F.col("doc_id") % 5 == 0, "personal").otherwise("project").alias("scope"),
        F.concat(F.lit("topic/"), (F.col("doc_id") % 50).cast("string")).alias("topic_key"), F.concat(F.lit("s"), (F.col("doc_id") % 100).cast("string")).alias("session_id"),
        F.lit("2026-01-01T00:00:00Z").alias("created_at"), F.concat(F.lit("2026-01-01T00:00:00Z+"), F.col("doc_id").cast("string")).alias("updated_at"),
        F.when(F.col("doc_id") % 17 == 0, "2026-02-01T00:00:00Z").alias("deleted_at"),
    )


def active_snapshot(records: DataFrame) -> DataFrame:
    """Records that aren't deleted, nulls read as empty strings."""
    return records.where("deleted_at is null").select("id", *[text_of(F.col(c)).alias(c) for c in FIELDS[1:]])


def serialized(id_: Column, updated_at: Column, content: Column) -> Column:
    unit, record = F.decode(F.unhex(F.lit("1F")), "UTF-8"), F.decode(F.unhex(F.lit("1E")), "UTF-8")
    return F.concat(id_.cast("string"), unit, updated_at, unit, F.length(content).cast("string"), unit, content, record)


#: Bytes of records that one task of source_hash digests, about.
PART_BYTES = 64 << 20


def source_hash(snapshot: DataFrame, part_bytes: int = PART_BYTES) -> str:
    """SHA-256 of all records in order of id. A digest of one byte stream is sequential: records are dealt in ranges of ids, and a task for each range, one after
    the other, goes on from the state that the one before has left. So no record reaches the driver, and no task has more than a range."""
    rows = snapshot.select("id", serialized(F.col("id"), F.col("updated_at"), F.col("content")).alias("s"))
    size = rows.agg(F.sum(F.octet_length("s").cast("long"))).first()[0]
    if not size:
        return hashlib.sha256().hexdigest()
    if not library():
        return hash_on_driver(rows)
    parts = written(rows.repartitionByRange(-(-size // part_bytes), "id").withColumn("_range", F.spark_partition_id()), "ranges", "_range")
    state = b""
    for k in sorted(r[0] for r in parts.select("_range").distinct().collect()):
        def task(batches: Iterator[pa.RecordBatch], state: bytes = state) -> Iterator[pa.RecordBatch]:
            digest = Chained(state)
            for batch in batches:
                for text in batch.column(0):
                    digest.update(text.as_buffer().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([digest.state()], pa.binary())], ["state"])

        state = bytes(parts.where(F.col("_range") == k).select("id", "s").repartition(1).sortWithinPartitions("id").select("s").mapInArrow(task, "state binary").first()[0])
    return Chained(state).hexdigest()


def hash_on_driver(rows: DataFrame) -> str:
    """source_hash where Python shows no digest that can go on from a state: rows (id, s) pass the driver a block at a time and none is kept."""
    digest = hashlib.sha256()
    for row in rows.orderBy("id").toLocalIterator():
        digest.update(row["s"].encode())
    return digest.hexdigest()


def snapshot_digest(snapshot: DataFrame) -> str:
    """A digest of the same records in no order, by which a sync tells whether the source has changed: their number and, for each quarter of the records'
    SHA-256, the sum. Tasks add up their own part; nothing but the sums reaches the driver."""
    sha = F.sha2(serialized(F.col("id"), F.col("updated_at"), F.col("content")), 256)
    quarters = [F.sum(F.conv(F.substring(sha, 16 * i + 1, 15), 16, 10).cast("decimal(38,0)")) for i in range(4)]
    told = snapshot.agg(F.count(F.lit(1)), *quarters).first()
    return "-".join(str(int(x or 0)) for x in told)


#: Children of a node of a digest tree, and its levels above the leaves: 10**12 leaves.
FAN_OUT, LEVELS = 1024, 4


def tree_digest(rows: DataFrame, order: list[str], leaf: Column, fan_out: int = FAN_OUT, levels: int = LEVELS) -> str:
    """A digest of rows in order that tasks compute together: a leaf's SHA-256; above, that of the digests of fan_out neighbours, level by level. order tells rows
    apart. Rows are numbered by ranges, and a node has a bounded number of children, so nothing grows with the table but the number of nodes."""
    if fan_out**levels < (n := rows.count()):
        raise ValueError(f"a tree of {levels} levels holds no {n} rows")
    nodes = placed(rows.select(*order, F.sha2(leaf, 256).alias("digest")), [], order).select((F.col("place") - 1).alias("n"), "digest")
    for _ in range(levels):
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "digest"))), lambda x: x["digest"]), "")
        nodes = nodes.groupBy(F.floor(F.col("n") / fan_out).alias("n")).agg(F.sha2(children, 256).alias("digest"))
    top = nodes.first()
    return top["digest"] if top else hashlib.sha256(b"").hexdigest()


def source_state(snapshot: DataFrame) -> DataFrame:
    """One row: hash, total_content_chars, doc_count, all from one set of rows, which is written first."""
    snapshot = written(snapshot, "snapshot")
    told = snapshot.agg(F.coalesce(F.sum(F.length("content")), F.lit(0)).cast("long").alias("total_content_chars"), F.count(F.lit(1)).alias("doc_count")).first()
    return snapshot.sparkSession.createDataFrame([(source_hash(snapshot), told[0], told[1])], "hash string, total_content_chars long, doc_count long")


def side_columns(records: DataFrame, ids: DataFrame) -> DataFrame:
    """id, topic_key, session_id of some ids; a source without these columns, or without the record, gives empty strings."""
    have = [c for c in ("topic_key", "session_id") if c in records.columns]
    found = records.select("id", *have)
    out = ids.select("id").distinct().join(found, "id", "left")
    return out.select("id", *[text_of(F.col(c)).alias(c) if c in have else F.lit("").alias(c) for c in ("topic_key", "session_id")])


def request_frames(lines: DataFrame, column: str = "value") -> DataFrame:
    """Requests of a JSON-lines stream: id, cmd, query; a line that isn't one has valid = false."""
    parsed = F.from_json(F.col(column), "id string, cmd string, query string")
    return lines.select(parsed["id"].alias("id"), parsed["cmd"].alias("cmd"), parsed["query"].alias("query"), F.coalesce(parsed["cmd"].isNotNull(), F.lit(False)).alias("valid"))


def response_frames(rows: DataFrame, id_column: str = "id") -> DataFrame:
    """JSON lines of rows, each with its id beside the payload."""
    rest = [c for c in rows.columns if c != id_column]
    return rows.select(F.to_json(F.struct(F.col(id_column).alias("id"), F.struct(*rest).alias("payload"))).alias("value"))


def envelopes(rows: DataFrame, column: str) -> DataFrame:
    """project, project_source, result of response texts."""
    return rows.withColumn("_e", parse_envelope(F.col(column))).select(*[c for c in rows.columns if c != column], "_e.project", "_e.project_source", "_e.result")


def fallback_envelope(text: Column) -> Column:
    """struct<id, dropped_candidates>: the id of a fallback write, and how many candidates of its own it named."""
    parsed = F.from_json(text, "id long, candidates array<string>")
    return F.struct(parsed["id"].alias("id"), F.coalesce(F.size(parsed["candidates"]), F.lit(0)).alias("dropped_candidates"))


def write_outcome(status: Column, failure: Column, id_: Column) -> Column:
    """Class of a write: success (with or without an id), connection, timeout, cancelled, server or rejected."""
    return (
        F.when(failure.isin("connection", "timeout", "cancelled"), failure).when(status.between(200, 299), F.when(id_.isNull(), "success-without-id").otherwise("success"))
        .when(status >= 500, "server").otherwise("rejected")
    )
