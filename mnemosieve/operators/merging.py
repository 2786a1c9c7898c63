"""Merges of records: repeats within a time window, topics with revisions, relations of unordered pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemosieve.functions.text import text_of
from mnemosieve.operators.ordering import islands

#: Seconds within which an equal record is a repeat of the one that was kept.
WINDOW_S = 15 * 60
IDENTITY = ["project", "scope", "type", "title", "content_hash"]


def normalized_hash(content):
    """SHA-256 of the text without regard to case and runs of white space."""
    return F.sha2(F.lower(F.trim(F.regexp_replace(text_of(content), r"\s+", " "))), 256)


def repeats(records: DataFrame, keys: list[str] = IDENTITY, window_s: int = WINDOW_S) -> DataFrame:
    """id, kept_id, kept: a record within window_s of the last kept one with the same keys (at the very end too) is its repeat; the next is kept anew.
    records: id, at (timestamp) and keys; ids tell records of one time apart; null keys are equal.

    A pause longer than the window always starts anew, so each run without such a pause is an island, and islands, not keys, are dealt to tasks. A task goes
    through its islands in order and holds one kept record: memory doesn't grow with a run."""
    micros = F.unix_micros("at")
    names = [f"k{i}" for i in range(len(keys))]
    rows = records.select("id", micros.alias("at"), *(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)))
    rows = islands(rows, names, ["at", "id"], F.col("at") + F.lit(window_s * 1_000_000 + 1), F.col("at"))
    key = F.xxhash64(*names, "island")  # tells which rows share a task; within it, they are in order of the key itself
    whole = F.sha2(F.to_json(F.struct(*names, "island"), {"ignoreNullFields": "false"}), 256).alias("run")
    dealt = rows.select("id", "at", whole, key.alias("_task")).repartition("_task").sortWithinPartitions("run", "at", "id")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = last = kept = None
        for batch in batches:
            ids, found = batch.column(0).to_pylist(), []
            for i, at, r in zip(ids, batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if r != run or at - last > window_s * 1_000_000:
                    run, last, kept = r, at, i
                found.append(kept)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, batch.schema.field(0).type)], ["id", "kept_id"])

    kind = records.schema["id"].dataType.simpleString()
    return dealt.select("id", "at", "run").mapInArrow(fold, f"id {kind}, kept_id {kind}").withColumn("kept", F.col("id") == F.col("kept_id"))


def upserted_topics(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """project, scope, topic_key, id, title, content, seq, revision_count: one row for each topic, with its latest record and the number of its saves.
    batch: id, project, scope, topic_key, title, content, seq (later is larger); a record without a topic stands alone and is its own. Rows of one topic meet
    already merged, so a topic may have any number of them; a batch that is applied again counts again (plans/sink.py applies one once)."""
    topic = F.when(text_of(F.col("topic_key")) == "", F.concat(F.lit("id:"), F.col("id").cast("string"))).otherwise(F.concat(F.lit("topic:"), "topic_key"))
    rows = batch.select(text_of(F.col("project")).alias("project"), text_of(F.col("scope")).alias("scope"), topic.alias("topic_key"), "id", text_of(F.col("title")).alias("title"), text_of(F.col("content")).alias("content"), "seq", F.lit(1).cast("long").alias("revision_count"))
    both = rows if state is None else state.select(*rows.columns).unionByName(rows)
    latest = F.max_by(F.struct("id", "title", "content", "seq"), F.struct("seq", "id"))
    return both.groupBy("project", "scope", "topic_key").agg(latest.alias("r"), F.sum("revision_count").alias("revision_count")).select("project", "scope", "topic_key", "r.*", "revision_count")


def upserted_relations(state: DataFrame | None, batch: DataFrame) -> DataFrame:
    """low, high, verb, seq, judgements: one row for each unordered pair, with its latest verb and how often it was judged. A record has no relation
    with itself. batch: source_id, target_id, verb, seq (no two verdicts on a pair share one)."""
    rows = batch.where("source_id <> target_id").select(F.least("source_id", "target_id").alias("low"), F.greatest("source_id", "target_id").alias("high"), "verb", "seq", F.lit(1).cast("long").alias("judgements"))
    both = rows if state is None else state.select(*rows.columns).unionByName(rows)
    return both.groupBy("low", "high").agg(F.max_by("verb", "seq").alias("verb"), F.max("seq").alias("seq"), F.sum("judgements").alias("judgements")).select(*rows.columns)


def standing_relations(relations: DataFrame) -> DataFrame:
    """Relations that say something: a pair last judged to be no conflict has none."""
    return relations.where("verb <> 'not_conflict'")
