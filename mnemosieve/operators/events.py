"""Session events: payload contracts, turn-final texts, once-only capture, idempotent summaries, injections after compaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemosieve.functions.text import blank, blocks_to_text, framed_recall, has_learnings_section
from mnemosieve.functions.requests import is_subagent
from mnemosieve.operators.ordering import islands

# Payload fields by event type, and the JSON kind each must have.
CONTRACT = {
    "assistant/message": (("turn", "number"), ("step", "number"), ("message.content", "array")),
    "compaction/summary": (("compactionId", "string"), ("summary", "array")),
    "compaction/end": (("compactionId", "string"), ("turn", "number-or-null")),
}
MESSAGE = "turn bigint, step bigint, interrupted boolean, message struct<role: string, content: array<struct<type: string, text: string>>>"
SUMMARY = "compactionId string, summary array<struct<type: string, text: string>>"
END = "compactionId string, turn bigint, error string"


def _fits(path: str, kind: str) -> Column:
    """Whether data's field has its kind, by the JSON text of the value."""
    v = F.variant_get(F.try_parse_json("data"), f"$.{path}", "variant")
    of = F.schema_of_variant(v)
    number = of.rlike("^(BIGINT|DOUBLE|DECIMAL.*|FLOAT)$")
    return F.coalesce({"array": of.startswith("ARRAY"), "number": number, "number-or-null": number | (of == "VOID"), "string": of == "STRING"}[kind], F.lit(False))


def checked(events: DataFrame) -> DataFrame:
    """events (session_id, type, seq, data as JSON) with missing_fields; empty where the payload keeps its contract, null for other types."""
    told = F.when(F.lit(False), F.array().cast("array<string>"))
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json("data")).startswith("OBJECT"), F.lit(False))
    for kind, fields in CONTRACT.items():
        missing = F.filter(F.array(*[F.when(~_fits(p, k), f"{p} ({k})") for p, k in fields]), lambda x: x.isNotNull())
        everything = F.array(*[F.lit(f"{p} ({k})") for p, k in fields])
        told = told.when(F.col("type") == kind, F.when(whole, missing).otherwise(everything))
    return events.withColumn("missing_fields", told)


def valid(events: DataFrame) -> DataFrame:
    return checked(events).where(F.size("missing_fields") == 0).drop("missing_fields")


def violations(events: DataFrame) -> DataFrame:
    """The first broken payload of each session and type: one warning each."""
    bad = checked(events).where(F.size("missing_fields") > 0)
    first = bad.groupBy("session_id", "type").agg(F.min_by("missing_fields", "seq").alias("missing_fields"), F.min("seq").alias("seq"))
    return first.withColumn("warning", F.concat(F.lit("events of type "), "type", F.lit(" no longer carry "), F.array_join("missing_fields", ", "), F.lit("; first seen in session "), "session_id"))


def without_subagents(events: DataFrame) -> DataFrame:
    """Events of sessions that no other session started. events: with origin and depth."""
    return events.where(~is_subagent(F.col("origin"), F.col("depth")))


def turn_final(events: DataFrame) -> DataFrame:
    """session_id, turn, text: the last whole assistant message of each turn."""
    data = F.from_json("data", MESSAGE)
    rows = valid(events.where("type = 'assistant/message'")).withColumn("d", data).where(~F.coalesce(F.col("d.interrupted"), F.lit(False)))
    return rows.groupBy("session_id", F.col("d.turn").alias("turn")).agg(F.max_by(blocks_to_text(F.col("d.message.content")), "seq").alias("text"))


def capture_once(texts: DataFrame) -> DataFrame:
    """session_id, turn, text, seq: the first text of each turn that isn't blank. texts: session_id, turn, seq, text."""
    first = texts.where(~blank(F.col("text"))).groupBy("session_id", "turn").agg(F.min_by("text", "seq").alias("text"), F.min("seq").alias("seq"))
    return first.withColumn("has_learnings", has_learnings_section(F.col("text")))


def summaries_once(summaries: DataFrame) -> DataFrame:
    """compaction_id, session_id, text, persisted: the first summary of each compaction counts; a blank one is not persisted and not asked for again.
    summaries: session_id, compaction_id, seq, text."""
    first = summaries.groupBy("compaction_id").agg(F.min_by(F.struct("session_id", "text"), "seq").alias("s"))
    return first.select("compaction_id", "s.session_id", "s.text", (~blank(F.col("s.text"))).alias("persisted"))


def summary_events(events: DataFrame) -> DataFrame:
    """session_id, compaction_id, seq, text of valid summary events."""
    rows = valid(events.where("type = 'compaction/summary'")).withColumn("d", F.from_json("data", SUMMARY))
    return rows.select("session_id", F.col("d.compactionId").alias("compaction_id"), "seq", blocks_to_text(F.col("d.summary")).alias("text"))


def injections(events: DataFrame, frame: str, recalled: DataFrame, budget: int, wakeup: bool = True) -> DataFrame:
    """session_id, compaction_id, text, wakeup: once for each compaction that ended well; it wakes the session iff the compaction belonged to no turn.
    recalled: session_id, recall."""
    rows = valid(events.where("type = 'compaction/end'")).withColumn("d", F.from_json("data", END)).where("d.error is null")
    first = rows.groupBy(F.col("d.compactionId").alias("compaction_id")).agg(F.min_by(F.struct("session_id", F.col("d.turn").alias("turn")), "seq").alias("s"))
    out = first.select("compaction_id", "s.*").join(recalled, "session_id").where(~blank(F.col("recall")))
    return out.select("session_id", "compaction_id", framed_recall(F.col("recall"), frame, budget).alias("text"), (F.col("turn").isNull() & F.lit(wakeup)).alias("wakeup"))


def least_recently_used(connections: DataFrame) -> DataFrame:
    """The workspace to give up first. connections: workspace, last_used, in_flight."""
    return connections.where("in_flight = 0").agg(F.min_by("workspace", F.struct("last_used", "workspace")).alias("workspace"))


def idle(connections: DataFrame, now_ms: int, most_ms: int) -> DataFrame:
    """Connections with nothing in flight that are idle for long enough; 0 turns this off."""
    return connections.where((F.lit(most_ms) > 0) & (F.col("in_flight") == 0) & (F.lit(now_ms) - F.col("last_used") >= most_ms))


def idle_reclaims(calls: DataFrame, now_ms: int, most_ms: int) -> DataFrame:
    """workspace, opened_at, last_used, calls, reclaimed_at: the lives of each workspace's connection. It is given up when nothing has been in flight for
    most_ms; a call at that very moment opens a new one. reclaimed_at is null for one still open at now_ms, and always for most_ms = 0, which turns this off.
    calls: workspace, call_id, started_at, finished_at (milliseconds; null while in flight, which keeps the connection open)."""
    never = F.lit((1 << 62) - 1).cast("long")
    end = F.coalesce(F.col("finished_at"), never)
    rows = calls.select("workspace", "call_id", "started_at", F.greatest(end, F.col("started_at")).alias("finished_at"))
    if most_ms > 0:
        lives = islands(rows, ["workspace"], ["started_at", "call_id"], F.col("finished_at") + F.when(F.col("finished_at") == never, 0).otherwise(most_ms), F.col("started_at"))
    else:
        lives = rows.withColumn("island", F.lit(1))
    found = lives.groupBy("workspace", "island").agg(F.min("started_at").alias("opened_at"), F.max("finished_at").alias("last_used"), F.count(F.lit(1)).alias("calls"))
    due = F.col("last_used") + most_ms
    reclaimed = F.when((F.col("last_used") < never) & F.lit(most_ms > 0) & (due <= now_ms), due)
    return found.select("workspace", "opened_at", F.when(F.col("last_used") < never, F.col("last_used")).alias("last_used"), "calls", reclaimed.alias("reclaimed_at"))
