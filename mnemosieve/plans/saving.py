"""Saving a record: normalise, look for candidates first, write, fall back, and mark what the write updated. And how results read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemosieve.functions.requests import normalized_save
from mnemosieve.functions.text import score_text, text_of
from mnemosieve.operators.retrieval import will_update
from mnemosieve.plans.engine import Engine
from mnemosieve.sources.observations import fallback_envelope, write_outcome
from mnemosieve.sources.tables import written as written_table

FIELDS = ("title", "content", "observation", "type", "scope", "topic_key")


def normalized(rows: DataFrame) -> DataFrame:
    """Requests with normalised fields and error (null if they can be saved)."""
    have = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in FIELDS}
    told = normalized_save(have["title"], have["content"], have["observation"], have["type"], have["scope"], have["topic_key"])
    return rows.withColumn("_n", told).select(*[c for c in rows.columns if c not in FIELDS], "_n.*")


@dataclass(frozen=True)
class Saved:
    """Result of a batch of saves."""

    written: DataFrame
    candidates: DataFrame | None
    rejected: DataFrame


def save(engine: Engine, records: DataFrame, requests: DataFrame, write: Callable[[DataFrame], DataFrame], fallback: Callable[[DataFrame], DataFrame] | None = None) -> Saved:
    """Candidates are looked up before anything is written. write: requests to (query_id, status, failure, written_id); a connection failure, timeout or
    server error goes to fallback: requests to (query_id, response text). requests: query_id, project, session_id and the fields of a record."""
    rows = normalized(requests)
    good = written_table(rows.where("error is null").drop("error"), "requests")
    found = engine.candidates(good, records)
    sent = write(good).withColumn("outcome", write_outcome(F.col("status"), F.col("failure"), F.col("written_id")))
    sent = written_table(sent, "sent")  # the sink runs once: what follows reads its answers
    written = sent.where("outcome like 'success%'").select("query_id", "written_id", "outcome")
    again = sent.where(F.col("outcome").isin("connection", "timeout", "server")).select("query_id")
    if fallback is not None:
        told = written_table(fallback(good.join(again, "query_id", "left_semi")), "fallback").withColumn("_e", fallback_envelope(F.col("response")))
        written = written.unionByName(told.select("query_id", F.col("_e.id").alias("written_id"), F.lit("fallback").alias("outcome")))
    shown = None if found is None else will_update(found["candidates"], written.select("query_id", "written_id"))
    failed = sent.where(~F.col("outcome").like("success%")).join(written, "query_id", "left_anti").select("query_id", F.col("outcome").alias("reason"))
    return Saved(written, shown, rows.where("error is not null").select("query_id", F.col("error").alias("reason")).unionByName(failed))


def rendered_hits(hits: DataFrame) -> DataFrame:
    """query_id, text: a line for each hit, with the score to four places."""
    line = F.concat(F.lit("#"), F.col("doc_id").cast("string"), F.lit(" ["), "type", F.lit("] "), "title", F.lit(" ("), score_text(F.col("score")), F.lit(")\n  "), "excerpt")
    rows = F.array_sort(F.collect_list(F.struct("place", line.alias("s"))))
    return hits.groupBy("query_id").agg(F.array_join(F.transform(rows, lambda x: x["s"]), "\n").alias("text"))


def rendered_recall(hits: DataFrame, summary: DataFrame, types: list[str] | None = None) -> DataFrame:
    """query_id, text: a whole answer for each query of summary: its hits (each with filled marks for what is empty), a note iff more match than are shown, or,
    without a hit, that there is none and which types exist. hits, summary: of a retrieval; types: of available_types()."""
    filled = lambda c: F.when(text_of(F.col(c)) == "", "(none)").otherwise(F.col(c))
    head = F.concat(F.lit("["), F.col("place").cast("string"), F.lit("] #"), F.col("doc_id").cast("string"), F.lit(" score "), score_text(F.col("score")), F.lit(" type "), filled("type"), F.lit(" project "), filled("project"), F.lit(" scope "), filled("scope"))
    line = F.concat(head, F.when(text_of(F.col("title")) == "", "").otherwise(F.concat(F.lit("\n"), "title")), F.lit("\n"), filled("excerpt"))
    rows = F.array_sort(F.collect_list(F.struct("place", line.alias("s"))))
    shown = hits.groupBy("query_id").agg(F.array_join(F.transform(rows, lambda x: x["s"]), "\n").alias("s"), F.count(F.lit(1)).alias("n"))
    more = F.when(F.col("truncated"), F.concat(F.lit("\nMore records match than the "), F.col("n").cast("string"), F.lit(" shown; a higher limit shows more."))).otherwise("")
    none = "No record matches." + (f"\nTypes that exist: {' / '.join(types)}" if types else "")
    return summary.join(shown, "query_id", "left").select("query_id", F.when(F.col("n").isNull(), none).otherwise(F.concat("s", more)).alias("text"))


def rendered_candidates(candidates: DataFrame) -> DataFrame:
    """query_id, text: evidence without raw scores, and a reminder iff there is a candidate."""
    mark = lambda c, name: F.when(F.col(c), F.lit(f" {name}")).otherwise("")
    line = F.concat(F.lit("#"), F.col("doc_id").cast("string"), F.lit(" "), "title", F.lit(" rank "), F.col("semantic_rank").cast("string"), F.lit("/"), F.col("corpus_size").cast("string"), mark("identical_content", "identical"), mark("same_type_and_title", "same-title"), mark("same_session", "same-session"), F.lit(" shared: "), F.array_join("shared_rare_terms.terms", ", "))
    rows = F.array_sort(F.collect_list(F.struct("place", line.alias("s"))))
    return candidates.groupBy("query_id").agg(F.concat(F.lit("Compare with these before judging:\n"), F.array_join(F.transform(rows, lambda x: x["s"]), "\n")).alias("text"))
