"""Normalising requests, choosing projects, capacity: policy as column expressions and small functions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from mnemosieve.functions.text import blank, text_of

LIMIT, MOST = 10, 100
MS_PER_DOC, MOST_THREADS = 1300, 16


def clamp_limit(value: Column) -> Column:
    """Floor, then 1 to 100; null and numbers that aren't finite give 10."""
    wide = value.cast("double")
    sane = wide.isNotNull() & ~F.isnan(wide) & (F.abs(wide) < float("inf"))
    return F.when(sane, F.least(F.lit(float(MOST)), F.greatest(F.lit(1.0), F.floor(wide).cast("double")))).otherwise(float(LIMIT)).cast("int")


def limit_of(value: float | None) -> int:
    return LIMIT if value is None or not math.isfinite(value) else min(MOST, max(1, math.floor(value)))


def absent_if_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def choose_project(override: Column, session: Column, environment: Column, inject: Column) -> Column:
    """struct<project, source>: override, then session, then environment; nothing where injection is disabled."""
    given = {"overrides": absent_if_empty(override), "session": absent_if_empty(session), "environment": absent_if_empty(environment)}
    source = F.when(~inject, "disabled")
    for name, value in given.items():
        source = source.when(value.isNotNull(), name)
    return F.struct(F.when(inject, F.coalesce(*given.values())).alias("project"), source.otherwise("none").alias("source"))


def inject(explicit: Column, implicit: Column, declared: Column) -> Column:
    """The caller's argument wins; an implicit one fills it only where the tool declares it."""
    return F.coalesce(explicit, F.when(declared, implicit))


def normalized_save(title: Column, content: Column, observation: Column, kind: Column, scope: Column, topic_key: Column) -> Column:
    """struct<title, content, type, scope, topic_key, error>: the alias counts where content is blank; what is kept stays untrimmed."""
    body = F.when(blank(content) & ~blank(observation), observation).otherwise(text_of(content))
    error = F.when(blank(body), "content is blank").when(blank(title), "title is blank")
    return F.struct(text_of(title).alias("title"), body.alias("content"), F.coalesce(absent_if_empty(kind), F.lit("manual")).alias("type"), text_of(scope).alias("scope"), text_of(topic_key).alias("topic_key"), error.alias("error"))


def is_subagent(origin: Column, depth: Column) -> Column:
    return F.coalesce(origin == "subagent", F.lit(False)) | F.coalesce(depth > 0, F.lit(False))


def self_relation(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def embed_capacity(budget_ms: float, threads: int, ms_per_doc: float = MS_PER_DOC) -> int:
    """Documents that fit a time budget."""
    return max(0, math.floor(budget_ms * min(MOST_THREADS, max(1, threads)) / ms_per_doc))


def estimate_seconds(docs: int, threads: int, ms_per_doc: float = MS_PER_DOC) -> int:
    return math.ceil(docs * ms_per_doc / min(MOST_THREADS, max(1, threads)) / 1000)


def workers(threads: Column) -> Column:
    return F.least(F.lit(MOST_THREADS), F.greatest(F.lit(1), threads))


def embed_capacity_of(budget_ms: Column, threads: Column, ms_per_doc: float = MS_PER_DOC) -> Column:
    """embed_capacity() of columns."""
    return F.greatest(F.lit(0), F.floor(budget_ms * workers(threads) / F.lit(float(ms_per_doc)))).cast("long")


def estimate_seconds_of(docs: Column, threads: Column, ms_per_doc: float = MS_PER_DOC) -> Column:
    """estimate_seconds() of columns."""
    return F.ceil(docs * F.lit(float(ms_per_doc)) / workers(threads) / 1000).cast("long")


@dataclass(frozen=True)
class Refusal:
    """Why a request was turned down, and what would do instead."""

    kind: str
    pending: int | None
    seconds: int | None = None


def refusal(pending: int | None, threads: int, catch_up_ms: float = 585_000) -> Refusal:
    """For a backlog over the cap: unknown, within reach of an explicit catch-up, or for the operator only."""
    if pending is None:
        return Refusal("unknown-backlog", None)
    if pending <= embed_capacity(catch_up_ms, MOST_THREADS):
        return Refusal("catch-up", pending, estimate_seconds(pending, threads))
    return Refusal("operator-only", pending, estimate_seconds(pending, threads))
