"""Counters of a session: what was seen and written, verdicts, consistency of pools, rolling means of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnemosieve.operators.ordering import placed

FLUSH_CALLS, FLUSH_MS = 20, 60_000


def known_ids(reads: DataFrame, saves: DataFrame) -> DataFrame:
    """session_id, id: ids a session read in full, was shown, or wrote."""
    return reads.select("session_id", "id").unionByName(saves.select("session_id", "id")).distinct()


def consistency(pools: DataFrame, seen: DataFrame) -> DataFrame:
    """session_id, hits, pool: distinct pool ids, and how many of them the session had seen. pools: session_id, id; seen: session_id, id."""
    distinct = pools.select("session_id", "id").distinct()
    return distinct.join(seen.select("session_id", "id").distinct().withColumn("hit", F.lit(1)), ["session_id", "id"], "left").groupBy("session_id").agg(F.count("hit").alias("hits"), F.count(F.lit(1)).alias("pool"))


def judged(verdicts: DataFrame, known: DataFrame) -> DataFrame:
    """verdicts (verdict_id, session_id, verb, ids) with read: 'first' if every id was known, 'blind' if not, 'unknown' without a pair (ids null)."""
    ids = verdicts.where("ids is not null").select("verdict_id", "session_id", F.explode("ids").alias("id"))
    told = ids.join(known.withColumn("k", F.lit(True)), ["session_id", "id"], "left").groupBy("verdict_id").agg(F.bool_and(F.coalesce("k", F.lit(False))).alias("all_known"))
    read = F.when(F.col("ids").isNull(), "unknown").when(F.coalesce("all_known", F.lit(False)), "first").otherwise("blind")
    return verdicts.join(told, "verdict_id", "left").withColumn("read", read).drop("all_known")


def verdict_counts(rows: DataFrame) -> DataFrame:
    """session_id, verdicts (map verb to count), read_first, blind, unknown. rows: of judged()."""
    verbs = rows.groupBy("session_id", "verb").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("read") == r).alias(r) for r in ("first", "blind", "unknown")])
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("verb", "n"))))
    return verbs.groupBy("session_id").agg(entries.alias("verdicts"), F.sum("first").alias("read_first"), F.sum("blind").alias("blind"), F.sum("unknown").alias("unknown"))


def call_means(calls: DataFrame, keys: list[str]) -> DataFrame:
    """Means of each run of FLUSH_CALLS calls of a key, in order of time. calls: keys, call_id, at, value; a key's calls are spread over its runs."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("at", "call_id"))
    return calls.withColumn("run", F.floor((place - 1) / FLUSH_CALLS).cast("long")).groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("calls"), F.avg("value").alias("mean_value"))


def flushes(calls: DataFrame, keys: list[str], every: int = FLUSH_CALLS, most_ms: float = FLUSH_MS) -> DataFrame:
    """keys, calls, mean_ms, since_ms, at: the reports of a key's metering. One is due after each `every` calls, and as soon as the calls since the last
    report took most_ms; it tells the mean of all calls so far. calls: keys, call_id, at, ms.

    Since every `every`-th call reports, each run of so many calls begins with nothing on its account: runs are folded apart from each other, each in one row,
    and a key's calls are numbered and summed by ranges, whatever their number."""
    rows = placed(calls.select(*keys, "call_id", "at", F.coalesce(F.col("ms").cast("double"), F.lit(0.0)).alias("ms")), keys, ["at", "call_id"], ("ms",))
    each = F.array_sort(F.collect_list(F.struct("place", "ms", "running_ms", "at")))
    kind = rows.schema["at"].dataType.simpleString()
    none = F.array().cast(f"array<struct<calls: bigint, mean_ms: double, since_ms: double, at: {kind}>>")

    def step(state, x):
        since = state["since"] + x["ms"]
        due = (x["place"] % every == 0) | (since >= most_ms)
        told = F.struct(x["place"].alias("calls"), (x["running_ms"] / x["place"]).alias("mean_ms"), since.alias("since_ms"), x["at"].alias("at"))
        return F.struct(F.when(due, 0.0).otherwise(since).alias("since"), F.when(due, F.concat(state["out"], F.array(told))).otherwise(state["out"]).alias("out"))

    folded = F.aggregate("each", F.struct(F.lit(0.0).alias("since"), none.alias("out")), step, lambda s: s["out"])
    runs = rows.groupBy(*keys, F.floor((F.col("place") - 1) / every).alias("_run")).agg(each.alias("each"))
    return runs.select(*keys, F.inline(folded))


def totals(calls: DataFrame) -> DataFrame:
    """Cumulative totals by kind of call."""
    return calls.groupBy("kind").agg(F.count(F.lit(1)).alias("calls"), F.sum("value").alias("total_value"), F.max("at").alias("last_at"))
