"""Event streams: once-only capture, session counters, and an index kept from a change feed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemosieve.functions.text import blank, has_learnings_section
from mnemosieve.plans.engine import Engine
from mnemosieve.sources.tables import written


def capture(texts: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Texts that aren't blank, once for each (session_id, turn). The blank ones go before the latch; its state is dropped `delay` after a turn.
    texts: streaming, session_id, turn, text, at."""
    return texts.where(~blank(F.col("text"))).withWatermark("at", delay).dropDuplicatesWithinWatermark(["session_id", "turn"]).withColumn("has_learnings", has_learnings_section(F.col("text")))


def warnings(broken: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One warning for each (session_id, type) of a stream of broken payloads (with at)."""
    return broken.withWatermark("at", delay).dropDuplicatesWithinWatermark(["session_id", "type"])


def counters(events: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Events of each user and type by hour, closed by the watermark. events: streaming, ts, user_id, event_type, value."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", window), "user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"))


def keep_index(engine: Engine, changes: DataFrame, source: Callable[[], DataFrame], checkpoint: str):
    """Runs a sync of the ids (id) of each micro-batch of a change feed. Their records are read anew, so a repeated batch changes nothing; the others
    aren't compared, and the batch's documents become a segment."""
    def apply(batch: DataFrame, _: int) -> None:
        ids = written(batch.select("id").distinct(), "fed")
        if not ids.isEmpty():
            engine.sync(source(), unlimited=True, only=ids)

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_once(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Everything available, appended to a table at path, which is read back."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


INSTRUMENTS = "session_id string, read_first long, blind long, unknown long, verdicts map<string, long>"


#: Milliseconds after which the state of a session without events is dropped.
IDLE_MS = 24 * 3_600_000


def instruments(events: DataFrame, idle_ms: int | None = IDLE_MS) -> DataFrame:
    """Counters of each session as they stand after each micro-batch. events: streaming, session_id, seq, kind (read, saved, verdict or end), ids, verb.
    A session's ids and counts are its state, dropped when it ends or is idle for long; a verdict without ids leaves open what was read first.
    idle_ms: None for a run that is to end by itself (a trigger of what is available), since timeouts always call for another batch."""
    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known, counts, verbs = state.get if state.exists else ([], [0, 0, 0], [])
        known, counts, verdicts = set(known), list(counts), dict.fromkeys(verbs[::2], 0) | {v: int(n) for v, n in zip(verbs[::2], verbs[1::2], strict=True)}
        ended = False
        for row in pd.concat(frames).sort_values("seq").itertuples():
            ids = None if row.ids is None else [int(i) for i in row.ids]
            if row.kind in ("read", "saved"):
                known |= set(ids or ())
            elif row.kind == "verdict":
                verdicts[row.verb] = verdicts.get(row.verb, 0) + 1
                counts[2 if ids is None else 0 if ids and known.issuperset(ids) else 1] += 1
            ended |= row.kind == "end"
        if ended:
            state.remove()
        else:
            state.update((sorted(known), counts, [x for v, n in sorted(verdicts.items()) for x in (v, str(n))]))
            if idle_ms is not None:
                state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"session_id": [key[0]], "read_first": [counts[0]], "blind": [counts[1]], "unknown": [counts[2]], "verdicts": [verdicts]})

    rows = events.select("session_id", "seq", "kind", "ids", "verb")
    return rows.groupBy("session_id").applyInPandasWithState(update, INSTRUMENTS, "known array<long>, counts array<long>, verbs array<string>", "update", "NoTimeout" if idle_ms is None else "ProcessingTimeTimeout")


REPORTS = "session_id string, opened_at long, last_at long, read_first long, blind long, unknown long, verdicts map<string, long>, reason string"


class Episode:
    """What a session has seen and judged since it was opened."""

    def __init__(self, kept: tuple | None = None) -> None:
        self.opened, self.last, known, self.counts, verbs = kept or (None, None, [], [0, 0, 0], [])
        self.known, self.counts = set(known), list(self.counts)
        self.verdicts = {v: int(n) for v, n in zip(verbs[::2], verbs[1::2], strict=True)}

    def take(self, at: int, kind: str, ids: list[int] | None, verb: str | None) -> None:
        self.opened, self.last = at if self.opened is None else self.opened, at if self.last is None else max(self.last, at)
        if kind in ("read", "saved"):
            self.known |= set(ids or ())
        elif kind == "verdict":
            self.verdicts[verb] = self.verdicts.get(verb, 0) + 1
            self.counts[2 if ids is None else 0 if ids and self.known.issuperset(ids) else 1] += 1

    def kept(self) -> tuple:
        return self.opened, self.last, sorted(self.known), self.counts, [x for v, n in sorted(self.verdicts.items()) for x in (v, str(n))]

    def report(self, session: str, reason: str) -> tuple:
        return session, self.opened, self.last, *self.counts, dict(sorted(self.verdicts.items())), reason


def session_reports(events: DataFrame, idle_ms: int, delay: str = "1 hour") -> DataFrame:
    """One row for each episode of a session, when it is over: at an event of kind 'end', or when no event has come for idle_ms, by event time. The timer is set
    to the last event and fires when the watermark has passed it; an event that comes later than idle_ms after the last opens an episode of its own even if
    both come in one batch, so reports don't depend on batches. events: streaming, session_id, seq, at (timestamp), kind (read, saved, verdict or end), ids, verb.
    State: the ids and counts of open episodes. A session's events are taken in order of time within a batch; a batch may not be later than `delay`."""
    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        episode, out = Episode(state.get if state.exists else None), []
        if state.hasTimedOut:
            out.append(episode.report(key[0], "idle"))
            episode = Episode()
        else:
            for row in pd.concat(frames).sort_values(["ms", "seq"]).itertuples():
                if episode.last is not None and row.ms - episode.last >= idle_ms:
                    out.append(episode.report(key[0], "idle"))
                    episode = Episode()
                episode.take(int(row.ms), row.kind, None if row.ids is None else [int(i) for i in row.ids], row.verb)
                if row.kind == "end":
                    out.append(episode.report(key[0], "end"))
                    episode = Episode()
        if episode.last is None:
            state.remove()
        else:
            state.update(episode.kept())
            state.setTimeoutTimestamp(max(episode.last + idle_ms, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=["session_id", "opened_at", "last_at", "read_first", "blind", "unknown", "verdicts", "reason"])

    rows = events.withWatermark("at", delay).select("session_id", "seq", "at", F.unix_millis("at").alias("ms"), "kind", "ids", "verb")
    kept = "opened long, last long, known array<long>, counts array<long>, verbs array<string>"
    return rows.groupBy("session_id").applyInPandasWithState(update, REPORTS, kept, "append", "EventTimeTimeout")


def idle_sessions(calls: DataFrame, idle: str, delay: str = "10 minutes") -> DataFrame:
    """Connections given up when no call has come for `idle`, each once, when the watermark has passed that time. calls: streaming, workspace, at."""
    windowed = calls.withWatermark("at", delay).groupBy(F.session_window("at", idle), "workspace").agg(F.count(F.lit(1)).alias("calls"), F.max("at").alias("last_used"))
    return windowed.select("workspace", F.col("session_window.start").alias("opened_at"), "last_used", F.col("session_window.end").alias("reclaimed_at"), "calls")
