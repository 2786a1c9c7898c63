"""A write sink that applies each batch, and within all batches each request, once.

The ledger under a path has a directory of rows for each batch: key, status, failure, written_id, outcome. A batch's rows are written by the job that sends its
requests, and count once the batch's commit has been created, which can happen once only. A batch that comes again, as streams do after a failure, is known by
its commit and sends nothing. Where a run died between sending and committing, its batch is sent again: requests carry their key, by which the other end knows
them (http_sender sends it as a header). A request with a final outcome in an earlier batch isn't sent again, whatever batch it comes in.
"""

from __future__ import annotations

import json
import socket
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.sources.observations import write_outcome
from mnemosieve.sources.tables import create_once, file_system

#: Outcomes after which a request may be sent again: it can't have been written. After a timeout it may have been.
RETRIED = ("connection", "server")
ANSWER = "status int, failure string, written_id long"


@dataclass
class WriteSink:
    """send: requests to (key, status, failure, written_id), a row each; it runs within the job that writes the ledger. key: the column that names a
    request; order: by which of a batch's requests with one key the first is taken."""

    spark: SparkSession
    path: str
    send: Callable[[DataFrame], DataFrame]
    key: str = "request_id"
    order: str = "seq"
    retried: tuple[str, ...] = RETRIED

    def _batches(self, folder: str) -> set[int]:
        fs, p = file_system(self.spark, f"{self.path}/{folder}")
        return {int(s.getPath().getName().split("=")[-1]) for s in fs.listStatus(p) if s.getPath().getName().split("=")[-1].isdigit()} if fs.exists(p) else set()

    def ledger(self) -> DataFrame | None:
        """Rows of all committed batches, with batch; None before the first."""
        done = self._batches("commits")
        if not done:
            return None
        left = self._batches("rows") - done  # begun and not committed: the latest, at most
        rows = self.spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows")
        return rows.where(~F.col("batch").isin(*left)) if left else rows

    def outcomes(self) -> DataFrame:
        """key, outcome, written_id, attempts: the latest word on each request. A request is sent again only after an outcome that may be retried."""
        rows = self.ledger()
        if rows is None:
            raise FileNotFoundError(f"no batch was committed under {self.path}")
        latest = rows.groupBy(self.key).agg(F.max_by(F.struct("outcome", "written_id"), "batch").alias("r"), F.count(F.lit(1)).alias("attempts"))
        return latest.select(self.key, "r.outcome", "r.written_id", "attempts")

    def apply(self, batch: DataFrame, batch_id: int) -> dict:
        """Sends what is new in a batch and commits it. The result tells how many requests were sent, or that the batch was known."""
        if batch_id in self._batches("commits"):
            return {"batch": batch_id, "sent": 0, "known": True}
        rows = batch.where(F.col(self.key).isNotNull())
        rest = [c for c in batch.columns if c != self.key]
        first = rows.groupBy(self.key).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in rest)), self.order).alias("_r")).select(self.key, "_r.*")
        if (past := self.ledger()) is not None:
            first = first.join(past.where(~F.col("outcome").isin(*self.retried)).select(self.key), self.key, "left_anti")
        answers = self.send(first).select(self.key, "status", "failure", "written_id")
        told = answers.withColumn("outcome", write_outcome(F.col("status"), F.col("failure"), F.col("written_id")))
        target = f"{self.path}/rows/batch={batch_id}"
        told.write.mode("overwrite").parquet(target)  # in place of what a run left that died before its commit
        sent = self.spark.read.parquet(target).count()
        if not create_once(self.spark, f"{self.path}/commits/{batch_id}", json.dumps({"sent": sent}).encode()):
            return {"batch": batch_id, "sent": 0, "known": True}
        return {"batch": batch_id, "sent": sent, "known": False}

    def run(self, requests: DataFrame, checkpoint: str):
        """The sink of a stream: everything available, batch by batch."""
        return requests.writeStream.foreachBatch(lambda df, n: self.apply(df, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def http_sender(endpoint: str, timeout_s: float, key: str = "request_id", parallel: int | None = None) -> Callable[[DataFrame], DataFrame]:
    """Posts each request as JSON, one after another within a task. parallel: connections at most. The key goes along as Idempotency-Key."""
    def posted(name: object, body: dict) -> tuple[int | None, str | None, int | None]:
        data = json.dumps({k: v for k, v in body.items() if v is not None and v == v}, default=str).encode()
        request = urllib.request.Request(endpoint, data, {"content-type": "application/json", "idempotency-key": str(name)}, method="POST")
        try:
            with urllib.request.urlopen(request, timeout=timeout_s) as answer:
                status, text = answer.status, answer.read()
        except urllib.error.HTTPError as e:
            return e.code, None, None
        except (TimeoutError, socket.timeout):
            return None, "timeout", None
        except urllib.error.URLError as e:
            return None, "timeout" if isinstance(e.reason, TimeoutError) else "connection", None
        except OSError:
            return None, "connection", None
        try:
            found = json.loads(text)["id"]
            return status, None, found if isinstance(found, int) and not isinstance(found, bool) else None
        except (ValueError, KeyError, TypeError):
            return status, None, None  # written, though nobody says under which id

    def send(requests: DataFrame) -> DataFrame:
        kind = requests.schema[key].dataType.simpleString()

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = [(r[key], *posted(r[key], {k: v for k, v in r.items() if k != key})) for r in frame.to_dict("records")]
                out = pd.DataFrame(rows, columns=[key, "status", "failure", "written_id"])
                yield out.astype({"status": "Int32", "written_id": "Int64"})

        return (requests.coalesce(parallel) if parallel else requests).mapInPandas(run, f"`{key}` {kind}, {ANSWER}")

    return send
