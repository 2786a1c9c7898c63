"""The engine: keeps an index current, answers retrievals, finds candidates for records about to be written.

An update reads what it touches: the old documents of the touched ids, from which their old postings follow, and the terms of these and of the new ones,
by buckets. Totals and document frequencies move by the difference; no posting list of another document is read.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.functions.text import document_text
from mnemosieve.functions.vectors import hash_embedding
from mnemosieve.operators import index as ix
from mnemosieve.operators import lexical as lx
from mnemosieve.operators import retrieval as rt
from mnemosieve.operators import scoring as sc
from mnemosieve.operators.passes import Passes
from mnemosieve.plans.embedding import watched
from mnemosieve.plans.store import SEGMENTS, IndexStore
from mnemosieve.sources.observations import active_snapshot, side_columns, snapshot_digest
from mnemosieve.sources.tables import written

log = logging.getLogger(__name__)


class Embedder(Protocol):
    """Turns texts into unit vectors of one dimension. identity names the generation of its vectors."""

    identity: str
    dimension: int

    def embed(self, text: Column) -> Column: ...


@dataclass(frozen=True)
class HashEmbedder:
    """Vectors from a text's digest: no meaning, but exact, and inside the JVM."""

    dimension: int = 64

    @property
    def identity(self) -> str:
        return f"hash-{self.dimension}"

    def embed(self, text: Column) -> Column:
        return hash_embedding(text, self.dimension)


class SyncNeeded(RuntimeError):
    """More documents are pending than a request may catch up on."""

    def __init__(self, mode: str, pending: int) -> None:
        super().__init__(f"{pending} documents are pending ({mode})")
        self.mode, self.pending = mode, pending


class Disabled(RuntimeError):
    """Retrieval is switched off; nothing was retrieved, and nothing else takes its place."""


@dataclass
class Engine:
    """One index over one source of records. enabled: whether callers may retrieve and catch up; sync and rebuild, by which an operator repairs an index,
    don't ask."""

    spark: SparkSession
    path: str
    embedder: Embedder = field(default_factory=HashEmbedder)
    ranking: sc.Ranking = field(default_factory=sc.Ranking)
    max_docs: int | None = None
    shown: int = 5
    enabled: bool = True

    def __post_init__(self) -> None:
        if 0 < self.ranking.top_k < self.shown:
            raise ValueError("the pool must hold at least as many documents as are shown")
        self.store = IndexStore(self.spark, self.path)
        self.totals = {"syncs": 0, "docs_touched": 0, "queries": 0}

    def plan(self, records: DataFrame, full: bool = False) -> tuple[str, int]:
        """What a sync would do; embeds and writes nothing."""
        snapshot = active_snapshot(records)
        whole = full or self.store.inspect(self.embedder.identity) != "ok"
        if whole:
            return "full", snapshot.count()
        return ix.plan(self.store.read("docs"), snapshot, self.store.meta().get("source_hash", ""), snapshot_digest(snapshot))

    def sync(self, records: DataFrame, full: bool = False, unlimited: bool = False, only: DataFrame | None = None, on_progress: Callable[[int, int], None] | None = None) -> dict:
        """Brings the index up to the source. Over max_docs nothing is embedded or written. The source is read once, into a table from which digest,
        difference and documents come. An update writes a segment of the documents it touches. only: ids (id) outside of which nothing has changed.
        on_progress: told (documents embedded, of so many) while an embedder that counts is at work. The result has the metering of the sync."""
        at = time.perf_counter()
        out = self._synced(records, full, unlimited, only, on_progress)
        return out | {"sync_ms": 1000 * (time.perf_counter() - at), "index_bytes": self.store.size()}

    def _synced(self, records: DataFrame, full: bool, unlimited: bool, only: DataFrame | None, on_progress: Callable[[int, int], None] | None) -> dict:
        begun = self.store.current()
        whole = full or self.store.inspect(self.embedder.identity) != "ok"
        snapshot = active_snapshot(records)
        if only is not None and not whole:
            snapshot = written(snapshot.join(only, "id", "left_semi"), "snapshot")
            return {"hash_ms": 0.0, "rows_scanned": snapshot.count()} | self._touch(snapshot, begun, unlimited, only, on_progress=on_progress)
        at = time.perf_counter()
        snapshot = written(snapshot, "snapshot")
        new_hash = snapshot_digest(snapshot)
        told = {"hash_ms": 1000 * (time.perf_counter() - at), "rows_scanned": int(new_hash.split("-")[0])}
        stored = "" if whole else self.store.meta(begun).get("source_hash", "")
        if not whole and stored == new_hash:
            return told | {"mode": "noop", "docs_touched": 0, "embed_docs": 0, "source_changed": False, "version": begun, "doc_count": int(self.store.meta(begun)["doc_count"])}
        if not whole:
            return told | self._touch(snapshot, begun, unlimited, None, new_hash, stored, on_progress)
        mode, touched = ix.plan(None, snapshot, "", new_hash, True, None if unlimited else self.max_docs)
        if mode == "deferred":
            raise SyncNeeded("full", touched)
        ordered = snapshot.repartitionByRange("id").sortWithinPartitions("id")  # before documents and vectors are made, so that the sample costs ids only
        segment = self._staged(ix.documents(ordered), touched, None, on_progress)
        posted = self.store.table(segment, "postings")
        self.store.stage({"terms": ix.terms(posted)}, name=segment)
        meta = ix.meta(self.store.table(segment, "docs"), posted, new_hash, self.embedder.identity, self.store.table(segment, "terms"))
        return told | self._commit([segment], begun, meta, "full", touched, stored != new_hash) | {"embed_docs": touched, "doc_count": touched}

    def _staged(self, docs: DataFrame, count: int, touched: DataFrame | None, on_progress: Callable[[int, int], None] | None) -> str:
        """Writes a segment but for its terms. Vectors come first: where embedding fails, there is no half of anything."""
        with watched(self.embedder, count, on_progress):
            segment = self.store.stage({"vectors": self._vectors(docs)}, count)
        self.store.stage({"docs": docs, "touched": docs.select("doc_id").limit(0) if touched is None else touched}, name=segment)
        kept = self.store.table(segment, "docs")
        # where ids are unique, a document's postings are whole as its task counts them, and are shuffled once only, into their buckets
        twice = kept.groupBy("doc_id").count().where("count > 1").limit(1).count()
        return self.store.stage({"postings": ix.postings(kept) if twice else ix.counted(kept)}, name=segment, frequent=ix.frequent(kept, count))

    def _touch(self, snapshot: DataFrame, begun: int, unlimited: bool, only: DataFrame | None, new_hash: str | None = None, stored: str | None = None, on_progress: Callable[[int, int], None] | None = None) -> dict:
        """An update by the difference between the index and the snapshot, or between their parts with some ids."""
        old = self.store.read("docs", begun)
        part = old if only is None else old.join(only.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
        changes = written(ix.diff(part, snapshot), "changes")
        touched = changes.count()
        before = self.store.meta(begun)
        if not unlimited and self.max_docs is not None and touched > self.max_docs:
            raise SyncNeeded("incremental", touched)
        changed = stored != new_hash or bool(touched)
        if not touched and new_hash is None:
            return {"mode": "noop", "docs_touched": 0, "embed_docs": 0, "source_changed": changed, "version": begun, "doc_count": int(before["doc_count"])}
        if not touched:
            meta = self._meta({k: int(before[k]) for k in ix.TOTALS}, new_hash)
            return self._commit(self.store.segments(begun), begun, meta, "hash-only", 0, True) | {"embed_docs": 0, "doc_count": int(before["doc_count"])}
        gone = written(part.join(changes.select("doc_id"), "doc_id", "left_semi"), "gone")
        fresh = written(ix.documents(snapshot.join(changes.where("change = 'changed'").select(F.col("doc_id").alias("id")), "id", "left_semi")), "fresh")
        embedded = fresh.count()
        segment = self._staged(fresh, embedded, changes.select("doc_id"), on_progress)
        gone_postings, come_postings = written(ix.postings(gone), "gone-postings"), self.store.table(segment, "postings")
        moved = written(ix.moved_terms(gone_postings, come_postings), "moved")
        terms = written(ix.updated_terms(moved, self.store.lookup("terms", moved, begun)), "terms")
        self.store.stage({"terms": terms.select("token", "kind", "df")}, name=segment)
        totals = ix.totals_after(before, (gone, gone_postings), (fresh, come_postings), terms)
        segments = [*self.store.segments(begun), segment]
        if len(segments) > SEGMENTS:
            segments = self.store.compacted(segments, totals["doc_count"])
        # "partial": the source as a whole hasn't been read; the next whole sync compares by the difference
        meta = self._meta(totals, new_hash or "partial")
        return self._commit(segments, begun, meta, "incremental", touched, changed) | {"embed_docs": embedded, "doc_count": totals["doc_count"]}

    def _meta(self, totals: dict[str, int], source_hash: str) -> DataFrame:
        row = self.spark.createDataFrame([tuple(totals[k] for k in ix.TOTALS)], ", ".join(f"{k} long" for k in ix.TOTALS))
        return ix.meta_of(row, source_hash, self.embedder.identity)

    def _commit(self, segments: list[str], begun: int | None, meta: DataFrame, mode: str, touched: int, changed: bool) -> dict:
        version = self.store.publish(segments, self.store.stage({"meta": meta}), begun)
        self.store.trust(version, self.embedder.identity)
        self.totals["syncs"] += 1
        self.totals["docs_touched"] += touched
        return {"mode": mode, "docs_touched": touched, "source_changed": changed, "version": version}

    def _vectors(self, docs: DataFrame) -> DataFrame:
        text = document_text(F.col("title"), F.col("content"))
        return docs.select("doc_id", F.lit(self.embedder.identity).alias("model"), F.lit(self.embedder.dimension).alias("dim"), self.embedder.embed(text).alias("vec"))

    def catch_up(self, records: DataFrame, unlimited: bool = False, on_progress: Callable[[int, int], None] | None = None) -> dict:
        """A caller's sync."""
        self._ask()
        return self.sync(records, unlimited=unlimited, on_progress=on_progress)

    def _ask(self) -> None:
        if not self.enabled:
            raise Disabled("retrieval is switched off")

    def rebuild(self, records: DataFrame) -> dict:
        return self.sync(records, full=True, unlimited=True)

    def asked(self, queries: DataFrame, version: int | None = None) -> tuple[DataFrame, DataFrame, Callable[[DataFrame | None], DataFrame]]:
        """queries with their vectors and the candidates in lexical order, each as a table, since they are read several times; and what gives the matches, of
        all documents or of some (doc_id). queries: query_id, query and, optionally, vec."""
        docs = self.store.read("docs", version)
        params = ix.scoring_params(self.store.read("meta", version))
        told = ix.avgdl(docs).first()
        if "vec" not in queries.columns:
            queries = queries.withColumn("vec", self.embedder.embed(F.col("query")))
        queries = written(queries.select("query_id", "query", "vec"), "queries")
        tokens = written(sc.query_tokens(queries), "asked")
        wanted = written(sc.with_idf(tokens, self.store.lookup("terms", tokens, version), told["n_docs"]), "wanted")
        posted = self.store.lookup("postings", wanted, version)

        def matches(shown: DataFrame | None = None) -> DataFrame:
            some = posted if shown is None else posted.join(sc.small(shown.select("doc_id").distinct()), "doc_id", "left_semi")
            return sc.matches(docs, some, wanted, told["avgdl"], params)

        if sc.fits(wanted):
            numbers = lx.numbered(tokens)
            lexical = lx.candidates(lx.gathered(docs, posted, numbers), wanted, numbers, told["avgdl"], self.ranking.coverage, params)
        else:
            lexical = sc.lexical_scores(matches(), wanted, self.ranking.coverage, params)
        return queries, written(lexical, "lexical"), matches

    def ranked(self, queries: DataFrame, version: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Scores of every document for each query, the candidates in lexical order, and the matches."""
        queries, lexical, matches = self.asked(queries, version)
        docs, vectors = self.store.read("docs", version), self.store.read("vectors", version)
        scores = sc.boosted(sc.cosines(docs, vectors, queries), sc.pool(lexical, self.ranking.top_k), self.ranking.weight)
        return written(scores, "scores"), lexical, matches()

    def recall(self, queries: DataFrame, request: rt.Request, records: DataFrame | None = None) -> dict[str, DataFrame]:
        """hits, summary and, where a type filter matched nothing, available_types. With records the index is caught up first; failures are raised."""
        self._ask()
        if records is not None:
            self.sync(records)
        docs, vectors = self.store.read("docs"), self.store.read("vectors")
        queries, lexical, _ = self.asked(queries)
        self.totals["queries"] += 1
        hits = written(rt.recalled(docs, vectors, queries, sc.pool(lexical, self.ranking.top_k), request, self.ranking.weight), "hits")
        types = rt.available_types(docs) if request.type and hits.isEmpty() else rt.available_types(docs.limit(0))
        return {"hits": hits, "summary": rt.recall_summary(docs, queries, request, lexical, self.ranking.top_k), "available_types": types}

    def candidates(self, requests: DataFrame, records: DataFrame) -> dict[str, DataFrame] | None:
        """Candidates with evidence from the index as it stands; None if that can't be had. requests: query_id, title, content, type, topic_key, session_id, project."""
        try:
            if self.store.inspect(self.embedder.identity) != "ok":
                return None
            docs, vectors = self.store.read("docs"), self.store.read("vectors")
            queries, lexical, matches = self.asked(requests.withColumn("query", document_text(F.col("title"), F.col("content"))))
            members = sc.pool(lexical, self.ranking.top_k)
            passes = Passes(docs, vectors, queries.join(requests.select("query_id", "project"), "query_id"), members, self.ranking.weight)
            shown, filtered_out = rt.candidates(passes, self.shown)
            shown = written(shown, "shown")
            shared = sc.shared_rare_terms(matches(shown), shown, rt.SHARED_TERMS)
            extras = side_columns(records, shown.select(F.col("doc_id").alias("id")))
            return {
                "candidates": rt.evidence(shown, docs, requests, shared, extras), "filtered_out": filtered_out, "lag": rt.index_lag(docs, active_snapshot(records)),
                "pool": rt.pool_ids(passes, self.ranking.top_k),
            }
        except Exception:  # noqa: BLE001  candidates never stand in the way of a write
            log.exception("no candidates")
            return None
