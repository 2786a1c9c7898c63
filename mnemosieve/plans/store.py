"""Versions of an index: immutable Parquet segments and a commit for each version, on any file system Spark reads.

Postings and terms lie in buckets of (token, kind), a directory each, and within a bucket in ranges, or frequent words' postings in shares of the documents;
the name of a segment tells how many buckets it has. So a lookup of some tokens opens only their buckets, and no task holds a frequent word's whole list.
Documents and vectors lie as they come: ranges are drawn by a sample, for which an embedder would have to run twice.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.operators import index as ix
from mnemosieve.operators.scoring import fits
from mnemosieve.sources.tables import create_once, file_system, written

#: Tables that an update only adds to, and those that are written whole. Rows of documents that a later segment has touched count no more; of a term, the
#: latest segment's row counts, and one without documents (df 0) is none.
SEGMENTED, WHOLE = ("docs", "postings", "vectors", "terms"), ("meta",)
TABLES = (*SEGMENTED, *WHOLE)
ORDER = {"postings": ["bucket", "token", "kind", "doc_id"], "terms": ["bucket", "token", "kind"]}
BUCKETED = {"postings": "token string, kind string, doc_id {}, tf_title int, tf_content int, bucket int", "terms": "token string, kind string, df long, bucket int"}
#: Segments of a version at most; an update beyond merges them. Documents to a bucket, and buckets of a segment at most.
SEGMENTS, BUCKET_DOCS, BUCKETS = 8, 1000, 4096
#: Shares of a posting list that a shuffle deals apart.
SHARES = 32


def buckets_for(docs: int) -> int:
    """A power of two."""
    return min(BUCKETS, 1 << max(0, -(-docs // BUCKET_DOCS) - 1).bit_length())


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("token", "kind"), F.lit(buckets)).cast("int")


def share_of(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SHARES)).cast("int")


def met(rows: DataFrame, tokens: DataFrame, how: str = "inner") -> DataFrame:
    """Postings or terms joined with tokens, a written table. A frequent word's list is as long as there are documents, so no task is dealt one whole: lists stay
    where they are read or, where the tokens are too many to broadcast, come in shares of the documents."""
    key = ["token", "kind"]
    if fits(tokens):
        return rows.join(F.broadcast(tokens), key, how)
    if "doc_id" not in rows.columns:
        return rows.join(tokens, key, how)
    shares = tokens.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    return rows.withColumn("_share", share_of("doc_id")).join(shares, [*key, "_share"], how).drop("_share")


class Busy(RuntimeError):
    """Another writer published a version meanwhile."""


@dataclass
class IndexStore:
    """An index under a path. Directories have names of their own and are written whole before the commit that names them is created; the commit
    of a version can be created once only. So readers see all of a version or none, and of several writers one wins and none harms another."""

    spark: SparkSession
    path: str
    _checked: dict = field(default_factory=dict, repr=False)
    _manifests: dict = field(default_factory=dict, repr=False)

    def _fs(self, path: str):
        return file_system(self.spark, path)

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def exists(self) -> bool:
        return bool(self._names(f"{self.path}/commits"))

    def _manifest(self, version: int) -> dict | None:
        """segments and whole: directories of a version; None while its commit is being written."""
        if version not in self._manifests:
            rows = self.spark.read.text(f"{self.path}/commits/{version:012d}", wholetext=True).collect()
            try:
                self._manifests[version] = json.loads(rows[0][0])
            except (IndexError, ValueError):
                return None
        return self._manifests[version]

    def current(self) -> int | None:
        """The version readers use; nothing is created where there is none."""
        for version in sorted((int(x) for x in self._names(f"{self.path}/commits") if x.isdigit()), reverse=True):
            if self._manifest(version) is not None:
                return version
        return None

    def segments(self, version: int | None) -> list[str]:
        return [] if version is None else self._manifest(version)["segments"]

    def read(self, table: str, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        found = None if version is None else self._manifest(version)
        if found is None:
            raise FileNotFoundError(f"no index under {self.path}")
        if table in WHOLE:
            return self.spark.read.parquet(f"{self.path}/{found['whole']}/{table}")
        return self.merged(table, found["segments"])

    def table(self, segment: str, table: str, only: DataFrame | None = None) -> DataFrame:
        """A segment's own rows. only: tokens (token, kind), a small table; of the others' buckets no file is opened."""
        path = f"{self.path}/{segment}/{table}"
        if "bucket" not in ORDER.get(table, ()):
            return self.spark.read.parquet(path)
        kind = self.spark.read.parquet(f"{self.path}/{segment}/docs").schema["doc_id"].dataType.simpleString() if table == "postings" else ""
        rows = self.spark.read.schema(BUCKETED[table].format(kind)).parquet(path)  # told, since a bucketed table without rows has no file
        if only is not None:
            wanted = [r[0] for r in only.select(bucket_of(int(segment.rsplit("-", 1)[1]))).distinct().collect()]  # as many as there are buckets at most
            rows = rows.where(F.col("bucket").isin(wanted)).join(F.broadcast(only.select("token", "kind").distinct()), ["token", "kind"], "left_semi")
        return rows.drop("bucket")

    def merged(self, table: str, segments: list[str], only: DataFrame | None = None, empty_terms: bool = False) -> DataFrame:
        """A table of some segments, oldest first: without rows of documents that a later segment has touched, and with each term's latest row.
        only: tokens to look up. empty_terms: keeps terms that have lost their documents, for a merge of later segments."""
        parts, later = [], None
        key, mark = (["token", "kind"], "terms") if table == "terms" else ("doc_id", "touched")
        for name in reversed(segments):
            rows = self.table(name, table, only)
            parts.append(rows if later is None else rows.join(later, key, "left_anti").select(*rows.columns))
            own = (rows if table == "terms" else self.table(name, mark)).select(*([key] if isinstance(key, str) else key))
            later = own if later is None else later.unionByName(own)
        found = reduce(DataFrame.unionByName, parts)
        return found.where("df > 0") if table == "terms" and not empty_terms else found

    def stage(self, tables: dict[str, DataFrame], docs: int = 0, name: str | None = None, frequent: list[str] | None = None) -> str:
        """Writes tables into a directory of their own, or into one that was staged before. docs: how many documents, for the number of buckets. frequent: tokens
        whose lists are dealt apart, the others by bucket; where they aren't told, ranges are drawn by a sample, for which a table is computed twice."""
        name = name or f"d-{uuid.uuid4().hex}-{buckets_for(docs)}"
        for table, df in tables.items():
            out = df.withColumn("bucket", bucket_of(int(name.rsplit("-", 1)[1]))) if "bucket" in ORDER.get(table, ()) else df
            if table in ORDER and frequent is None:
                out = out.repartitionByRange(*ORDER[table]).sortWithinPartitions(*ORDER[table])
            elif table in ORDER:
                share = F.when(F.col("token").isin(frequent), share_of("doc_id")).otherwise(0)
                out = out.repartition("bucket", share).sortWithinPartitions(*ORDER[table])
            writer = out.write.partitionBy("bucket") if "bucket" in out.columns else out.write
            writer.parquet(f"{self.path}/{name}/{table}")
        return name

    def compacted(self, segments: list[str], docs: int) -> list[str]:
        """Fewer segments with the same rows. The first stays as it is while the later ones have touched less than half of `docs` documents."""
        touched = sum(self.table(x, "touched").count() for x in segments[1:])
        tail = segments[1:] if 2 * touched < docs else segments
        none = self.table(segments[0], "touched").limit(0)
        gone = none if tail is segments else reduce(DataFrame.unionByName, [self.table(x, "touched") for x in tail]).distinct()
        tables = {t: self.merged(t, tail, empty_terms=tail is not segments) for t in SEGMENTED}
        return [*segments[: len(segments) - len(tail)], self.stage({**tables, "touched": gone}, docs if tail is segments else touched)]

    def publish(self, segments: list[str], whole: str, expected: int | None) -> int:
        """Creates the commit after `expected`; if there is one already, another writer was faster."""
        version = (expected or 0) + 1
        if self.current() != expected:
            raise Busy(f"the index moved from version {expected} to {self.current()}")
        data = json.dumps({"segments": segments, "whole": whole}).encode()
        if not create_once(self.spark, f"{self.path}/commits/{version:012d}", data):
            raise Busy(f"another writer published version {version}")
        return version

    def discard(self) -> None:
        """Removes the index; creates nothing."""
        fs, p = self._fs(self.path)
        if fs.exists(p):
            fs.delete(p, True)
        self._checked.clear()
        self._manifests.clear()

    def keep_last(self, versions: int = 2) -> None:
        """Removes older commits, and directories that only they name. For a time without writers: what one has staged isn't named yet."""
        current = self.current() or 0
        kept = [v for v in (int(x) for x in self._names(f"{self.path}/commits")) if v > current - versions]
        named = {x for v in kept if (m := self._manifest(v)) for x in (*m["segments"], m["whole"])}
        for version in (int(x) for x in self._names(f"{self.path}/commits")):
            if version not in kept:
                fs, p = self._fs(f"{self.path}/commits/{version:012d}")
                fs.delete(p, False)
        for name in self._names(self.path):
            if name.startswith("d-") and name not in named:
                fs, p = self._fs(f"{self.path}/{name}")
                fs.delete(p, True)

    def meta(self, version: int | None = None) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.read("meta", version).collect()}

    def inspect(self, identity: str) -> str:
        """missing, unreadable, no-meta, algo-mismatch, model-mismatch, untrusted or ok. A version is immutable, so one found ok is not checked again."""
        if not self.exists():
            return "missing"
        version = self.current()
        if self._checked.get(version) == identity:
            fs, p = self._fs(f"{self.path}/{self._manifest(version)['whole']}/meta")
            return "ok" if fs.exists(p) else "unreadable"
        try:
            found = self.meta(version)
            for table in TABLES:
                self.read(table, version).limit(1).count()
        except Exception:  # noqa: BLE001  any failure to read means the same here
            return "unreadable"
        if not found:
            return "no-meta"
        if found.get("algo_version") != ix.ALGO_VERSION:
            return "algo-mismatch"
        if found.get("identity") != identity:
            return "model-mismatch"
        if ix.check(self.read("docs", version), self.read("vectors", version), self.read("meta", version)):
            return "untrusted"
        self._checked[version] = identity
        return "ok"

    def trust(self, version: int, identity: str) -> None:
        """Spares the check of a version that was written by this very store, each vector beside its document."""
        self._checked[version] = identity

    def lookup(self, table: str, tokens: DataFrame, version: int | None = None) -> DataFrame:
        """Postings or terms of some tokens (token, kind). Tokens too many to broadcast are met by a shuffle, with all buckets read."""
        segments, wanted = self.segments(self.current() if version is None else version), written(tokens.select("token", "kind").distinct(), "tokens")
        return self.merged(table, segments, wanted) if fits(wanted) else met(self.merged(table, segments), wanted, "left_semi")

    def terms_of(self, tokens: DataFrame) -> DataFrame:
        """Posting lists of some tokens (token, kind and others)."""
        tokens = written(tokens, "asked")
        return met(self.lookup("postings", tokens), tokens)

    def size(self) -> int:
        """Bytes of all files under the path."""
        fs, p = self._fs(self.path)
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
