"""The inverted index: documents, postings, terms, vectors and meta, and what an update changes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemosieve.functions.counts import kind_of, word_counts
from mnemosieve.functions.text import content_sha, float_text, n_tokens, text_of

#: Constants that define scores; they are kept in meta and read from there.
SCORING = {"scoring_k1": 1.2, "scoring_b": 0.2, "scoring_title_weight": 3.0, "scoring_evidence_weight": 0.25}
ALGO_VERSION = "1"
#: Postings that a task gathers before it hands them on.
TASK_ROWS = 100_000
#: Documents from which frequent tokens are told, about, and such tokens at most.
FREQUENT_DOCS = 1000
POSTING_COLUMNS = ["token", "kind", "doc_id", "tf_title", "tf_content"]
DOC_COLUMNS = ["doc_id", "updated_at", "content_sha", "title", "content", "type", "project", "scope", "title_chars", "content_chars", "n_tokens"]


def documents(snapshot: DataFrame) -> DataFrame:
    """One row a record, with its digest and lengths."""
    return snapshot.select(
        F.col("id").alias("doc_id"), "updated_at", content_sha(F.col("title"), F.col("content")).alias("content_sha"), "title", "content", "type", "project", "scope",
        F.length("title").alias("title_chars"), F.length("content").alias("content_chars"),
        (n_tokens(F.col("title")) + n_tokens(F.col("content"))).alias("n_tokens"),
    )


def counted(docs: DataFrame) -> DataFrame:
    """postings() of each row of docs by itself: a task counts a text's tokens, and nothing is shuffled."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, kinds, titles, contents, rows, sizes = [], [], [], [], [], []
            for row, (title, content) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                t, c = word_counts(title.as_py()), word_counts(data := content.as_py())
                c.update(dict.fromkeys(t.keys() - c.keys(), 0))
                keys.extend(c)
                kinds.extend(repeat(b"a", len(c)) if data.isascii() and title.as_py().isascii() else map(kind_of, c))
                contents.extend(c.values())
                titles.extend(map(t.get, c, repeat(0)))
                rows.append(row)
                sizes.append(len(c))
                if len(keys) >= TASK_ROWS or row == batch.num_rows - 1:
                    token, kind = (pa.array(x, pa.binary()).cast(pa.string()) for x in (keys, kinds))
                    ids = batch.column(0).take(pa.array(np.repeat(rows, sizes), pa.int64()))
                    yield pa.RecordBatch.from_arrays([token, kind, ids, pa.array(titles, pa.int32()), pa.array(contents, pa.int32())], POSTING_COLUMNS)
                    keys, kinds, titles, contents, rows, sizes = [], [], [], [], [], []

    rows = docs.select("doc_id", *(text_of(F.col(c)).cast("binary").alias(c) for c in ("title", "content")))
    return rows.mapInArrow(task, f"token string, kind string, doc_id {rows.schema['doc_id'].dataType.simpleString()}, tf_title int, tf_content int")


def frequent(docs: DataFrame, count: int) -> list[str]:
    """Tokens of more than a fiftieth of the documents, about, by some of `count`: no result hangs on it, only how long lists are dealt."""
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, count // FREQUENT_DOCS))) == 0)
    found = terms(counted(some)).where(F.col("df") > max(1, min(count, FREQUENT_DOCS) // 50))
    return [r["token"] for r in found.orderBy(F.desc("df"), "token").limit(FREQUENT_DOCS).collect()]


def postings(docs: DataFrame) -> DataFrame:
    """token, kind, doc_id, tf_title, tf_content. Rows meet by (token, kind, doc_id), already summed within a document."""
    return counted(docs).groupBy("token", "kind", "doc_id").agg(F.sum("tf_title").cast("int").alias("tf_title"), F.sum("tf_content").cast("int").alias("tf_content"))


def terms(posted: DataFrame) -> DataFrame:
    """token, kind, df."""
    return posted.groupBy("token", "kind").agg(F.count(F.lit(1)).alias("df"))


def avgdl(docs: DataFrame) -> DataFrame:
    """One row: the mean length in tokens, 1 where there is none."""
    mean = F.avg("n_tokens")
    return docs.agg(F.when(mean > 0, mean).otherwise(1.0).alias("avgdl"), F.count(F.lit(1)).alias("n_docs"))


def meta_totals(docs: DataFrame, posted: DataFrame, termed: DataFrame | None = None) -> DataFrame:
    """One row of totals over the index tables. termed: terms(posted), where they are a table already."""
    of_docs = docs.agg(F.count(F.lit(1)).alias("doc_count"), F.coalesce(F.sum(F.col("content_chars").cast("long")), F.lit(0)).alias("total_content_chars"))
    of_postings = posted.agg(F.count(F.lit(1)).alias("n_postings"), F.coalesce(F.sum(F.col("tf_title").cast("long")), F.lit(0)).alias("n_title_tokens"), F.coalesce(F.sum(F.col("tf_content").cast("long")), F.lit(0)).alias("n_content_tokens"))
    of_terms = (terms(posted) if termed is None else termed).agg(F.count(F.lit(1)).alias("n_terms"))
    return of_docs.join(of_postings).join(of_terms)  # three single rows


TOTALS = ["doc_count", "total_content_chars", "n_terms", "n_postings", "n_title_tokens", "n_content_tokens"]


def meta(docs: DataFrame, posted: DataFrame, source_hash: str, identity: str, termed: DataFrame | None = None) -> DataFrame:
    """key, value: the totals and the constants that define scores."""
    return meta_of(meta_totals(docs, posted, termed), source_hash, identity)


def meta_of(totals: DataFrame, source_hash: str, identity: str) -> DataFrame:
    """meta() from one row of totals."""
    fixed = {"algo_version": ALGO_VERSION, "identity": identity, "all_cjk_unigrams": "0", "source_hash": source_hash}
    pairs = [F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in TOTALS]
    pairs += [F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in fixed.items()]
    pairs += [F.struct(F.lit(k).alias("key"), float_text(F.lit(v)).alias("value")) for k, v in SCORING.items()]
    return totals.select(F.explode(F.array(*pairs)).alias("p")).select("p.key", "p.value")


def moved_terms(gone: DataFrame, come: DataFrame) -> DataFrame:
    """token, kind, change: by how many documents a term has gained or lost. gone, come: postings of the touched documents before and after."""
    count = lambda p, sign: p.groupBy("token", "kind").agg((sign * F.count(F.lit(1))).alias("n"))
    return count(gone, -1).unionByName(count(come, 1)).groupBy("token", "kind").agg(F.sum("n").alias("change")).where("change <> 0")


def updated_terms(moved: DataFrame, known: DataFrame) -> DataFrame:
    """token, kind, df_before, df of the moved terms. known: their rows (token, kind, df) as they stand; none for a term that is new."""
    before = F.coalesce(F.col("df"), F.lit(0))
    return moved.join(known.select("token", "kind", "df"), ["token", "kind"], "left").select("token", "kind", before.alias("df_before"), (before + F.col("change")).alias("df"))


def totals_after(before: dict[str, str], gone: tuple[DataFrame, DataFrame], come: tuple[DataFrame, DataFrame], terms_moved: DataFrame) -> dict[str, int]:
    """Totals after an update from those before it and what was touched. gone, come: documents and postings; terms_moved: of updated_terms()."""
    def told(docs: DataFrame, posted: DataFrame) -> dict[str, int]:
        return meta_totals(docs, posted).first().asDict()

    old, new = told(*gone), told(*come)
    opened, closed = terms_moved.agg(F.count_if((F.col("df_before") == 0) & (F.col("df") > 0)), F.count_if((F.col("df_before") > 0) & (F.col("df") == 0))).first()
    return {k: int(before[k]) - old[k] + new[k] for k in TOTALS} | {"n_terms": int(before["n_terms"]) + opened - closed}


def scoring_params(meta_rows: DataFrame) -> dict[str, float]:
    """The four constants of an index; one that is missing is an error, never a default."""
    found = {r["key"]: float(r["value"]) for r in meta_rows.where(F.col("key").isin(*SCORING)).collect()}
    if missing := set(SCORING) - set(found):
        raise ValueError(f"index meta lacks {', '.join(sorted(missing))}")
    return found


def diff(docs: DataFrame, snapshot: DataFrame) -> DataFrame:
    """doc_id, change: 'changed' for records that are new or whose updated_at or content digest moved, 'removed' for those gone."""
    want = snapshot.select(F.col("id").alias("doc_id"), F.col("updated_at").alias("u"), content_sha(F.col("title"), F.col("content")).alias("s"), F.lit(True).alias("wanted"))
    have = docs.select("doc_id", "updated_at", "content_sha", F.lit(True).alias("had"))
    both = have.join(want, "doc_id", "full")
    same = F.col("had") & F.col("wanted") & F.col("updated_at").eqNullSafe(F.col("u")) & F.col("content_sha").eqNullSafe(F.col("s"))
    return both.where(~F.coalesce(same, F.lit(False))).select("doc_id", F.when(F.col("wanted"), "changed").otherwise("removed").alias("change"))


def plan(docs: DataFrame | None, snapshot: DataFrame, stored_hash: str, new_hash: str, full: bool = False, max_docs: int | None = None) -> tuple[str, int]:
    """Mode and number of documents touched, before anything is embedded or written."""
    if full or not stored_hash or docs is None:
        mode, touched = "full", snapshot.count()
    elif stored_hash == new_hash:
        return "noop", 0
    else:
        touched = diff(docs, snapshot).count()
        mode = "incremental" if touched else "hash-only"
    return ("deferred", touched) if max_docs is not None and touched > max_docs else (mode, touched)


def apply_changes(docs: DataFrame, posted: DataFrame, snapshot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents and postings after an incremental update: rows of touched documents out, rows of changed ones in."""
    touched = diff(docs, snapshot)
    changed = documents(snapshot.join(touched.where("change = 'changed'").select(F.col("doc_id").alias("id")), "id", "left_semi"))
    kept_docs = docs.join(touched, "doc_id", "left_anti")
    kept_postings = posted.join(touched, "doc_id", "left_anti").select(*POSTING_COLUMNS)
    return kept_docs.select(*DOC_COLUMNS).unionByName(changed), kept_postings.unionByName(postings(changed))


def affected_terms(before: DataFrame, after: DataFrame, touched: DataFrame) -> DataFrame:
    """Terms of touched documents, before or after the update."""
    of = lambda p: p.join(touched.select("doc_id"), "doc_id", "left_semi").select("token", "kind")
    return of(before).unionByName(of(after)).distinct()


def repair_terms(old: DataFrame, after: DataFrame, affected: DataFrame) -> DataFrame:
    """Terms after the update: affected ones counted anew (those without postings leave), the others kept."""
    counted = terms(after.join(affected, ["token", "kind"], "left_semi"))
    return old.join(affected, ["token", "kind"], "left_anti").select("token", "kind", "df").unionByName(counted)


def check(docs: DataFrame, vectors: DataFrame, meta_rows: DataFrame) -> list[str]:
    """Why an index isn't to be trusted; empty if it is."""
    out = []
    try:
        scoring_params(meta_rows)
    except ValueError as e:
        out.append(str(e))
    dims = vectors.agg(F.count_distinct("dim").alias("dims"), F.count(F.lit(1)).alias("n")).first()
    if dims["dims"] > 1:
        out.append("vectors of several dimensions")
    if dims["n"] != docs.count():
        out.append("vectors and documents differ in number")
    if not meta_rows.where("key = 'update_prefix'").isEmpty():
        out.append("an update was left unfinished")
    return out


def vector_consistency(docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: documents, vectors, distinct dimensions, and whether they fit."""
    v = vectors.agg(F.count(F.lit(1)).alias("n_vectors"), F.count_distinct("dim").alias("n_dims"))
    return docs.agg(F.count(F.lit(1)).alias("n_docs")).join(v).withColumn("consistent", (F.col("n_docs") == F.col("n_vectors")) & (F.col("n_dims") <= 1))
