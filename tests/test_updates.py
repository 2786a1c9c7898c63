"""Embedding in slices, updates that read what they touch, lookups by bucket, and the write sink."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemosieve.operators import index as ix
from mnemosieve.operators import passes
from mnemosieve.operators import retrieval as rt
from mnemosieve.plans import store as st
from mnemosieve.plans.embedding import BatchEmbedder, HashedWords, hashed_words
from mnemosieve.plans.engine import Disabled, Engine, HashEmbedder
from mnemosieve.plans.saving import rendered_recall
from mnemosieve.plans.sink import WriteSink, http_sender
from tests.test_engine import record, table


def vectors_of(spark, embedder, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").repartition(3)
    return {r["i"]: r["v"] for r in df.select("i", embedder.embed(F.col("text")).alias("v")).collect()}


def test_slices_change_no_vector(spark):
    texts = [f"word{i % 7} text {'读层' * (i % 3)}" for i in range(100)] + ["", None]
    one, two, three = (vectors_of(spark, hashed_words(spark, 16, n), texts) for n in (1, 32, 1000))
    assert one == two == three
    assert one[100] == one[101] == [0.0] * 16 and abs(np.linalg.norm(one[0]) - 1) < 1e-6


def test_words_in_common_point_the_same_way():
    v = HashedWords(64)(["alpha beta gamma", "alpha beta delta", "other words here"])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert v[0] @ v[1] > 0.4 > abs(v[0] @ v[2])


def test_progress_of_a_sync(spark, tmp_path):
    engine, told = Engine(spark, f"file://{tmp_path}/a", hashed_words(spark, 8)), []
    out = engine.sync(table(spark, [record(i, f"title {i}", f"words {i}") for i in range(100)]), on_progress=lambda done, total: told.append((done, total)))
    assert told[-1] == (100, 100) and [d for d, _ in told] == sorted(d for d, _ in told) and engine.embedder.done.value >= 100
    assert out["embed_docs"] == out["rows_scanned"] == out["doc_count"] == 100 and out["sync_ms"] >= out["hash_ms"] > 0 and out["index_bytes"] > 0
    told.clear()
    assert engine.sync(table(spark, [record(i, f"title {i}", f"words {i}") for i in range(99)]))["embed_docs"] == 0 and not told
    other = Engine(spark, f"file://{tmp_path}/b", HashEmbedder(8))
    other.sync(table(spark, [record(1)]), on_progress=lambda done, total: told.append((done, total)))
    assert told == [(1, 1)]  # an embedder that doesn't count


@pytest.mark.parametrize("broken", [lambda t: np.ones((len(t) + 1, 4)), lambda t: np.ones((len(t), 3)), lambda t: np.full((len(t), 4), np.nan)])
def test_a_failed_embedding_leaves_the_index_alone(spark, tmp_path, broken):
    path = f"file://{tmp_path}/a"
    Engine(spark, path, BatchEmbedder(spark, lambda t: np.ones((len(t), 4)), 4, "m")).sync(table(spark, [record(1)]))
    engine = Engine(spark, path, BatchEmbedder(spark, broken, 4, "m"))
    with pytest.raises(Exception, match="the model gave"):
        engine.sync(table(spark, [record(1), record(2)]))
    assert engine.store.current() == 1 and engine.store.read("docs").count() == 1


def test_an_update_reads_what_it_touches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "BUCKET_DOCS", 2)
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4))
    rows = {i: record(i, f"title{i}", f"common text number{i} 读层", updated="a") for i in range(40)}
    engine.sync(table(spark, list(rows.values())))
    base, read, real = engine.store.segments(1)[0], [], st.IndexStore.table

    def noted(self, segment, name, only=None):
        found = real(self, segment, name, only)
        read.append((segment, name, only is None))
        return found

    monkeypatch.setattr(st.IndexStore, "table", noted)
    rows[3] = record(3, "title3", "common changed words", updated="b")
    rows.pop(9)
    assert engine.sync(table(spark, list(rows.values())))["docs_touched"] == 2
    assert {(n, whole) for s, n, whole in read if s == base} == {("docs", True), ("touched", True), ("terms", False)}
    monkeypatch.undo()
    other = Engine(spark, f"file://{tmp_path}/b", HashEmbedder(4))
    other.sync(table(spark, list(rows.values())))
    for name in ("docs", "postings", "terms", "vectors", "meta"):
        a, b = engine.store.read(name), other.store.read(name)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), name


def test_later_segments_are_merged_alone(spark, tmp_path, monkeypatch):
    from mnemosieve.plans import engine as module

    monkeypatch.setattr(module, "SEGMENTS", 2)
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4))
    rows = {i: record(i, f"title{i}", f"word{i}", updated="a") for i in range(40)}
    engine.sync(table(spark, list(rows.values())))
    base = engine.store.segments(1)
    for step in range(4):
        rows[step] = record(step, "", f"other{step}", updated=f"b{step}")
        rows.pop(39 - step)
        engine.sync(table(spark, list(rows.values())))
    assert engine.store.segments(engine.store.current())[:1] == base and len(engine.store.segments(engine.store.current())) <= 2
    other = Engine(spark, f"file://{tmp_path}/b", HashEmbedder(4))
    other.sync(table(spark, list(rows.values())))
    for name in ("docs", "postings", "terms", "meta"):
        a, b = engine.store.read(name), other.store.read(name)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), name


def files_read(df):
    """Files that the scans of a finished query have opened."""
    def leaves(plan):
        children = plan.children()
        return [plan] if children.isEmpty() else [x for i in range(children.length()) for x in leaves(children.apply(i))]

    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return sum(x.metrics().apply("numFiles").value() for x in leaves(execution.executedPlan()) if x.metrics().contains("numFiles"))


def test_a_lookup_opens_its_buckets_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "BUCKET_DOCS", 2)
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4))
    engine.sync(table(spark, [record(i, f"title{i}", f"text number{i} more{i}") for i in range(60)]))
    segment = engine.store.segments(1)[0]
    assert segment.endswith("-32")
    asked = spark.createDataFrame([("number7", "a")], "token string, kind string")
    found = engine.store.terms_of(asked)
    assert [r["doc_id"] for r in found.collect()] == [7]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        few, all_ = files_read(engine.store.table(segment, "postings", asked)), files_read(engine.store.table(segment, "postings"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < few <= all_ / 8
    missing = spark.createDataFrame([("nowhere", "a")], "token string, kind string")
    assert engine.store.terms_of(missing).count() == 0 and engine.store.terms_of(missing.limit(0)).count() == 0


def test_a_lookup_deals_no_whole_list_to_a_task(spark, tmp_path, monkeypatch):
    """Tokens meet their lists where these are read or, where they are too many to broadcast, in shares of the documents."""
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4))
    engine.sync(table(spark, [record(i, f"title{i}", "common 读层 text") for i in range(60)]))
    asked = spark.createDataFrame([(q, t, k) for q in range(3) for t, k in (("common", "a"), ("读层", "b"), ("title7", "a"))], "query_id long, token string, kind string")
    want = sorted([(q, t, i) for q in range(3) for t in ("common", "读层") for i in range(60)] + [(q, "title7", 7) for q in range(3)])
    told = lambda df: sorted((r["query_id"], r["token"], r["doc_id"]) for r in df.collect())
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = engine.store.terms_of(asked)
        assert told(found) == want and "SortMergeJoin" not in found._jdf.queryExecution().toString()
        monkeypatch.setattr(st, "fits", lambda df: False)
        found = engine.store.terms_of(asked)
        assert told(found) == want and "_share" in found._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_frequent_words_are_dealt_apart(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        engine.sync(table(spark, [record(i, f"title{i}", f"common number{i}") for i in range(200)]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    docs = engine.store.read("docs")
    assert ix.frequent(docs, 200) == ["common"]
    files = engine.store.read("postings").where("token = 'common'").select(F.input_file_name()).distinct().count()
    assert engine.store.read("postings").count() == 600 and files > 1


def test_postings_of_odd_texts(spark, tmp_path, monkeypatch):
    """Counted in tasks, they are those of the tokens as columns; rows of one id are added up."""
    from mnemosieve.functions.text import n_tokens, tokens

    monkeypatch.setattr(ix, "TASK_ROWS", 3)
    texts = ["", None, "a", "Ab ab AB", "读", "读层 读 层abc读层架", "\u212aelvin \u0130x straße", "x" * 90, "\U00020000\U00020001 \U00020000", "tail 9 99 é1é22"]
    rows = [(i // 2, texts[-i - 1], t) for i, t in enumerate(texts)]  # two rows an id
    docs = spark.createDataFrame(rows, "doc_id long, title string, content string").repartition(3)
    each = docs.select("doc_id", F.lit(1).alias("f"), F.inline(tokens(F.col("title")))).unionByName(docs.select("doc_id", F.lit(0).alias("f"), F.inline(tokens(F.col("content")))))
    want = each.groupBy("token", "kind", "doc_id").agg(F.sum("f").cast("int"), F.sum(1 - F.col("f")).cast("int"))
    assert sorted(map(tuple, ix.postings(docs).collect())) == sorted(map(tuple, want.collect()))
    assert docs.where(n_tokens(F.col("content")) != F.size(tokens(F.col("content")))).count() == 0
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4))
    engine.sync(table(spark, [record(1, "one", "word two"), record(1, "one", "word"), record(2, "two", "word")]))
    got = {(r["token"], r["doc_id"]): (r["tf_title"], r["tf_content"]) for r in engine.store.read("postings").collect()}
    assert got == {("one", 1): (2, 0), ("word", 1): (0, 2), ("two", 1): (0, 1), ("two", 2): (1, 0), ("word", 2): (0, 1)}


def test_buckets_grow_with_the_documents():
    assert [st.buckets_for(n) for n in (0, 1, 1000, 1001, 3000, 10**9)] == [1, 1, 1, 2, 4, st.BUCKETS]


def test_moved_terms(spark):
    p = lambda rows: spark.createDataFrame(rows, "token string, kind string, doc_id long")
    moved = ix.moved_terms(p([("a", "a", 1), ("b", "a", 1), ("c", "a", 1)]), p([("a", "a", 1), ("d", "a", 1), ("d", "a", 2)]))
    known = spark.createDataFrame([("b", "a", 1), ("c", "a", 5)], "token string, kind string, df long")
    assert {tuple(r) for r in ix.updated_terms(moved, known).collect()} == {("b", "a", 1, 0), ("c", "a", 5, 4), ("d", "a", 0, 2)}


def test_switched_off(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4), enabled=False)
    engine.sync(table(spark, [record(1)]))  # an operator's sync works
    with pytest.raises(Disabled):
        engine.recall(spark.createDataFrame([(1, "t1")], "query_id long, query string"), rt.Request(all_projects=True))
    with pytest.raises(Disabled):
        engine.catch_up(table(spark, [record(1)]))


def test_result_texts(spark):
    hits = spark.createDataFrame([(1, 1, 7, "T", "k", "p", "s", 1.03125, "words"), (1, 2, 8, "", "", "p", "s", 0.5, "")], "query_id long, place int, doc_id long, title string, type string, project string, scope string, score float, excerpt string")
    summary = spark.createDataFrame([(1, True), (2, False)], "query_id long, truncated boolean")
    got = {r["query_id"]: r["text"] for r in rendered_recall(hits, summary, ["a", "b"]).collect()}
    assert got[1] == "[1] #7 score 1.0313 type k project p scope s\nT\nwords\n[2] #8 score 0.5000 type (none) project p scope s\n(none)\nMore records match than the 2 shown; a higher limit shows more."
    assert got[2] == "No record matches.\nTypes that exist: a / b"
    assert rendered_recall(hits, summary.where("query_id = 2")).first()["text"] == "No record matches."


@pytest.mark.parametrize("block", [4096, 3])
def test_recall_in_tasks_is_the_whole_ranking_cut(spark, monkeypatch, block):
    from mnemosieve.operators import scoring as sc

    monkeypatch.setattr(passes, "QUERY_BLOCK", block)
    r = np.random.default_rng(3)
    rows = [(i, f"t{i}", f"c{i}", "k", f"p{i % 3}", "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, title string, content string, type string, project string, scope string")
    some = [r.normal(size=8).astype("f4").tolist() for _ in range(20)]
    vectors = spark.createDataFrame([(i, None if i % 17 == 0 else some[i % 20]) for i in range(290)], "doc_id long, vec array<float>").repartition(5)  # many ties
    queries = spark.createDataFrame([(q, None if q == 4 else r.normal(size=8).astype("f4").tolist()) for q in range(7)], "query_id long, vec array<float>")
    members = spark.createDataFrame([(q, int(i), float(r.random())) for q in range(7) for i in r.choice(300, 40, replace=False)], "query_id long, doc_id long, coverage double")
    scores = sc.boosted(sc.cosines(docs, vectors, queries), members, 0.2)
    for request in (rt.Request(project="p1", limit=10), rt.Request(all_projects=True, limit=3), rt.Request(project="none")):
        want = sorted(map(tuple, rt.hits(scores, docs, request).collect()))
        assert sorted(map(tuple, rt.recalled(docs, vectors, queries, members, request, 0.2).collect())) == want
        lexical = members.select("query_id", "doc_id")
        assert sorted(map(tuple, rt.recall_summary(docs, queries, request, lexical, 50).collect())) == sorted(map(tuple, rt.summary(scores, docs, request, lexical, 50).collect()))
    assert rt.recalled(docs, vectors, queries.limit(0), members, rt.Request(all_projects=True), 0.2).count() == 0


@pytest.mark.parametrize("block", [4096, 5])
def test_ranks_in_passes_are_those_of_the_whole_ranking(spark, monkeypatch, block):
    """Candidates, what was filtered before the cut, gold ranks and pools, against a sort of all scores."""
    from mnemosieve.operators import evaluate as ev
    from mnemosieve.operators import scoring as sc

    monkeypatch.setattr(passes, "QUERY_BLOCK", block)
    r = np.random.default_rng(5)
    projects = {i: f"p{i % 3}" if i % 50 else "rare" for i in range(200)}
    docs = spark.createDataFrame([(i, p, "", "", "", "") for i, p in projects.items()], "doc_id long, project string, title string, content string, type string, scope string")
    some = [r.normal(size=4).astype("f4").tolist() for _ in range(9)]
    vectors = spark.createDataFrame([(i, None if i % 13 == 0 else some[i % 9]) for i in range(190)], "doc_id long, vec array<float>").repartition(6)  # many ties
    asked = {0: "p0", 1: "", 2: "rare", 3: "nowhere", 4: "p1", 5: None, 6: "p2", 7: "p0"}
    queries = spark.createDataFrame([(q, None if q == 4 else some[q % 4], p) for q, p in asked.items()], "query_id long, vec array<float>, project string")
    members = spark.createDataFrame([(q, int(i), float(r.integers(4)) / 4) for q in range(7) for i in r.choice(200, 30, replace=False)], "query_id long, doc_id long, coverage double")
    scores = sc.boosted(sc.cosines(docs, vectors, queries.select("query_id", "vec")), members, 0.2)
    order = {q: [] for q in asked}
    for q, i, s in sorted(((x["query_id"], x["doc_id"], x["boosted"]) for x in scores.collect()), key=lambda x: (-x[2], x[1])):
        order[q].append(i)
    fits = lambda q, i: asked[q] == "" or asked[q] == projects[i]
    p = passes.Passes(docs, vectors, queries, members, 0.2)
    for limit in (1, 5):
        shown, filtered = rt.candidates(p, limit)
        mine = {q: [(n, i) for n, i in enumerate(ids, 1) if fits(q, i)] for q, ids in order.items()}
        assert {tuple(x) for x in shown.collect()} == {(q, i, place, n) for q, found in mine.items() for place, (n, i) in enumerate(found[:limit], 1)}
        want = {q: sum(not fits(q, i) for i in order[q][: found[limit][0] if len(found) > limit else None]) for q, found in mine.items()}
        assert {x["query_id"]: x["filtered_out"] for x in filtered.collect()} == want
    gold = spark.createDataFrame([(q, int(i)) for q in (0, 1, 4, 5) for i in r.choice(200, 3, replace=False)] + [(2, 7), (3, 999)], "query_id long, doc_id long")
    want = {q: min(order[q].index(x["doc_id"]) + 1 for x in gold.collect() if x["query_id"] == q) for q in (0, 1, 2, 4, 5)}
    assert {x["query_id"]: x["rank"] for x in ev.counted_ranks(p, gold).collect()} == want | {3: None}
    for top_k in (10, 50, 0):
        sizes = {q: min(30, top_k or 30) for q in range(7)}
        held = passes.Passes(docs, vectors, queries, members.where("true") if top_k != 10 else members.limit(0).unionByName(members.groupBy("query_id").agg(F.slice(F.collect_list(F.struct("doc_id", "coverage")), 1, 10).alias("m")).selectExpr("query_id", "inline(m)")), 0.2)
        got = {(x["query_id"], x["place"]): x["doc_id"] for x in rt.pool_ids(held, top_k).collect()}
        assert {q: sum(k[0] == q for k in got) for q in range(7)} == sizes
        if top_k != 10:
            assert got == {(q, n): order[q][n - 1] for q in range(7) for n in range(1, sizes[q] + 1)}
    nothing = passes.Passes(docs.limit(0), vectors, queries, members.limit(0), 0.2)
    assert rt.candidates(nothing, 5)[0].count() == 0 and {x["filtered_out"] for x in rt.candidates(nothing, 5)[1].collect()} == {0}
    bare = passes.Passes(docs, vectors.where("doc_id > 180"), queries.select("query_id", "vec"), members, 0.2)  # most batches have no vector at all
    assert bare.leading(2).count() == 16 and rt.recalled(docs, vectors.limit(0), queries, members, rt.Request(all_projects=True, limit=1), 0.2).count() == 8
    nobody = passes.Passes(docs, vectors, queries.limit(0), members, 0.2)
    assert [x.count() for x in rt.candidates(nobody, 5)] == [0, 0] and ev.counted_ranks(nobody, gold.limit(0)).count() == 0


# The sink.
REQUESTS = "request_id string, seq long, title string"


def answers(status):
    calls = []

    def send(requests):
        rows = requests.collect()
        calls.append(sorted(r["request_id"] for r in rows))
        return requests.sparkSession.createDataFrame([(r["request_id"], *status(r["request_id"], len(calls))) for r in rows], "request_id string, status int, failure string, written_id long")

    return send, calls


def test_a_batch_counts_once(spark, tmp_path):
    send, calls = answers(lambda key, n: (200, None, len(key)))
    sink = WriteSink(spark, f"file://{tmp_path}/s", send)
    rows = spark.createDataFrame([("a", 2, "later"), ("a", 1, "first"), ("bb", 3, "x"), (None, 4, "y")], REQUESTS)
    assert sink.ledger() is None
    with pytest.raises(FileNotFoundError):
        sink.outcomes()
    assert sink.apply(rows, 0) == {"batch": 0, "sent": 2, "known": False}
    assert sink.apply(rows, 0) == {"batch": 0, "sent": 0, "known": True} and len(calls) == 1
    assert sink.apply(rows.unionByName(spark.createDataFrame([("c", 9, "new")], REQUESTS)), 1)["sent"] == 1 and calls[-1] == ["c"]
    assert sorted(map(tuple, sink.outcomes().collect())) == [("a", "success", 1, 1), ("bb", "success", 2, 1), ("c", "success", 1, 1)]


def test_what_failed_for_sure_is_sent_again(spark, tmp_path):
    send, calls = answers(lambda key, n: (200, None, None) if n > 1 else {"c": (None, "connection", None), "t": (None, "timeout", None), "s": (503, None, None), "r": (422, None, None)}[key])
    sink = WriteSink(spark, f"file://{tmp_path}/s", send)
    rows = spark.createDataFrame([(k, 1, "") for k in "ctsr"], REQUESTS)
    sink.apply(rows, 0)
    sink.apply(rows, 1)
    assert calls == [["c", "r", "s", "t"], ["c", "s"]]
    got = {r["request_id"]: (r["outcome"], r["attempts"]) for r in sink.outcomes().collect()}
    assert got == {"c": ("success-without-id", 2), "s": ("success-without-id", 2), "t": ("timeout", 1), "r": ("rejected", 1)}


def test_a_run_that_died_before_its_commit(spark, tmp_path, monkeypatch):
    from mnemosieve.plans import sink as module

    send, calls = answers(lambda key, n: (200, None, n))
    sink = WriteSink(spark, f"file://{tmp_path}/s", send)
    rows = spark.createDataFrame([("a", 1, "")], REQUESTS)
    with monkeypatch.context() as m:
        m.setattr(module, "create_once", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            sink.apply(rows, 0)
    assert sink.ledger() is None  # rows without a commit don't count
    assert sink.apply(rows, 0)["sent"] == 1 and sink.outcomes().first()["written_id"] == 2


def test_a_stream_through_the_sink(spark, tmp_path):
    send, calls = answers(lambda key, n: (200, None, 1))
    sink = WriteSink(spark, f"file://{tmp_path}/s", send)
    for i, rows in enumerate(([("a", 1, ""), ("b", 2, "")], [("b", 3, ""), ("c", 4, "")])):
        spark.createDataFrame(rows, REQUESTS).write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(REQUESTS).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        sink.run(stream, f"{tmp_path}/log").awaitTermination()
    assert calls == [["a", "b"], ["c"]] and sink.outcomes().count() == 3


def test_over_http(spark, tmp_path):
    seen = []

    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["content-length"])))
            seen.append((self.headers["idempotency-key"], body))
            status, text = {"ok": (201, b'{"id": 5}'), "bare": (200, b"fine"), "odd": (200, b'{"id": "x"}'), "no": (422, b"no"), "down": (500, b"")}[body["title"]]
            self.send_response(status)
            self.send_header("content-length", str(len(text)))
            self.end_headers()
            self.wfile.write(text)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = spark.createDataFrame([(t, i, t) for i, t in enumerate(("ok", "bare", "odd", "no", "down"))], REQUESTS)
    sink = WriteSink(spark, f"file://{tmp_path}/s", http_sender(f"http://127.0.0.1:{server.server_port}/observations", 10, parallel=2))
    sink.apply(rows, 0)
    server.shutdown()
    server.server_close()
    got = {r["request_id"]: (r["outcome"], r["written_id"]) for r in sink.outcomes().collect()}
    assert got == {"ok": ("success", 5), "bare": ("success-without-id", None), "odd": ("success-without-id", None), "no": ("rejected", None), "down": ("server", None)}
    assert sorted((k, b["title"]) for k, b in seen) == sorted((t, t) for t in got)
    dead = WriteSink(spark, f"file://{tmp_path}/d", http_sender(f"http://127.0.0.1:{server.server_port}/observations", 5))
    dead.apply(rows.limit(1), 0)
    assert dead.outcomes().first()["outcome"] == "connection"


def test_words_that_cancel_out_agree_with_sql(spark, duck, tmp_path):
    """Two words of one place and opposite signs leave no direction: SQL divides zero by zero there."""
    import math

    from mnemosieve import catalog

    words = [(w, HashedWords(64)([w])[0]) for w in (f"w{i}" for i in range(400))]
    pair = next((a, b) for a, u in words for b, v in words if not (u + v).any())
    rows = [(1, " ".join(pair), "en", "src0"), (2, "alpha beta", "en", "src0"), (3, "", "en", "src0"), (4, f"alpha {pair[0]} {pair[1]}", "en", "src0"), (5, None, "en", "src0")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"file://{tmp_path}/documents.parquet")
    sql = catalog.oracle_sql()["m09_batched_embedding"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    told = lambda found: sorted((d, p, "nan" if math.isnan(v) else v) for d, p, v in found)
    have = told((r["doc_id"], r["place"], r["value"]) for r in catalog.queries()["m09_batched_embedding"](spark, f"file://{tmp_path}").collect())
    assert have == told(duck.execute(sql).fetchall())
    assert [x for x in have if x[2] == "nan"] and any(x[0] == 4 for x in have)
