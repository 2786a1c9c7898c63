import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mnemosieve.operators import index as ix
from mnemosieve.operators import retrieval as rt
from mnemosieve.operators import scoring as sc
from mnemosieve.plans.engine import Engine, HashEmbedder, SyncNeeded
from mnemosieve.plans.store import Busy
from mnemosieve.sources.observations import active_snapshot, side_columns, source_hash

SCHEMA = "id long, title string, content string, type string, project string, scope string, topic_key string, session_id string, created_at string, updated_at string, deleted_at string"
T = "2026-01-01T00:00:00Z"


def record(i, title=None, content=None, type="manual", project="alpha", scope="project", updated=T, deleted=None, topic="", session=""):
    return (i, title if title is not None else f"t{i}", content if content is not None else f"c{i}", type, project, scope, topic, session, T, updated, deleted)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


CORPUS = [
    record(1, "读层设计", "读层打分与候选", "decision"), record(2, "索引结构", "倒排索引与向量", "architecture"), record(3, "personal", "偏好记录", "preference", scope="personal"),
    record(4, "hybrid search", "cosine and lexical scores", "discovery", "beta"), record(5, "删除", "已经删除", deleted=T),
]


def state(engine):
    read = lambda t: sorted(map(str, engine.store.read(t).select(*sorted(engine.store.read(t).columns)).collect()))
    return {t: read(t) for t in ("docs", "postings", "terms", "vectors", "meta")}


def test_snapshot_and_hash(spark):
    import hashlib

    snapshot = active_snapshot(table(spark, [*CORPUS, record(9, None, None)]))
    assert [r["id"] for r in snapshot.orderBy("id").collect()] == [1, 2, 3, 4, 9]
    rows = [r for r in [*CORPUS, record(9)] if r[10] is None]
    want = hashlib.sha256("".join(f"{r[0]}\x1f{r[9]}\x1f{len(r[2] or '')}\x1f{r[2] or ''}\x1e" for r in rows).encode()).hexdigest()
    assert source_hash(snapshot) == want


def test_sync_modes(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8))
    assert engine.store.inspect(engine.embedder.identity) == "missing" and engine.candidates(spark.createDataFrame([], "query_id long, title string, content string, type string, topic_key string, session_id string, project string"), table(spark, CORPUS)) is None
    assert not (tmp_path / "a").exists()
    first = [record(1, "读层设计", "旧内容", "decision"), CORPUS[1]]
    assert engine.sync(table(spark, first))["mode"] == "full"
    assert engine.sync(table(spark, first))["mode"] == "noop"
    out = engine.sync(table(spark, CORPUS))
    assert (out["mode"], out["docs_touched"]) == ("incremental", 3)
    other = Engine(spark, f"file://{tmp_path}/b", HashEmbedder(8))
    other.rebuild(table(spark, CORPUS))
    assert state(engine) == state(other)
    assert engine.plan(table(spark, [*CORPUS, record(6)])) == ("incremental", 1)
    renamed = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(4))
    assert renamed.store.inspect(renamed.embedder.identity) == "model-mismatch" and renamed.plan(table(spark, CORPUS)) == ("full", 4)
    title_only = [record(1, "新标题", "读层打分与候选", "decision"), *CORPUS[1:]]
    assert engine.plan(table(spark, title_only))[0] == "noop"


def test_cap_leaves_the_index_alone(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8), max_docs=0)
    with pytest.raises(SyncNeeded) as e:
        engine.sync(table(spark, [record(1)]))
    assert (e.value.mode, e.value.pending) == ("full", 1) and engine.store.current() is None
    engine.sync(table(spark, [record(1)]), unlimited=True)
    with pytest.raises(SyncNeeded):
        engine.sync(table(spark, [record(1), record(2)]))
    assert engine.store.current() == 1


def test_another_writer_wins(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8))
    engine.sync(table(spark, [record(1)]))
    with pytest.raises(Busy):
        engine.store.publish(["x"], "y", None)
    assert engine.store.current() == 1
    (tmp_path / "a" / engine.store._manifest(1)["whole"] / "meta").rename(tmp_path / "moved")
    assert engine.store.inspect(engine.embedder.identity) == "unreadable"
    engine.store.discard()
    assert engine.store.inspect(engine.embedder.identity) == "missing"


def test_two_writers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = f"file://{tmp_path}/a"
    Engine(spark, path, HashEmbedder(8)).sync(table(spark, [record(1)]))

    def write(i):
        try:
            return Engine(spark, path, HashEmbedder(8)).sync(table(spark, [record(1), record(10 + i, f"title {i}", f"content {i}")]))["version"]
        except Busy:
            return None

    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(write, range(3)))
    engine = Engine(spark, path, HashEmbedder(8))
    assert [v for v in got if v] and engine.store.current() == max(v for v in got if v) and engine.store.inspect("hash-8") == "ok"
    assert len({v for v in got if v}) == len([v for v in got if v])  # no version has two writers
    ids = {r[0] for r in engine.store.read("docs").select("doc_id").collect()}
    assert len(ids) == 2 and {r[0] for r in engine.store.read("postings").select("doc_id").distinct().collect()} == ids


def test_segments_equal_a_rebuild(spark, tmp_path, monkeypatch):
    from mnemosieve.plans import engine as module

    monkeypatch.setattr(module, "SEGMENTS", 3)
    engine, other = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8)), Engine(spark, f"file://{tmp_path}/b", HashEmbedder(8))
    rows = {i: record(i, f"title {i}", f"读层 word{i % 3} text", updated="a") for i in range(8)}
    engine.sync(table(spark, list(rows.values())))
    most = 0
    for step in range(4):
        rows[step] = record(step, f"changed {step}", f"content word{step}", updated=f"b{step}")
        rows.pop(7 - step)
        told = engine.sync(table(spark, list(rows.values())))
        assert told["mode"] == "incremental" and told["docs_touched"] == 2
        most = max(most, len(engine.store.segments(engine.store.current())))
        other.sync(table(spark, list(rows.values())), full=True)
        for name in ("docs", "postings", "terms", "vectors", "meta"):
            a, b = engine.store.read(name), other.store.read(name)
            assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), name
    assert most == 3
    before = engine.store.current()
    engine.store.keep_last(1)
    assert engine.store.current() == before and engine.store.read("postings").count() == other.store.read("postings").count()


def test_an_index_that_is_not_whole_is_not_trusted(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8))
    engine.sync(table(spark, CORPUS))
    segment = engine.store.segments(1)[0]
    vectors = spark.createDataFrame(engine.store.read("vectors").limit(2).collect(), engine.store.read("vectors").schema)
    vectors.write.mode("overwrite").parquet(f"file://{tmp_path}/a/{segment}/vectors")
    fresh = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8))
    assert fresh.store.inspect("hash-8") == "untrusted" and fresh.plan(table(spark, CORPUS))[0] == "full"
    fresh.sync(table(spark, CORPUS))
    assert fresh.store.inspect("hash-8") == "ok"


def test_feed_of_ids(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8))
    rows = [record(i, f"title {i}", f"content {i}") for i in range(5)]
    engine.sync(table(spark, rows))
    changed = [record(0, "other", "text", updated="later"), record(1, "other", "text", updated="later"), *rows[2:4], record(9, "new", "one")]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    told = engine.sync(table(spark, changed), only=ids(0, 4, 9))
    assert (told["mode"], told["docs_touched"]) == ("incremental", 3)
    assert {r["doc_id"]: r["title"] for r in engine.store.read("docs").collect()} == {0: "other", 1: "title 1", 2: "title 2", 3: "title 3", 9: "new"}
    assert engine.sync(table(spark, changed), only=ids(0, 4, 9))["mode"] == "noop"
    assert engine.sync(table(spark, changed))["docs_touched"] == 1 and engine.sync(table(spark, changed))["mode"] == "noop"


def test_digest_in_no_order(spark):
    from mnemosieve.sources.observations import snapshot_digest

    a = active_snapshot(table(spark, CORPUS))
    assert snapshot_digest(a) == snapshot_digest(a.repartition(3).orderBy("id", ascending=False)) != snapshot_digest(a.where("id > 1"))


def test_small_minds_bytes(spark):
    from mnemosieve.operators.scoring import small

    wide = spark.createDataFrame([(i, "x" * 1000, [1.0] * 100) for i in range(50)], "i long, s string, v array<double>")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().logical().toString() or "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(small(wide)) and not hinted(small(wide, size=50_000)) and not hinted(small(wide, rows=49)) and small(wide, rows=1).count() == 50


WORDS = st.sampled_from(["读层", "alpha beta", "Hello b2", "单", "", "x 1 22", "été"])
ROW = st.tuples(st.integers(1, 6), WORDS, WORDS, st.booleans())


@settings(max_examples=4, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=6), st.lists(ROW, max_size=6))
def test_incremental_equals_full(spark, before, after):
    def records(rows, stamp):
        return table(spark, [record(i, t, c, updated=f"{stamp}{i}", deleted=T if d else None) for i, t, c, d in {r[0]: r for r in rows}.values()])

    old, new = active_snapshot(records(before, "a")), active_snapshot(records(after, "b" if len(after) % 2 else "a"))
    docs = ix.documents(old)
    posted = ix.postings(docs)
    got_docs, got = ix.apply_changes(docs, posted, new)
    want = ix.postings(ix.documents(new))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r[0] for r in got_docs.select("doc_id").collect()} == {r[0] for r in new.select("id").collect()}
    repaired = ix.repair_terms(ix.terms(posted), got, ix.affected_terms(posted, got, ix.diff(docs, new)))
    assert sorted(map(tuple, repaired.collect())) == sorted(map(tuple, ix.terms(want).collect()))


def ranked(spark, rows):
    """Scores with given cosines, and their documents. rows: id, cosine, type, project, scope."""
    docs = ix.documents(active_snapshot(table(spark, [record(i, type=t, project=p, scope=s) for i, _, t, p, s in rows])))
    scores = spark.createDataFrame([(0, i, c) for i, c, *_ in rows], "query_id long, doc_id long, boosted double")
    return scores, docs


def ask(spark, rows, **request):
    rows = [(i, c, *(r + ["A", "alpha", "project"][len(r):])) for i, c, *r in rows]
    scores, docs = ranked(spark, rows)
    req = rt.Request(**({"project": "alpha"} | request))
    hits = [r["doc_id"] for r in rt.hits(scores, docs, req).orderBy("place").collect()]
    s = rt.summary(scores, docs, req, scores.limit(0).select("query_id", "doc_id"), 50).first()
    return hits, s["filtered_out"], s["truncated"]


@pytest.mark.parametrize(("rows", "request_", "want"), [
    ([(1, 0.99, "A"), (2, 0.8, "B"), (3, 0.6, "A")], {"type": "A"}, ([1, 3], 1, False)),
    ([(1, 0.99, "B"), (2, 0.9), (3, 0.8), (4, 0.7)], {"type": "A", "limit": 3}, ([2, 3, 4], 1, False)),
    ([(1, 0.99, "B"), (2, 0.9), (3, 0.8), (4, 0.7), (5, 0.6)], {"type": "A", "limit": 3}, ([2, 3, 4], 1, True)),
    ([(1, 0.99), (2, 0.9), (3, 0.8), (4, 0.1, "B")], {"type": "A", "limit": 3}, ([1, 2, 3], 1, False)),
    ([(1, 0.99), (2, 0.9), (3, 0.8)], {"limit": 2}, ([1, 2], 0, True)),
    ([(1, 0.99, "A", "alpha"), (2, 0.9, "A", "beta")], {}, ([1], 1, False)),
    ([(1, 0.99, "A", "alpha"), (2, 0.9, "A", "beta")], {"project": None, "all_projects": True}, ([1, 2], 0, False)),
    ([(1, 0.99, "A", "alpha", "project"), (2, 0.9, "A", "alpha", "personal")], {"scope": "personal"}, ([2], 1, False)),
    ([(2, 0.5), (1, 0.5)], {}, ([1, 2], 0, False)),
])
def test_retrieval(spark, rows, request_, want):
    assert ask(spark, rows, **request_) == want


def test_project_is_needed():
    with pytest.raises(ValueError, match="project"):
        rt.Request()


def test_types_of_all_projects(spark):
    _, docs = ranked(spark, [(1, 0.9, "decision", "alpha", "project"), (2, 0.8, "architecture", "beta", "project"), (3, 0.7, "", "beta", "project")])
    assert [r[0] for r in rt.available_types(docs).collect()] == ["architecture", "decision"]


def test_candidates_and_evidence(spark, tmp_path):
    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8))
    rows = [record(1, "same title", "the very same content", "decision", topic="k"), record(2, "same title", "another content", "decision"), record(3, "same title", "the very same content", "decision", "beta")]
    engine.sync(table(spark, rows))
    schema = "query_id long, title string, content string, type string, topic_key string, session_id string, project string"
    asked = spark.createDataFrame([(0, "same title", "the very same content", "decision", "k", "", "alpha")], schema)
    out = engine.candidates(asked, table(spark, [*rows, record(4)]))
    found = {r["doc_id"]: r for r in out["candidates"].collect()}
    assert set(found) == {1, 2}
    assert found[1]["identical_content"] and found[1]["same_type_and_title"] and found[1]["same_topic_key"] == "k" and not found[1]["same_session"]
    assert not found[2]["identical_content"] and found[2]["same_type_and_title"] and found[2]["same_topic_key"] == ""
    assert found[1]["corpus_size"] == 3 and found[1]["semantic_rank"] == 1 and found[1]["shared_rare_terms"]["count"] == len(found[1]["shared_rare_terms"]["terms"]) > 0
    assert out["filtered_out"].first()["filtered_out"] == 1 and out["lag"].first()["lag_docs"] == 1
    hits = engine.recall(asked.selectExpr("query_id", "concat(title, '\n', content) AS query"), rt.Request(all_projects=True))["hits"]
    order = [r["doc_id"] for r in hits.orderBy("place").collect() if r["doc_id"] != 3]
    assert order == [r["doc_id"] for r in out["candidates"].orderBy("place").collect()]
    bare = side_columns(table(spark, rows).drop("topic_key", "session_id"), spark.createDataFrame([(1,), (99,)], "id long"))
    assert {tuple(r) for r in bare.collect()} == {(1, "", ""), (99, "", "")}


def brute(docs, query, variant, params):
    """A scorer in plain Python. docs: id, title, content, type, project."""
    import math
    import re

    def toks(s):
        return [x.lower() for x in re.findall(r"[0-9A-Za-z]+", s) if len(x) >= 2]

    n = len(docs)
    post = {d[0]: (toks(d[1]), toks(d[2])) for d in docs}
    q = list(dict.fromkeys(toks(query)))
    df = {t: sum(t in a or t in b for a, b in post.values()) for t in q}
    idf = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in q}
    mean = sum(len(a) + len(b) for a, b in post.values()) / n
    out = {}
    for i, _, _, kind, project in docs:
        a, b = post[i]
        raw = w = matched = mass = 0.0
        for t in q:
            if t not in a and t not in b:
                continue
            matched += 1
            mass += idf[t]
            tf = params["scoring_title_weight"] * a.count(t) + b.count(t)
            lnorm = 1 - params["scoring_b"] + params["scoring_b"] * (len(a) + len(b)) / mean
            raw += idf[t] * (params["scoring_k1"] + 1) * tf / (tf + params["scoring_k1"] * lnorm)
            w += 3 if t in a else 2 if t in toks(kind) or t in toks(project) else 1
        if matched:
            cov = {"field_cov": w / (3 * len(q)), "cov_n": matched / len(q), "idf_cov": mass / sum(idf.values())}[variant]
            out[i] = (cov, cov if variant == "idf_cov" else cov + params["scoring_evidence_weight"] * raw / (raw + 1))
    return out


@pytest.mark.parametrize("variant", sc.VARIANTS)
@pytest.mark.parametrize("change", [{}, {"scoring_k1": 2.5}, {"scoring_b": 0.9}, {"scoring_title_weight": 9.0}, {"scoring_evidence_weight": 0.9}])
def test_lexical_order(spark, variant, change):
    params = ix.SCORING | change
    texts = [(1, "alpha beta", "gamma gamma delta", "decision", "alpha"), (2, "gamma", "alpha alpha beta extra words here", "alpha", "one"), (3, "other", "nothing in common at all", "manual", "two"), (4, "delta", "beta", "gamma", "beta")]
    docs = ix.documents(active_snapshot(table(spark, [record(i, t, c, k, p) for i, t, c, k, p in texts])))
    asked = spark.createDataFrame([(0, "Alpha gamma beta alpha missing"), (1, "")], "query_id long, query string")
    told = ix.avgdl(docs).first()
    wanted = sc.with_idf(sc.query_tokens(asked), ix.terms(ix.postings(docs)), told["n_docs"])
    got = {r["doc_id"]: (r["coverage"], r["ordering"]) for r in sc.lexical_scores(sc.matches(docs, ix.postings(docs), wanted, told["avgdl"], params), wanted, variant, params).collect()}
    want = brute(texts, "alpha gamma beta alpha missing", variant, params)
    assert got.keys() == want.keys()
    assert all(abs(a - b) < 1e-12 for k in want for a, b in zip(got[k], want[k], strict=True))


def test_missing_constants_are_an_error(spark):
    with pytest.raises(ValueError, match="scoring_b"):
        ix.scoring_params(spark.createDataFrame([("scoring_k1", "1.2")], "key string, value string"))


def test_saving(spark, tmp_path):
    from mnemosieve.plans.saving import rendered_candidates, save

    engine = Engine(spark, f"file://{tmp_path}/a", HashEmbedder(8))
    rows = table(spark, [record(1, "same title", "same content", "decision")])
    engine.sync(rows)
    requests = spark.createDataFrame([(0, "alpha", "s", "same title", "same content"), (1, "alpha", "s", "x", " "), (2, "alpha", "s", "later", "by fallback")], "query_id long, project string, session_id string, title string, content string")
    answer = F.when(F.col("query_id") == 2, 500).otherwise(200)
    out = save(engine, rows, requests, lambda r: r.select("query_id", answer.alias("status"), F.lit(None).cast("string").alias("failure"), F.when(F.col("query_id") == 0, 1).alias("written_id")), lambda r: r.select("query_id", F.lit('{"id": 9, "candidates": ["a"]}').alias("response")))
    assert {tuple(r) for r in out.written.collect()} == {(0, 1, "success"), (2, 9, "fallback")}
    assert [tuple(r) for r in out.rejected.collect()] == [(1, "content is blank")]
    assert {(r["query_id"], r["will_update"]) for r in out.candidates.collect()} == {(0, True), (2, False)}
    assert "rank 1/1" in rendered_candidates(out.candidates).first()["text"]
