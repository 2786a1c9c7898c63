"""Lexical order by documents against the one by shuffled matches."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemosieve import catalog
from mnemosieve.functions import text as tx
from mnemosieve.operators import evaluate as ev
from mnemosieve.operators import index as ix
from mnemosieve.operators import lexical as lx
from mnemosieve.operators import scoring as sc
from tests.conftest import DATA
from tests.test_engine import record, table

TEXTS = ["alpha beta gamma alpha", "Beta 读写层 delta", "读 é x1 X1 İK alpha2", "", "the the the of alpha", "读写 写层 of beta", None, "a b c 你好", "en alpha gamma\nof the 写", "gamma delta epsilon of"]


def tables(spark):
    from mnemosieve.sources.observations import active_snapshot

    docs = ix.documents(active_snapshot(table(spark, [record(i + 1, (TEXTS[-i - 1] or "")[:9], t) for i, t in enumerate(TEXTS)])))
    queries = spark.createDataFrame([(10, "alpha of the beta 读写层 en"), (11, "gamma"), (12, ""), (13, "nothing here"), (14, "x1 读 delta of of alpha")], "query_id long, query string")
    return docs, queries


def test_tokens_are_those_of_the_engine(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string").select("t", tx.tokens(F.col("t")).alias("x")).collect()
    for r in rows:
        want = [(x["kind"] + x["token"]).encode() for x in r["x"]]
        assert lx.token_counts(r["t"]) == {k: want.count(k) for k in want}


@pytest.mark.parametrize("coverage", sc.VARIANTS)
def test_candidates_agree_and_nothing_is_shuffled(spark, coverage, monkeypatch):
    docs, queries = tables(spark)
    posted, mean, n = ix.postings(docs), *ix.avgdl(docs).first()
    tokens = sc.query_tokens(queries)
    numbers = lx.numbered(tokens)
    rows = lx.counted(docs, numbers)
    assert rows.agg(F.avg("n_tokens")).first()[0] == mean
    wanted = sc.with_idf(tokens, lx.frequencies(rows, numbers), n)
    assert sorted(wanted.collect()) == sorted(sc.with_idf(tokens, ix.terms(posted), n).select(*wanted.columns).collect())
    want = sorted(tuple(r) for r in sc.lexical_scores(sc.matches(docs, posted, wanted, mean, ix.SCORING), wanted, coverage).collect())
    found = lx.candidates(rows, wanted, numbers, mean, coverage)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert want and sorted(tuple(r) for r in found.collect()) == want
    monkeypatch.setattr(lx, "CELLS", 8)
    for k in (1, 3, 100):
        first = sorted((r["query_id"], r["lex_rank"], r["doc_id"], r["ordering"]) for r in lx.candidates(rows, wanted, numbers, mean, coverage, top_k=k).collect())
        ranked = {q: sorted((-x[3], x[1]) for x in want if x[0] == q)[:k] for q in {x[0] for x in want}}
        assert first == sorted((q, i + 1, d, -o) for q, xs in ranked.items() for i, (o, d) in enumerate(xs))
    few = {(r["query_id"], r["doc_id"]) for r in lx.candidates(rows, wanted, numbers, mean, coverage, lacking=2).collect()}
    sizes = {r["query_id"]: r["n_query_tokens"] for r in tokens.collect()}
    assert few == {(x[0], x[1]) for x in want if x[5] >= sizes[x[0]] - 2}


def test_postings_gather_to_the_same_counts(spark):
    docs, queries = tables(spark)
    docs = docs.withColumn("type", F.when(F.col("doc_id") % 2 == 0, "alpha 读写").otherwise(F.col("type")))
    numbers = lx.numbered(sc.query_tokens(queries))
    told = lambda rows: {r["doc_id"]: (r["n_tokens"], set(r["labels"]), set(zip(r["terms"], r["titles"], r["contents"], strict=True))) for r in rows.collect() if r["terms"]}
    want = told(lx.counted(docs, numbers))
    assert want and told(lx.gathered(docs, ix.postings(docs), numbers)) == want


def test_ranks_of_gold_candidates_are_counted(spark):
    """Many ties; gold documents that are no candidates, and queries without any."""
    r = np.random.default_rng(3)
    rows = [(int(q), int(i), float(r.integers(6)) / 4) for q in range(6) for i in r.choice(300, 200, replace=False)]
    candidates = spark.createDataFrame(rows, "query_id long, doc_id long, ordering double").repartition(5)
    gold = spark.createDataFrame([(int(q), int(i)) for q in range(5) for i in r.choice(300, 4, replace=False)] + [(5, 999), (7, 1), (0, 998)], "query_id long, doc_id long")
    want = ev.gold_ranks(sc.ranked(candidates, F.desc("ordering")), gold)
    near = candidates.join(gold.unionByName(gold.withColumn("doc_id", F.col("doc_id") + 1)).distinct(), ["query_id", "doc_id"], "left_semi")
    ranks = ev.candidate_ranks(candidates, near, gold)
    places = {x["query_id"]: x["rank"] for x in ranks.collect()}
    assert places == {x["query_id"]: x["rank"] for x in want.collect()} and places[5] is places[7] is None and any(places.values())
    hits = {x["k"]: (x["hit_rate"], x["n"]) for x in ev.pool_hit(ranks, (1, 3, 20, 0)).collect()}
    assert hits == {k: (sum(p is not None and (p <= k or not k) for p in places.values()) / 7, 7) for k in (1, 3, 20, 0)}
    assert ev.candidate_ranks(candidates, near, gold.limit(0)).count() == 0


def above(df, name):
    """Names of the operators over each operator of that name in a plan, from the nearest on."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found = []
    for i in (i for i, line in enumerate(lines) if name in line):
        names, least = [], depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < least:
                least = depth(line)
                names.append(line.lstrip(" :+-").split("(")[0].split()[0])
        found.append(names)
    return found


def test_candidates_are_counted_where_they_are_made(spark):
    """v04_pool_hit: however small Spark thinks that the table of all candidates is, it is neither broadcast nor shuffled nor sorted."""
    found = above(catalog.queries()["v04_pool_hit"](spark, str(DATA)), "MapInArrow")
    assert found
    for names in found:
        assert "HashAggregate" in names and not {"Exchange", "BroadcastExchange", "Sort", "Window"} & set(names[: names.index("HashAggregate")])


def test_texts_of_gold_documents_stay_where_they_are_read(spark):
    found = above(catalog._gold(catalog.Corpus(spark, str(DATA))), "documents.parquet")
    assert found and not any({"Exchange", "BroadcastExchange"} & set(names) for names in found)


def test_gold_documents_of_short_queries(spark, tmp_path):
    """Queries without a token, of one and of two, and one that goes on within words; texts null and empty."""
    texts = {1: "x, y! alpha", 2: "alphabet soup", 3: "", 4: None, 5: "an alpha beta gamma deltas", 6: "读写层 x, y!", 7: "epsilon"}
    asked = {1: "x, y!", 2: "alpha", 3: "alpha beta", 4: "pha beta gamma delta", 5: "写", 6: "", 7: None, 8: "nowhere to be found"}
    spark.createDataFrame([(i, t, "en", "src0") for i, t in texts.items()], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(asked.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = sorted((q, d) for q, x in asked.items() for d, t in texts.items() if x is not None and x in (t or ""))
    assert sorted(map(tuple, catalog._gold(catalog.Corpus(spark, str(tmp_path))).collect())) == want
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    rows = catalog.queries()["v04_pool_hit"](spark, str(tmp_path)).select("k", "hit_rate", "n").collect()
    result = con.execute(f"SELECT k, hit_rate, n FROM ({catalog.oracle_sql()['v04_pool_hit']})").fetchall()
    assert sorted(map(tuple, rows)) == sorted(result)
