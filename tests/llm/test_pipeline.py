from collections import Counter, defaultdict

import corpus_pipeline
from mnemosieve.llm import packing, queries, toxicity
from tests.conftest import DATA, agree
from tests.llm.test_dedup_mixing import FOLD
from tests.llm.test_ngram_join import brute

CLASH = ("a", "b", "c", 1, 2, 3, "d", 4)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(DATA)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({"all": docs.collect(), "columns": docs.columns})
    assert all(k["columns"] == columns for k in kept[:-1])
    clean, single, apart, mixed, packed = (k["all"] for k in kept)
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(source, toxicity.fit(source, spark.read.parquet(f"{DATA}/labels.parquet"))).collect()}
    assert {r["doc_id"] for r in clean} == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    groups = defaultdict(list)
    for r in clean:
        groups[(r["text"] or "").translate(FOLD)].append(r["doc_id"])
    assert sorted(r["doc_id"] for r in single) == sorted(max(g) for g in groups.values())
    assert sorted(r["doc_id"] for r in apart) == sorted({c for *_, c in brute([(r["doc_id"], r["text"]) for r in single], 5, 80)})
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in apart} and max(Counter(r["doc_id"] for r in mixed).values()) <= 2
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed)
    fill = Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= packing.CAPACITY
    assert sorted(map(str, corpus_pipeline.run(spark, str(DATA)).select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(str, ((spark.read.parquet(f"{tmp_path}/best_fit_packing")).select("doc_id", "piece", "ids_crc32")).collect()))


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, target string, copies int, _key int, _row_key long, _scored string, source_size int"
    for rows in ([], [(1, None, None, None, None, *CLASH), (2, "", "", "", 0, *CLASH), (2, "", "", "", 0, *CLASH), (3, "some words of a text here", "en", "s", 5, *CLASH)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(DATA))
            assert out.columns == docs.columns and all(tuple(r)[5:] == CLASH for r in out.collect())
            docs = spark.createDataFrame(out.collect(), schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA)).count()


def test_queries_agree_with_sql(spark, duck):
    sql = queries.oracle_sql()
    assert {f"op{i}_" for i in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.queries()}
    for name, text in sql.items():
        agree(spark, duck, queries.queries()[name], text)


def test_remaining_queries_run(spark):
    for name, query in queries.queries().items():
        if name not in queries.oracle_sql():
            assert query(spark, str(DATA)).count() > 0
