"""Retrieval quality over judged pairs: recall, reciprocal rank, median rank, pool hits, hubs, paired tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemosieve.operators.passes import Passes
from mnemosieve.operators.scoring import small
from mnemosieve.sources.tables import written


def gold_ranks(ranked: DataFrame, gold: DataFrame) -> DataFrame:
    """query_id, rank: the best rank of a query's gold documents; null where none is ranked. ranked: query_id, doc_id, rank; gold: query_id, doc_id."""
    best = ranked.join(gold, ["query_id", "doc_id"]).groupBy("query_id").agg(F.min("rank").alias("rank"))
    return gold.select("query_id").distinct().join(best, "query_id", "left")


def counted_ranks(passes: Passes, gold: DataFrame) -> DataFrame:
    """gold_ranks() of documents without ranking them: one more than the documents before a query's best gold one, counted in a pass over the corpus.
    gold: query_id, doc_id, a table."""
    best = F.min(F.struct((-F.col("score")).alias("x"), "doc_id")).alias("g")
    marks = written(passes.scores_of(gold).groupBy("query_id").agg(best).select("query_id", "g.doc_id", (-F.col("g.x")).alias("score")), "gold-best")
    ranks = passes.before(marks).select("query_id", (F.col("before") + 1).cast("int").alias("rank"))
    return gold.select("query_id").distinct().join(ranks, "query_id", "left")


def recall_at(ranks: DataFrame, cuts: tuple[int, ...] = (1, 5, 10, 30, 100)) -> DataFrame:
    """k, recall, n."""
    n = F.count(F.lit(1))
    rows = F.array(*[F.struct(F.lit(k).alias("k"), (F.count_if(F.col("rank") <= k) / n).alias("recall"), n.alias("n")) for k in cuts])
    return ranks.agg(rows.alias("r")).select(F.inline("r"))


def mrr(ranks: DataFrame) -> DataFrame:
    return ranks.agg(F.avg(F.coalesce(1.0 / F.col("rank"), F.lit(0.0))).alias("mrr"), F.count(F.lit(1)).alias("n"))


def median_rank(ranks: DataFrame) -> DataFrame:
    return ranks.agg(F.median("rank").alias("median_rank"), F.count("rank").alias("n"))


def candidate_ranks(candidates: DataFrame, near: DataFrame, gold: DataFrame) -> DataFrame:
    """gold_ranks() of candidates in lexical order without ranking them: one more than the candidates before a query's best gold one, counted in the tasks that
    make them. They are many for each row they are made of, more than Spark's estimates tell, so they must not be a join's small side. candidates: query_id,
    doc_id, ordering of all; near: those of them among which the gold ones are, a table; gold: query_id, doc_id, a table."""
    best = F.min(F.struct((-F.col("ordering")).alias("x"), "doc_id")).alias("g")
    marks = near.join(gold, ["query_id", "doc_id"]).groupBy("query_id").agg(best).select("query_id", F.col("g.doc_id").alias("_doc"), (-F.col("g.x")).alias("_ordering"))
    before = (F.col("ordering") > F.col("_ordering")) | ((F.col("ordering") == F.col("_ordering")) & (F.col("doc_id") < F.col("_doc")))
    ranks = candidates.select("query_id", "doc_id", "ordering").join(small(marks), "query_id").groupBy("query_id").agg((F.count_if(before) + 1).alias("rank"))
    return gold.select("query_id").distinct().join(ranks, "query_id", "left")


def pool_hit(ranks: DataFrame, sizes: tuple[int, ...] = (5, 10, 20, 30, 50, 100, 0)) -> DataFrame:
    """k, hit_rate, n: queries with a gold document in the first k candidates (0: all). ranks: of candidate_ranks()."""
    n = F.count(F.lit(1))
    hit = lambda k: F.count_if(F.col("rank") <= k) if k else F.count("rank")
    rows = F.array(*[F.struct(F.lit(k).alias("k"), (hit(k) / n).alias("hit_rate"), n.alias("n")) for k in sizes])
    return ranks.agg(rows.alias("r")).select(F.inline("r"))


def hubness(ranked: DataFrame, k: int = 10) -> DataFrame:
    """doc_id, queries: in how many queries' first k a document stands."""
    return ranked.where(F.col("rank") <= k).groupBy("doc_id").agg(F.count(F.lit(1)).alias("queries"))


def mcnemar(a: DataFrame, b: DataFrame, k: int = 10) -> DataFrame:
    """One row of a paired comparison of two rankings' hits at k: b_only, c_only, n, difference, sigma. a, b: of gold_ranks()."""
    both = a.select("query_id", F.coalesce(F.col("rank") <= k, F.lit(False)).alias("x")).join(b.select("query_id", F.coalesce(F.col("rank") <= k, F.lit(False)).alias("y")), "query_id")
    only_a, only_b, n = F.count_if(F.col("x") & ~F.col("y")), F.count_if(~F.col("x") & F.col("y")), F.count(F.lit(1))
    return both.agg(only_a.alias("only_a"), only_b.alias("only_b"), n.alias("n"), ((only_a - only_b) / n).alias("difference"), (F.sqrt((only_a + only_b).cast("double")) / n).alias("sigma"))
