"""URL filter: rules first, then gradient-boosted trees on lexical features. DataFrame functions only.

Rules judge the URLs that they fit, and these judgements are the labels the trees learn from; the trees judge the rest. Features: lengths,
depth, digit ratio, character entropy, parameters, hyphens, labels of the host, and the share of blocked URLs among those labelled under
the host's last label and its last two. The shares count all labelled URLs, but for a labelled URL only those of other folds, so its own label is no
part of its features. The trees are fitted on TRAIN_ROWS labelled URLs at most, half of them of
either verdict where there are enough, those with the smallest hashes; weights restore the verdicts' shares.

Defined results: a null URL or one without `://` has an empty host and path; a URL that fits no rule is allowed where there is nothing to
learn from (no labelled URL of one verdict, or an empty table); repeated rows are judged alike; of rules of one length the first given
wins; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import attach_groups, lower_ascii, read_table, written

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Labelled URLs the trees are fitted on; trees and their depth; pseudo-counts of a suffix's share; folds of labelled URLs.
TRAIN_ROWS, TREES, TREE_DEPTH, PRIOR, FOLDS = 20_000, 20, 4, 20.0, 5
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
FEATURES = ["url_length", "host_length", "path_length", "depth", "digits", "entropy", "parameters", "hyphens", "labels", "last_label", "last_two"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url.cast("string"), F.lit(""))
    return lower_ascii(F.regexp_extract(text, PARTS, 1)), F.regexp_extract(text, PARTS, 2)


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    def choose(value):
        out = F.lit(None).cast("string")
        for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
            at, slash, rest = rule.partition("/")
            fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + rest)
            out = F.when(fits, F.lit(value(rule, verdict))).otherwise(out)
        return out

    return choose(lambda rule, _: rule), choose(lambda _, verdict: verdict)


def _count(text: Column, *what: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, "".join(what), ""))).cast("double")


def lexical(df: DataFrame) -> DataFrame:
    """df (url, host, path) with the features that a URL shows by itself."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size
    entropy = F.aggregate(F.array_distinct(F.filter(F.split(url, ""), lambda c: c != "")), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))
    return df.withColumns({
        "url_length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"), "path_length": F.length("path").cast("double"),
        "depth": _count(F.col("path"), "/"), "digits": _count(url, *"0123456789") / size, "entropy": entropy,
        "parameters": _count(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "="), "hyphens": _count(F.col("host"), "-"), "labels": _count(F.col("host"), "."),
        "suffix": F.substring_index("host", ".", -2),
    })


def with_shares(rows: DataFrame) -> DataFrame:
    """rows (suffix, url, label) with last_two and last_label: smoothed shares of blocked URLs, for a labelled URL among those of the other folds."""
    part = F.when(F.col("label").isNotNull(), F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")).otherwise(FOLDS)
    rows = rows.withColumn("part", part)
    counts = written(rows.groupBy("suffix", "part").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("known"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")), "suffixes")
    known, blocked = counts.agg(F.sum("known"), F.sum("blocked")).first()
    base = (blocked or 0.0) / max(1, known or 0)
    others = [F.array(*(F.coalesce(F.sum(F.when(F.col("part") != k, F.col(c))), F.lit(0)).cast("double") for k in range(FOLDS + 1))).alias(c) for c in ("known", "blocked")]
    smooth = lambda b, n, prior: (b + prior * PRIOR) / (n + PRIOR)
    each = lambda blocked, known, prior: F.array(*(smooth(blocked[k], known[k], prior(k)) for k in range(FOLDS + 1)))
    last = counts.groupBy(F.substring_index("suffix", ".", -1).alias("last")).agg(*others, F.count_distinct("suffix").alias("suffixes"))
    last = written(last.select("last", "suffixes", each(F.col("blocked"), F.col("known"), lambda k: F.lit(base)).alias("last_label")), "last-shares")
    two = counts.groupBy("suffix").agg(*others, F.sum("n").alias("n")).withColumn("last", F.substring_index("suffix", ".", -1))
    two = attach_groups(two, last, ["last"], "suffixes")
    shares = written(two.select("suffix", "n", "last_label", each(F.col("blocked"), F.col("known"), lambda k: F.col("last_label")[k]).alias("last_two")), "suffix-shares")
    found = attach_groups(rows, shares, ["suffix"], "n").drop("n")
    return found.withColumns({"last_label": F.col("last_label")[F.col("part")], "last_two": F.col("last_two")[F.col("part")]}).drop("part")


def training_rows(full: DataFrame, most: int) -> DataFrame:
    """At most `most` labelled rows, with label, weight and features: of each verdict those with the smallest hashes, half of them at least from the rarer one if
    it has so many. A row's weight is what it stands for: the rows of its verdict over those taken. A cut by the hash leaves some two times the rows
    wanted, so that tasks don't send a whole sample each."""
    known = full.where("label is not null").withColumn("_key", F.xxhash64("url", "page_id"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    parts = []
    for label, n in sorted(counts.items()):
        take, wanted = min(n, max(most // 2, most - sum(m for x, m in counts.items() if x != label))), 0
        own = known.where(F.col("label") == label)
        while True:
            wanted = 2 * take + 1000 if not wanted else 2 * wanted
            some = own.where(F.col("_key") < int(-(1 << 63) + (1 << 64) * (wanted / n))) if n > wanted else own
            sample = written(some.orderBy("_key", "page_id").limit(take).select("label", F.lit(n / take).alias("weight"), *FEATURES), "url-sample")
            if n <= wanted or sample.count() >= take:
                break
        parts.append(sample)
    return reduce(DataFrame.unionByName, parts) if parts else known.limit(0).select("label", F.lit(1.0).alias("weight"), *FEATURES)


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability of block; null where nothing could be learned)."""
    host, path = host_and_path(F.col("url"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = lexical(pages.select("page_id", "url").withColumn("host", host).withColumn("path", path).withColumn("rule", rule).withColumn("given", verdict))
    rows = rows.withColumn("label", F.when(F.col("given") == "block", 1.0).when(F.col("given") == "allow", 0.0))
    out = ["page_id", "host", "path", "rule", "verdict", "score"]
    full = with_shares(rows)
    sample = training_rows(full, train_rows)
    seen = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:
        return full.withColumn("verdict", F.coalesce("given", F.lit("allow"))).withColumn("score", F.lit(None).cast("double")).select(*out)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.2, seed=7).fit(vectors.transform(sample))
    score = boosted_score(model)
    return full.withColumn("score", score).withColumn("verdict", F.coalesce("given", F.when(F.col("score") > 0.5, "block").otherwise("allow"))).select(*out)


def boosted_score(model) -> Column:
    """The model as one expression: the weighted sum of its trees as nested conditions, through the logistic link."""
    def tree(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.col(FEATURES[split.featureIndex()]) <= float(split.threshold()), tree(node.leftChild())).otherwise(tree(node.rightChild()))

    total = reduce(lambda a, b: a + b, (tree(t._call_java("rootNode")) * float(w) for t, w in zip(model.trees, model.treeWeights, strict=True)))
    return 1.0 / (1.0 + F.exp(-2.0 * total))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "pages"))
