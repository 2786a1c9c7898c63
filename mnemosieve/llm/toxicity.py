"""Toxicity by a convolutional text classifier in numpy.

A word's embedding is that of its hash plus that of the hash of its first bytes, so inflected forms of one stem share a part. Filters of
several widths slide over the words, each filter's largest response over the whole text is kept, and a logistic layer joins them. As the filters
are linear in the embeddings, a trained model is two tables of responses, and scoring is looking up, adding and taking maxima.

Thresholds are calibrated by language, which is read off the text's function words; the score is shifted so that every language's threshold
falls on THRESHOLD. A language's own threshold counts by the labels of its rarer class against TRUST labels' worth of the threshold of all languages
together, so few labels move it little. Training: at most TRAIN_DOCS labelled documents of each class and at most TRAIN_WORDS of their
words, those with the smallest hashes of doc_id. A document of more than DOC_WORDS words is learned from by so many of them, in evenly spaced windows; it shuts
no other out. Calibration: all labelled documents that may be
learned from, each by a network that hasn't learned from it, so the classes count as often as they occur. The networks are trained by one task each.

Defined results: null counts as empty; an empty text has the score of no response; repeated rows score alike; texts are read whole, in pieces of
bounded size; with no labelled document of one class every score is 0; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import arrow_map, carried, read_table, released, restored, WordHasher, worker_state, written
from mnemosieve.llm.folds import fold, labelled, sample_ids, texts_of

TRAIN_DOCS, TRAIN_WORDS, DOC_WORDS, TRUST = 2500, 5_000_000, 50_000, 10.0
#: Windows of a document with more than DOC_WORDS words.
WINDOWS = 50
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
WORDS, STEMS, STEM_BYTES, DIMENSION = 1 << 15, 1 << 13, 4, 12
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE, SEED = 6, 50, 0.08, 11
#: Mini-batches at least, so that a small sample is passed over more often, while that passes over PASSED words at most; spread of embeddings at first.
STEPS, PASSED, START = 200, 40_000_000, 0.03
#: Root of a log-likelihood ratio that chance rarely reaches; parts of the sample that take turns to set the thresholds.
SURELY, PARTS = 3.2, 4
#: Width of a bin of logits, which end at +-END; labelled ids up to which they are sent to the texts instead of joined with the logits.
BIN, END, SENT = 0.01, 40, 1_000_000
#: Words whose responses are held at once.
CHUNK = 20_000

# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on are this be by",
    "de": "der die das und ist nicht ein eine zu den mit von auf sich im",
    "fr": "le les des et est une qui dans pour sur du au pas par avec",
    "es": "el los y en por con para su las del una es lo se no",
}
LANGUAGES = len(FUNCTION_WORDS) + 1  # the last: none of them


class Reader:
    """Ids of words and stems, and the language, of each text of a column."""

    def __init__(self) -> None:
        self.hasher = WordHasher()
        self.trim = np.zeros(256, bool)
        self.trim[[*b".,;:!?\"'()[]"]] = True
        words, owner = [], []
        for i, text in enumerate(FUNCTION_WORDS.values()):
            found = self.hasher.words(pa.array([text]))[0]
            words.append(found)
            owner += [i] * len(found)
        self.known = np.concatenate(words)
        order = np.argsort(self.known)
        self.known, self.owner = self.known[order], np.array(owner)[order]

    def read(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word ids, stem ids, number of each text's first word (and the total), language of each text."""
        _, start, end, first, raw = self.hasher.words(text)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int32), first, np.full(len(text), LANGUAGES - 1)
        for _ in range(3):
            end = end - (self.trim[raw[end - 1]] & (end - start > 1))
            start = start + (self.trim[raw[start]] & (end - start > 1))
        word = self.hasher.spans(raw, start, end)
        stem = self.hasher.spans(raw, start, np.minimum(end, start + STEM_BYTES))
        at = np.minimum(np.searchsorted(self.known, word), len(self.known) - 1)
        hit = np.flatnonzero(self.known[at] == word)
        doc = np.searchsorted(first, hit, "right") - 1
        votes = np.bincount(doc * LANGUAGES + self.owner[at[hit]], minlength=len(text) * LANGUAGES).reshape(len(text), LANGUAGES)
        votes[:, -1] = 0
        language = np.where(votes.sum(1) > 0, votes.argmax(1), LANGUAGES - 1)
        return (word % np.uint64(WORDS)).astype(np.int32), (stem % np.uint64(STEMS)).astype(np.int32), first, language


def learned(words: int, most: int = DOC_WORDS, windows: int = WINDOWS) -> np.ndarray | slice:
    """Places of the words that a document of so many is learned from."""
    if words <= most:
        return slice(None)
    size = most // windows
    start = np.linspace(0, words - size, windows).astype(np.int64)
    return (start[:, None] + np.arange(size)).ravel()


class Network:
    """Embeddings, filters and the logistic layer."""

    def __init__(self, seed: int = SEED) -> None:
        r = np.random.default_rng(seed)
        self.words, self.stems = (r.normal(0, START, (n, DIMENSION)).astype(np.float32) for n in (WORDS, STEMS))
        self.words[:, 0], self.stems[:, 0] = 0, 0
        self.filters = r.normal(0, 0.3, (DIMENSION, sum(WIDTHS) * FILTERS)).astype(np.float32)
        self.filters[0] = np.abs(self.filters[0]) + 0.3
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.last, self.base = r.normal(0, 0.5, len(WIDTHS) * FILTERS).astype(np.float32), 0.0

    def tables(self) -> dict:
        """What scoring needs: some 8 MB, whatever the corpus."""
        return {"words": self.words @ self.filters, "stems": self.stems @ self.filters, "bias": self.bias, "last": self.last, "base": self.base}


def responses(g: np.ndarray, n: int) -> np.ndarray:
    """Responses of all filters at the first n words of g; those that reach past g's end are -inf."""
    out, column = np.full((n, len(WIDTHS) * FILTERS), -np.inf, np.float32), 0
    for k, width in enumerate(WIDTHS):
        fit = min(n, len(g) - width + 1)
        if fit > 0:
            total = g[:fit, column : column + FILTERS].copy()
            for i in range(1, width):
                total += g[i : i + fit, column + i * FILTERS : column + (i + 1) * FILTERS]
            out[:fit, k * FILTERS : (k + 1) * FILTERS] = total
        column += width * FILTERS
    return out


def pooled(tables: dict, words: np.ndarray, stems: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest response of each filter over each text, at least 0."""
    out = np.full((len(first) - 1, len(WIDTHS) * FILTERS), -np.inf, np.float32)
    reach = max(WIDTHS) - 1
    for at in range(0, len(words), CHUNK):
        stop = min(len(words), at + CHUNK)
        g = tables["words"][words[at : stop + reach]] + tables["stems"][stems[at : stop + reach]]
        r = responses(g, stop - at)
        lo, hi = np.searchsorted(first, at, "right") - 1, np.searchsorted(first, stop, "left")
        for k, width in enumerate(WIDTHS[1:], 1):  # a filter must not look into the next text
            for back in range(1, width):
                over = first[1:] - back - at
                r[over[(over >= 0) & (over < stop - at)], k * FILTERS : (k + 1) * FILTERS] = -np.inf
        docs = np.arange(lo, hi)
        docs = docs[first[docs + 1] > first[docs]]
        docs = docs[(first[docs + 1] > at) & (first[docs] < stop)]
        out[docs] = np.maximum(out[docs], np.maximum.reduceat(r, np.maximum(first[docs] - at, 0)))
    return np.maximum(out + tables["bias"], 0)


def strongest(net: Network, words: np.ndarray, stems: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each filter, where in a text its response is largest, and that response; -inf where the text is shorter than the filter."""
    value, where = np.full(len(net.bias), -np.inf, np.float32), np.zeros(len(net.bias), int)
    reach = max(WIDTHS) - 1
    for at in range(0, len(words), CHUNK):
        stop = min(len(words), at + CHUNK)
        r = responses((net.words[words[at : stop + reach]] + net.stems[stems[at : stop + reach]]) @ net.filters, stop - at)
        place = r.argmax(0)
        high = r[place, np.arange(len(place))]
        better = high > value
        value[better], where[better] = high[better], place[better] + at
    return where, value


def telling(docs: list[np.ndarray], labels: np.ndarray, buckets: int) -> np.ndarray:
    """How surely a bucket's words occur in documents of label 1 more often than by chance: the first coordinate of their embedding at the start.
    The root of the log-likelihood ratio, from SURELY on."""
    both = [np.zeros(buckets), np.zeros(buckets)]
    for ids, label in zip(docs, labels, strict=True):
        both[int(label)][np.unique(ids)] += 1
    n, hits, p = both[0] + both[1], both[1], labels.mean()
    expected = np.maximum(n * p, 1e-9)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(hits > 0, hits * np.log(hits / expected), 0) + np.where(n > hits, (n - hits) * np.log((n - hits) / np.maximum(n - expected, 1e-9)), 0)
    root = np.sqrt(2 * np.maximum(ratio, 0))
    return np.where(hits > expected, np.clip((root - SURELY) / SURELY, 0, 1.5), 0).astype(np.float32)


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adagrad over mini-batches; only the words at a filter's largest response are touched."""
    net, r = Network(seed), np.random.default_rng(seed)
    net.words[:, 0], net.stems[:, 0] = telling([w for w, _ in docs], labels, WORDS), telling([x for _, x in docs], labels, STEMS)
    sums = {x: np.full_like(getattr(net, x), 1e-2) for x in ("words", "stems", "filters", "bias", "last")}
    balance = np.where(labels == 1, 0.5 / max(1e-9, labels.mean()), 0.5 / max(1e-9, 1 - labels.mean()))

    def step(name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        sums[name][rows] += gradient * gradient
        getattr(net, name)[rows] -= RATE * gradient / np.sqrt(sums[name][rows])

    for _ in range(max(epochs, min(-(-STEPS * BATCH // max(1, len(docs))), PASSED // max(1, sum(len(w) for w, _ in docs))))):
        order = r.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            d_filters, d_bias, d_last = np.zeros_like(net.filters), np.zeros_like(net.bias), np.zeros_like(net.last)
            touched: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            d_base = 0.0
            batch = order[at : at + BATCH]
            for i in batch:
                words, stems = docs[i]
                where, value = strongest(net, words, stems)
                value = value + net.bias
                hidden = np.maximum(value, 0)
                keep = (r.random(len(hidden)) > 0.2) / 0.8
                logit = float(hidden * keep @ net.last) + net.base
                d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[i]) * balance[i] / len(batch)
                d_last += d * hidden * keep
                d_base += d
                back = np.where(value > 0, d * net.last * keep, 0).astype(np.float32)
                d_bias += back
                column = 0
                for k, width in enumerate(WIDTHS):
                    mine = np.flatnonzero(back[k * FILTERS : (k + 1) * FILTERS])
                    for j in range(width):
                        cols = column + j * FILTERS + mine
                        rows = where[k * FILTERS + mine] + j
                        g = back[k * FILTERS + mine]
                        d_filters[:, cols] += (net.words[words[rows]] + net.stems[stems[rows]]).T * g
                        touched.append((words[rows], stems[rows], (net.filters[:, cols] * g).T))
                    column += width * FILTERS
            step("last", d_last)
            step("bias", d_bias)
            step("filters", d_filters)
            net.base -= 0.1 * d_base
            if touched:
                g = np.concatenate([x[2] for x in touched])
                for name, ids in (("words", np.concatenate([x[0] for x in touched])), ("stems", np.concatenate([x[1] for x in touched]))):
                    rows, place = np.unique(ids, return_inverse=True)
                    total = np.zeros((len(rows), DIMENSION), np.float32)
                    np.add.at(total, place, g)
                    step(name, total, rows)
    return net


def best_threshold(logit: np.ndarray, label: np.ndarray, times: np.ndarray | None = None) -> float:
    """The middle of the gap at which F1 is largest. times: how many documents each logit stands for."""
    times = np.ones(len(logit)) if times is None else times
    order = np.argsort(-logit)
    hits = np.cumsum((label * times)[order])
    f1 = 2 * hits / (np.cumsum(times[order]) + (label * times).sum())
    f1[:-1][logit[order][:-1] == logit[order][1:]] = -1
    i = int(np.flatnonzero(f1 >= f1.max() - 1e-12)[-1])
    low = logit[order][i + 1] if i + 1 < len(order) else logit[order][i] - 2
    return float((logit[order][i] + max(low, logit[order][i] - 4)) / 2)


def logits(tables: dict, words: np.ndarray, stems: np.ndarray, first: np.ndarray) -> np.ndarray:
    return (pooled(tables, words, stems, first) * tables["last"]).sum(1) + tables["base"]  # row by row: no text's score depends on another


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT, train_docs: int = TRAIN_DOCS) -> dict | None:
    """The tables of a trained model with a shift for each language; None without labels of both classes."""
    rows = written(labelled(labels, label, folds, held_out), "toxicity-labels")
    chosen = sample_ids(rows.where("label = 1"), train_docs).unionByName(sample_ids(rows.where("label = 0"), train_docs))

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, stems, first, language = worker_state("toxicity_reader", Reader).read(batch.column(2))
        cut = lambda x: pa.array([x[a:b][learned(b - a)].astype("<u2").tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cut(words), cut(stems), pa.array(language, pa.int32())], ["doc_id", "label", "words", "stems", "language"])

    chosen = written(chosen, "toxicity-sample")
    found = written(arrow_map(texts_of(docs, chosen), read, "doc_id long, label int, words binary, stems binary, language int"), "toxicity-words")
    sizes = found.groupBy("doc_id", "label").agg(F.sum(F.octet_length("words") / 2).cast("long").alias("n"), F.xxhash64("doc_id").alias("h")).collect()
    kept, spent = set(), Counter()
    for y, _, n, doc in sorted((r["label"], r["h"], r["n"], r["doc_id"]) for r in sizes):  # 2 * train_docs rows at most
        if spent[y] + n <= TRAIN_WORDS:
            kept.add(doc)
            spent[y] += n
    found = found.where(F.col("doc_id").isin(*kept)) if len(kept) < len(sizes) else found
    table = sorted(found.collect(), key=lambda x: (x["doc_id"], x["words"]))  # TRAIN_WORDS of each class at most
    y = np.array([x["label"] for x in table], np.float64)
    if not len(y) or y.min() == y.max():
        return None
    ids = [(np.frombuffer(x["words"], "<u2").astype(np.int32), np.frombuffer(x["stems"], "<u2").astype(np.int32)) for x in table]
    language = np.array([x["language"] for x in table])
    part = np.random.default_rng(SEED).permutation(len(y)) % PARTS
    tables, logit = _trained(docs.sparkSession, ids, y, part)
    times = np.ones(len(y))
    rest = rows.join(F.broadcast(docs.sparkSession.createDataFrame([(int(x["doc_id"]),) for x in table], "doc_id long").distinct()), "doc_id", "left_anti")
    binned = _binned(docs, written(rest, "calibration-labels"), tables)
    if binned:
        more = np.array([(r["language"], r["label"], r["bin"] * BIN, r["count"]) for r in binned], np.float64)
        language, y = np.concatenate([language, more[:, 0].astype(int)]), np.concatenate([y, more[:, 1]])
        logit, times = np.concatenate([logit, more[:, 2]]), np.concatenate([times, more[:, 3]])
    overall = best_threshold(logit, y, times)
    own = [language == k for k in range(LANGUAGES)]
    trust = [min(times[x & (y == 1)].sum(), times[x & (y == 0)].sum()) for x in own]
    at = [(n * best_threshold(logit[x], y[x], times[x]) + TRUST * overall) / (n + TRUST) if n else overall for x, n in zip(own, trust, strict=True)]
    return tables | {"shift": np.array(at) - np.log(THRESHOLD / (1 - THRESHOLD))}


def _trained(spark: SparkSession, ids: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, part: np.ndarray) -> tuple[dict, np.ndarray]:
    """The tables of the network trained on all, and each document's logit by a network that hasn't learned from its part."""
    sent = spark.sparkContext.broadcast((ids, y, part))  # bounded by TRAIN_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, y, part = sent.value
        for k in (k for batch in batches for k in batch.column(0).to_pylist()):
            rest, own = np.flatnonzero(part != k), np.flatnonzero(part == k)
            if k == PARTS:
                out = train(ids, y).tables()
            elif len(set(y[rest])) == 2 and len(own):
                out = _logits_of(train([ids[i] for i in rest], y[rest]).tables(), [ids[i] for i in own])
            else:
                out = np.zeros(len(own))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([pickle.dumps(out)], pa.binary())], ["k", "out"])

    tasks = spark.range(0, PARTS + 1, 1, PARTS + 1).select(F.col("id").alias("k"))
    found = {r["k"]: pickle.loads(r["out"]) for r in tasks.mapInArrow(released(run), "k long, out binary").collect()}
    logit = np.zeros(len(y))
    for k in range(PARTS):
        logit[part == k] = found[k]
    return found[PARTS], logit


def _binned(docs: DataFrame, labels: DataFrame, tables: dict) -> list:
    """language, label, bin and count over all documents with one of the labels (doc_id, label): a bounded number of rows."""
    n = labels.count()
    if not n:
        return []
    sent = docs.sparkSession.sparkContext.broadcast(tables)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, stems, first, language = worker_state("toxicity_reader", Reader).read(batch.column(1))
        place = np.round(np.clip(logits(sent.value, words, stems, first), -END, END) / BIN)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(language.astype(np.int32), pa.int32()), pa.array(place.astype(np.int64))], ["doc_id", "language", "bin"])

    schema = "doc_id long, language int, bin long"
    if n <= SENT:
        found = arrow_map(docs.join(F.broadcast(labels.select("doc_id")), "doc_id", "left_semi"), run, schema).join(F.broadcast(labels), "doc_id")
    else:  # texts stay where they are
        found = arrow_map(docs, run, schema).join(labels, "doc_id")
    return found.groupBy("language", "label", "bin").count().orderBy("language", "label", "bin").collect()


def _logits_of(tables: dict, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    first = np.concatenate([[0], np.cumsum([len(w) for w, _ in docs])]).astype(np.int64)
    return logits(tables, np.concatenate([w for w, _ in docs]), np.concatenate([x for _, x in docs]), first)


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score, for each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tables = sent.value
        words, stems, first, language = worker_state("toxicity_reader", Reader).read(batch.column(1))
        score = 1 / (1 + np.exp(-np.clip(logits(tables, words, stems, first) - tables["shift"][language], -30, 30)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score.astype(np.float64))], ["doc_id", "score"])

    return arrow_map(docs, run, "doc_id long, score double")


def clean(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score under the threshold, with all their columns."""
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words, stems, first, language = worker_state("toxicity_reader", Reader).read(batch.column(0))
        logit = logits(sent.value, words, stems, first) - sent.value["shift"][language]
        kept = batch.filter(pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))) < threshold))
        return kept.select([1]) if kept.num_rows else None

    own = carried(docs, F.col("text"))
    return restored(arrow_map(own, run, own.select("_own").schema), docs)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
