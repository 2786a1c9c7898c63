"""Personal data: patterns for spans that are certain, a skip-chain conditional random field for those that context gives away.

Nodes are tokens with a digit, `@` or `+`; any other token can only be outside. Nodes that follow each other directly share a transition
potential. Nodes of one document that repeat or resemble each other, however far apart, share an entity: the same digits, the same letters and
digits, or the same last digits of the run so far or of what is left of it (a number with another prefix or other blanks). All nodes of an entity are tied to one hidden
label by a skip potential, so every pair of them is linked at the cost of one edge a node. Pattern spans are observed labels; loopy message
passing over the whole document carries them along both kinds of edges, so a number written once in full is known again without its prefix.

Weights of features, transitions and skips are fitted together by pseudo-likelihood to a bounded sample of documents. What the patterns find is
positive; nodes that share an entity with it, and number runs that look like a phone number but for the `+`, are unlabelled; the others are
outside. An added span has a node of probability SURE and only nodes likelier to be of its kind than anything else, and must be of a size and form its
kind can have. Base spans stay.

Defined results: null counts as empty; an empty text has no spans and the digest of an empty string; repeated rows give repeated results; texts
are read whole in linear time; where the sample holds no span nothing is added; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemosieve.llm.common import arrow_map, read_table, written
from mnemosieve.llm.folds import smallest

KINDS = ("email", "ip", "card", "phone")
#: Documents the field is fitted on for each kind; rounds of message passing; probability an added span needs; nodes of a block.
TRAIN_DOCS, ROUNDS, SURE, BLOCK = 2000, 15, 0.9, 100_000
#: Tokens an added span has at most, more than a number of 19 digits takes; last digits of a run up to a token, and from a token on, that make two
#: numbers alike; strength of a skip before the sample speaks, and between an entity and a pattern span of it; steps of the fit.
LONGEST_RUN, ENTITY_DIGITS, REST_DIGITS, SKIP_PRIOR, CERTAIN, STEPS = 20, 7, 10, 15.0, 40.0, 800

# The patterns, written so that no text makes them go back and forth.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT, MARK = re.compile(r"[0-9]"), re.compile(r"[0-9@+]")
TOKEN = re.compile(r"([^\s0-9@+]*+[0-9@+]\S*)|\S+")
NOT_DIGIT, NOT_WORD = re.compile(r"[^0-9]+"), re.compile(r"[\W_]+")
EDGES = ".,;:!?\"'()[]{}<>"
LABELS = 1 + len(KINDS)
#: Bits of features that a token of a phone number may have: 1 to 12 digits.
PHONE_DIGITS = 0b1111 << 10


def luhn(digits: str) -> bool:
    twice = [int(x) * 2 for x in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(x - 9 * (x > 9) for x in twice)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind by the patterns, in code points."""
    found: list[list[tuple[int, int]]] = [emails(text) if "@" in text else [], [], [], []]
    if DIGIT.search(text):
        found[1] = [m.span() for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found[2].append(m.span())
        if "+" in text:
            found[3] = [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return found


@lru_cache(maxsize=100_000)
def features(token: str) -> int:
    """What the token shows by itself, as bits."""
    core = token.strip(EDGES)
    digits = NOT_DIGIT.sub("", core)
    n = len(digits)
    letters = any(c.isalpha() for c in core)
    parts = core.split(".")
    flags = (
        True, "@" in core, "@" in core and bool(DOMAIN.search(core, core.rfind("@") + 1)), letters, token.startswith("+"), "(" in token, ")" in token, "-" in core, "=" in core,
        n == 0, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 8, 9 <= n <= 12, 13 <= n <= 19, n > 19, not letters and n == len(core), 13 <= n <= 19 and not letters and luhn(digits),
        len(parts) == 4 and all(x.isdigit() and x.isascii() and len(x) <= 3 and int(x) <= 255 for x in parts), core.count(".") == 1, core.count(".") > 3, core.count(".") == 2,
    )
    return sum(1 << i for i, x in enumerate(flags) if x)


#: Bits of a token; buckets of the word before a run.
BITS, WORDS_BEFORE = 22, 256
FEATURES = BITS + WORDS_BEFORE


class Graph:
    """Nodes, neighbours and entities of some documents, in arrays."""

    def __init__(self) -> None:
        self.doc, self.begin, self.end = array("i"), array("i"), array("i")
        self.mask, self.before, self.label = array("i"), array("i"), array("b")
        self.direct = array("b")  # follows the node before directly
        self.phone_like = array("b")  # in a run of number tokens of 10 to 15 digits, with brackets, hyphens or blanks
        self.key_node, self.key = array("i"), array("q")
        self.digits: deque[str] = deque(maxlen=20)  # of the last tokens of the run that is open

    def __len__(self) -> int:
        return len(self.doc)

    def add(self, doc: int, text: str, base: list[list[tuple[int, int]]]) -> None:
        owner = sorted((s, e, kind + 1) for kind, spans in enumerate(base) for s, e in spans)
        first, k, direct, said, so_far, run = len(self.doc), 0, False, 0, "", 0
        for m in TOKEN.finditer(text):
            if m[1] is None:
                if direct:
                    self.close_run(run)
                direct, said = False, 1 + zlib.crc32(m[0].lower().strip(EDGES).encode("utf-8", "surrogatepass")) % (WORDS_BEFORE - 1)
                continue
            start, end, token = m.start(), m.end(), m[0]
            while k < len(owner) and owner[k][1] <= start:
                k += 1
            me = len(self.doc)
            if not direct:
                run, so_far = me, ""
            self.doc.append(doc)
            self.begin.append(start)
            self.end.append(end)
            self.label.append(owner[k][2] if k < len(owner) and owner[k][0] < end else 0)
            self.mask.append(features(token))
            self.before.append(0 if direct else said)
            self.direct.append(direct)
            self.phone_like.append(0)
            digits, word = NOT_DIGIT.sub("", token), NOT_WORD.sub("", token).lower()
            self.digits.append(digits)
            so_far = (so_far + digits)[-ENTITY_DIGITS:]
            if len(digits) >= 6:
                self.key_node.append(me)
                self.key.append(hash((doc, "d", digits)))
            elif len(word) >= 6:
                self.key_node.append(me)
                self.key.append(hash((doc, "w", word)))
            if digits and len(so_far) == ENTITY_DIGITS:
                self.key_node.append(me)
                self.key.append(hash((doc, "s", so_far)))
            if 9 <= len(digits) <= 19:  # as if it were written in groups
                for at in range(0, len(digits) - ENTITY_DIGITS):
                    self.key_node.append(me)
                    self.key.append(hash((doc, "s", digits[at : at + ENTITY_DIGITS])))
            direct = True
        if direct and len(self.doc) > first:
            self.close_run(run)

    def close_run(self, run: int) -> None:
        size, rest = len(self.doc) - run, ""
        for me in range(len(self.doc) - 1, len(self.doc) - 1 - len(self.digits), -1):
            rest = self.digits.pop() + rest
            if len(rest) > 19:
                break
            if len(rest) >= REST_DIGITS:
                self.key_node.append(me)
                self.key.append(hash((self.doc[me], "r", rest[-REST_DIGITS:])))
        self.digits.clear()
        if size <= 8:
            masks = self.mask[run:]
            plain = all(m & 0b1010 == 0 and m & PHONE_DIGITS for m in masks)
            if plain and 10 <= len(rest) <= 15 and (size > 1 or masks[0] & 0b11100000):
                self.phone_like[run:] = array("b", [1] * size)

    def arrays(self) -> dict[str, np.ndarray]:
        """Features, labels and edges; entities of one node are left out."""
        take = lambda x, kind: np.frombuffer(x, kind) if len(x) else np.zeros(0, kind)
        node, key = take(self.key_node, np.int32), take(self.key, np.int64)
        _, entity, size = np.unique(key, return_inverse=True, return_counts=True)
        several = size[entity] > 1 if len(entity) else np.zeros(0, bool)
        number = np.cumsum(size > 1) - 1
        return {
            "mask": take(self.mask, np.int32), "before": take(self.before, np.int32), "label": take(self.label, np.int8), "direct": take(self.direct, np.int8) > 0,
            "phone_like": take(self.phone_like, np.int8) > 0, "node": node[several], "entity": number[entity[several]] if len(entity) else np.zeros(0, np.int64),
        }


def unary(mask: np.ndarray, before: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Scores of the labels by the features, a block of nodes at a time."""
    out = np.empty((len(mask), LABELS), np.float32)
    for at in range(0, len(mask), BLOCK):
        bits = (mask[at : at + BLOCK, None] >> np.arange(BITS)) & 1
        out[at : at + BLOCK] = bits @ weights[:BITS] + weights[BITS + before[at : at + BLOCK]]
    return out


def log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return top + np.log(np.exp(x - top).sum(1, keepdims=True))


def through(x: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Messages x (logarithms) sent through a table of potentials, label by label, so that a row's result depends on that row only."""
    e = np.exp(x - x.max(1, keepdims=True))
    total = np.stack([sum(e[:, a] * chances[a, b] for a in range(LABELS)) for b in range(LABELS)], 1)
    out = np.log(np.maximum(total, 1e-30))
    return out - out.max(1, keepdims=True)


def tied(x: np.ndarray, strength: np.ndarray | float) -> np.ndarray:
    """Messages x sent through a potential that favours the same label by `strength`."""
    out = np.logaddexp(log_sum(x), x + np.log(np.expm1(np.maximum(strength, 1e-6))).astype(np.float32))
    return out - out.max(1, keepdims=True)


def marginals(graph: dict[str, np.ndarray], model: tuple[np.ndarray, np.ndarray, float], rounds: int = ROUNDS) -> np.ndarray:
    """Probability of each label of each node after a fixed number of rounds, whatever other documents are in the graph. Labels that patterns
    gave are observed. Memory: some 200 bytes a node; messages are renewed a block at a time."""
    weights, near, skip = model
    score = unary(graph["mask"], graph["before"], weights)
    seen = np.flatnonzero(graph["label"])
    score[seen] = -30.0
    score[seen, graph["label"][seen]] = 0.0
    n, follows = len(score), np.flatnonzero(graph["direct"])
    node, entity = graph["node"], graph["entity"]
    forth, back = np.zeros((n, LABELS), np.float32), np.zeros((n, LABELS), np.float32)
    to_node, to_entity = np.zeros((len(node), LABELS), np.float32), np.zeros((len(node), LABELS), np.float32)
    chances = np.exp(near).astype(np.float32)
    entities = int(entity.max()) + 1 if len(entity) else 0
    ties = np.where(graph["label"][node] > 0, CERTAIN, skip).astype(np.float32)[:, None]  # what a pattern says of an entity holds for it

    def belief() -> np.ndarray:
        out = score + forth
        out += back
        for y in range(LABELS):
            out[:, y] += np.bincount(node, to_node[:, y], n).astype(np.float32)
        return out

    def renew(message: np.ndarray, at: np.ndarray | slice, new: np.ndarray) -> None:
        message[at] += np.float32(0.5) * (new - message[at])

    for _ in range(rounds if len(follows) or len(node) else 0):
        now = belief()
        old_forth = forth.copy()
        for at in range(0, len(follows), BLOCK):
            to = follows[at : at + BLOCK]
            renew(forth, to, through(now[to - 1] - back[to - 1], chances))
        for at in range(0, len(follows), BLOCK):
            to = follows[at : at + BLOCK] - 1
            renew(back, to, through(now[to + 1] - old_forth[to + 1], chances.T))
        del old_forth
        for at in range(0, len(node), BLOCK):
            part = slice(at, at + BLOCK)
            renew(to_entity, part, tied(now[node[part]] - to_node[part], ties[part]))
        del now
        total = np.stack([np.bincount(entity, to_entity[:, y], entities) for y in range(LABELS)], 1).astype(np.float32) if entities else np.zeros((0, LABELS), np.float32)
        for at in range(0, len(node), BLOCK):
            part = slice(at, at + BLOCK)
            renew(to_node, part, tied(total[entity[part]] - to_entity[part], skip))
    return softmax(belief())


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def observations(graph: dict[str, np.ndarray]) -> Counter:
    """For pseudo-likelihood: mask, word before, label, labels of the nodes before and after, label of the entity's other nodes, and how often.
    Labels of unlabelled nodes are -1; they are no rows, and tell their neighbours nothing."""
    label, direct = graph["label"].astype(np.int64), graph["direct"]
    entities = int(graph["entity"].max()) + 1 if len(graph["entity"]) else 0
    votes = np.zeros((entities, LABELS), np.int64)
    np.add.at(votes, (graph["entity"], label[graph["node"]]), 1)
    label = label.copy()
    shared = np.zeros(len(label), bool)  # a node of the entity was found by a pattern
    shared[graph["node"][votes[graph["entity"], 1:].sum(1) > 0]] = True
    label[(label == 0) & (shared | graph["phone_like"])] = -1
    votes[:] = 0
    known = label[graph["node"]] >= 0
    np.add.at(votes, (graph["entity"][known], label[graph["node"]][known]), 1)
    others = np.full(len(label), -1)
    if entities:
        rest = votes[graph["entity"]]
        rest[known, label[graph["node"]][known]] -= 1
        some = rest.sum(1) > 0
        others[graph["node"][some]] = rest[some].argmax(1)
    before, after = np.full(len(label), -1), np.full(len(label), -1)
    follows = np.flatnonzero(direct)
    before[follows], after[follows - 1] = label[follows - 1], label[follows]
    rows = np.flatnonzero(label >= 0)
    return Counter(zip(*(x[rows].tolist() for x in (graph["mask"], graph["before"], label, before, after, others)), strict=True))


def learned(seen: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Weights of features and of transitions and the strength of skips that make each observed label likeliest given its features and neighbours,
    and given its features alone, in equal parts: so features don't leave to neighbours what they could tell themselves."""
    if not any(row[2] > 0 for row, _ in seen):
        return None
    seen = [*seen, *((row[:3] + (-1, -1, -1), c) for row, c in seen)]
    mask, before, label, left, right, other = np.array([row for row, _ in seen], np.int64).T
    count = np.array([c for _, c in seen], np.float64)
    count /= count.sum()
    bits = ((mask[:, None] >> np.arange(BITS)) & 1).astype(np.float64)
    truth = np.eye(LABELS)[label]
    weights, near, skip = np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), SKIP_PRIOR
    speed = [np.zeros_like(weights), np.zeros_like(near), 0.0]
    has_left, has_right, has_other = left >= 0, right >= 0, other >= 0
    same = np.zeros((len(label), LABELS))
    same[has_other, other[has_other]] = 1.0
    for _ in range(STEPS):
        score = bits @ weights[:BITS] + weights[BITS + before] + skip * same
        score[has_left] += near[left[has_left]]
        score[has_right] += near[:, right[has_right]].T
        error = (softmax(score) - truth) * count[:, None]
        slope = np.concatenate([bits.T @ error, np.zeros((WORDS_BEFORE, LABELS))])
        np.add.at(slope, BITS + before, error)
        slope += np.concatenate([np.full((BITS, 1), 1e-5), np.full((WORDS_BEFORE, 1), 1e-3)]) * weights
        slope_near = 1e-4 * near
        np.add.at(slope_near, left[has_left], error[has_left])
        np.add.at(slope_near.T, right[has_right], error[has_right])
        slope_skip = float((error * same).sum()) + 1e-4 * (skip - SKIP_PRIOR)
        speed = [0.9 * v - g for v, g in zip(speed, (slope, slope_near, slope_skip), strict=True)]
        weights, near, skip = weights + speed[0], near + speed[1], min(20.0, max(0.0, skip + speed[2]))
    return weights.astype(np.float32), np.clip(near, -6, 6), float(skip)


def fit(docs: DataFrame, most: int = TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray, float] | None:
    """The field's weights, from at most `most` documents for each kind that hold a pattern span of it, found over all documents, and as many that only
    hold a digit, @ or + (those with the smallest hashes of doc_id and text)."""
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    marked = docs.where(F.col("text").rlike("[0-9@+]")).withColumn("_key", key)

    def kinds(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = [sum(1 << k for k, spans in enumerate(base_spans(x)) if spans) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.int32())], ["_key", "_held"])

    held = written(arrow_map(marked.select("_key", "text"), kinds, "_key long, _held int").distinct(), "pii-kinds")
    ids = smallest(held.where("_held = 0").select("_key"), "_key", most)
    for k in range(len(KINDS)):
        ids = ids.unionByName(smallest(held.where(F.col("_held").bitwiseAND(1 << k) != 0).select("_key"), "_key", most))
    sample = marked.join(F.broadcast(ids.distinct()), "_key", "left_semi").dropDuplicates(["_key"])
    names = ["mask", "before", "label", "left", "right", "other"]

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        graph = Graph()
        for i, text in enumerate(batch.column(0).to_pylist()):
            graph.add(i, text, base_spans(text))
        found = observations(graph.arrays())
        columns = [*(zip(*found, strict=True) if found else [()] * len(names)), found.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in columns], [*names, "n"])

    rows = arrow_map(sample.select("text"), count, ", ".join(f"{x} long" for x in [*names, "n"])).groupBy(*names).agg(F.sum("n").alias("n")).orderBy(*names).collect()
    return learned([(tuple(r[x] for x in names), r["n"]) for r in rows])


def plausible(kind: int, core: str) -> bool:
    """Whether an added span has the size and form of its kind."""
    digits = NOT_DIGIT.sub("", core)
    if kind == 0:
        return "@" in core
    if kind == 1:
        return bool(IP.fullmatch(core)) and all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in core.split("."))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def added_spans(graph: Graph, known: dict[str, np.ndarray], chance: np.ndarray, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """doc, kind, start, end of the spans that the field adds: runs of nodes with one likely label, one of them sure, without nodes at the front that
    a span of the kind can't have."""
    best = chance.argmax(1)
    high = chance[np.arange(len(best)), best]
    likely = np.flatnonzero((best > 0) & (known["label"] == 0) & (high >= 0.5))
    run: list[int] = []
    for node in [*likely.tolist(), -1]:
        if run and node >= 0 and node == run[-1] + 1 and known["direct"][node] and best[node] == best[run[0]]:
            run.append(node)
            continue
        if run and high[run].max() >= SURE:
            doc, kind = graph.doc[run[0]], int(best[run[0]]) - 1
            for skipped in range(max(0, len(run) - LONGEST_RUN), len(run)):
                start, end = graph.begin[run[skipped]], graph.end[run[-1]]
                core = texts[doc][start:end]
                start, end = start + len(core) - len(core.lstrip(EDGES.replace("(", ""))), end - (len(core) - len(core.rstrip(EDGES)))
                if plausible(kind, texts[doc][start:end]):
                    yield doc, kind, start, end
                    break
        run = [node]


def written_spans(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, found in zip(KINDS, spans, strict=True) for s, e in sorted(found))


def find(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, counts of the pattern spans, their digest, all spans, and how many the field added, for each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = fit(docs, train_docs)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        base = [base_spans(x) for x in texts]
        spans = [[list(x) for x in b] for b in base]
        graph = Graph()
        if model:
            for i, x in enumerate(texts):
                if MARK.search(x):
                    graph.add(i, x, base[i])
        added = [0] * len(texts)
        if len(graph):
            known = graph.arrays()
            for doc, kind, start, end in added_spans(graph, known, marginals(known, model), texts):
                spans[doc][kind].append((start, end))
                added[doc] += 1
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
        columns = [batch.column(0), *(pa.array([len(b[i]) for b in base], pa.int64()) for i in range(len(KINDS)))]
        columns += [pa.array([hashlib.sha256(written_spans(b).encode()).hexdigest() for b in base], pa.string()), pa.array([written_spans(s) for s in spans], pa.string()), pa.array(added, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names)

    return arrow_map(docs, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(read_table(spark, sf_dir, "documents"))
