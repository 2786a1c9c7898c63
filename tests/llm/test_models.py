import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemosieve.llm import pii, quality, toxicity
from mnemosieve.llm.pii import luhn

ODD = [(5000, None), (5001, ""), (5002, " \n"), (5003, "x" * 300_000), (5004, "12 " * 5000), (5004, "12 " * 5000), (5005, "@ + @ +1 a@b")]
PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    if not re.search("[0-9@]", text or ""):
        return out
    for kind, p in zip(pii.KINDS, PATTERNS, strict=True):
        for m in p.finditer(text or ""):
            n = re.sub(r"[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 13 <= len(n) <= 19 and luhn(n) or kind == "phone" and 9 <= len(n) <= 15:
                out.append((pii.KINDS.index(kind), m.start(), m.end()))
    return sorted(out)


TRICKY = ["a@b@c.de x@y.z.. q@r a..b@-.- ", "1.2.3.4.5 300.1.1.1 1.2.3.4.5.6.7.8 01.02.03.004", "4111 1111-1111 1111 4111111111111112 +1 (988) 555-2485", "x@y.co@z.de é@a.b", "+1 2 3 4 5 6 7 8 9 4 0 ++1 22 333 4444", "🙂 mail 🙂 a.b@c.org, 8.8.8.8."]


def test_base_spans(spark):
    from tests.conftest import DATA

    texts = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()] + TRICKY + [t for _, t in ODD if t and len(t) < 20_000]
    for t in texts:
        assert [(k, s, e) for k, spans in enumerate(pii.base_spans(t)) for s, e in spans] == plain_spans(t)


def test_pii_query(spark):
    import hashlib

    rows = list(enumerate(TRICKY)) + ODD + [(i, f"mail a{i}.b@c{i}.org or +1 (988) 555-{1000 + i} and 10.0.0.{i}") for i in range(20, 60)] + [(70, "call +1 (988) 555-1234 now. Later again 988 555-1234.")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, spans string")
    out = pii.find(df).collect()
    assert len(out) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    for r in out:
        want = plain_spans(texts[r["doc_id"]])
        told = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x == i for x, *_ in want) for i in range(4)]
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))
        assert r["spans"].count(":") == 2 * (len(want) + r["n_added"])
    assert next(r for r in out if r["doc_id"] == 70)["spans"] == "phone:5:22,phone:40:52"
    assert pii.find(df.limit(0)).count() == 0
    assert pii.find(spark.createDataFrame([(1, "no data at all"), (2, "7 days")], "doc_id long, text string")).where("n_added > 0").count() == 0


def field(graph, known, weights, near, skip):
    """Exact marginals of a small graph by enumeration, hidden labels of entities included."""
    import itertools

    n, u = len(graph), pii.unary(known["mask"], known["before"], weights)
    hubs = int(known["entity"].max()) + 1 if len(known["entity"]) else 0
    free = [range(pii.LABELS) if not y else [y] for y in known["label"]]
    total = np.zeros((n, pii.LABELS))
    for ys in itertools.product(*free):
        p = sum(u[i, y] for i, y in enumerate(ys) if not known["label"][i]) + sum(near[ys[i - 1], ys[i]] for i in np.flatnonzero(known["direct"]))
        p = np.exp(p)
        for h in range(hubs):
            members = known["node"][known["entity"] == h]
            p *= sum(np.exp(sum((pii.CERTAIN if known["label"][i] else skip) * (ys[i] == z) for i in members)) for z in range(pii.LABELS))
        for i, y in enumerate(ys):
            total[i, y] += p
    return total / total.sum(1, keepdims=True)


@pytest.mark.parametrize(("text", "exact"), [("call +1 988 5552485 now, and far away we read 5552485 again", 1e-3), ("was 123456 and 123456 or 12 123456", 1e-3), ("+1 988 555 1234 then 988 555 1234 and 1 988 555 1234", 0.2)])
def test_marginals_against_enumeration(text, exact):
    graph = pii.Graph()
    graph.add(0, text, pii.base_spans(text))
    known = graph.arrays()
    assert len(known["entity"])
    r = np.random.default_rng(3)
    weights = (r.normal(size=(pii.FEATURES, pii.LABELS)) * 0.5).astype(np.float32)
    near = np.where(np.eye(pii.LABELS) > 0, 1.0, 0.0)
    got, want = pii.marginals(known, (weights, near, 2.0), 60), field(graph, known, weights, near, 2.0)
    assert np.abs(got - want).max() < exact  # the last graph has loops


def planted(seed=5, n=240):
    """Documents with numbers written in full and again in another way, those numbers, and documents with numbers that are none of these."""
    r = np.random.default_rng(seed)
    digits = lambda k: "".join(map(str, r.integers(0, 10, k)))
    words = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(200)]
    rows, truth = [], {}
    for i in range(n):
        text = list(r.choice(words, 60))
        a, b, c = str(r.integers(200, 999)), str(r.integers(200, 999)), digits(4)
        extra = [str(r.choice(["1697040000", "2023-10-11", "room 1234", "3.14159", "v1.2.3", "12 34 56"]))]
        if i % 3:
            full = [f"+1 ({a}) {b}-{c}", f"+1{a}{b}{c}", f"+1 {a} {b} {c}"][i % 9 // 3]
            again = [f"1{a}{b}{c}", f"({a}) {b}-{c}", f"{a} {b}-{c}", f"{a}{b}{c}", f"1 {a} {b} {c}"][i % 5]
            extra += [full, again]
            truth[i] = a + b + c
        elif i % 2:
            card = next(x for x in (f"4{digits(15)}" for _ in range(1000)) if luhn(x))
            extra += [card, "2024 " + " ".join(card[k : k + 4] for k in range(0, 16, 4))]
            truth[i] = card
        for x in extra:
            text.insert(int(r.integers(len(text))), f"{r.choice(words)} {x} {r.choice(words)}")
        rows.append((i, " ".join(text)))
    return rows, truth


def test_field_finds_what_is_written_again(spark):
    rows, truth = planted()
    found = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    right = wrong = 0
    for i, text in rows:
        base = {f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in plain_spans(text)}
        added = [x.split(":") for x in found[i]["spans"].split(",") if x and x not in base]
        assert len(added) == found[i]["n_added"]
        hits = [i in truth and re.sub("[^0-9]", "", text[int(s) : int(e)]).endswith(truth[i][-10:]) and kind == ("card" if len(truth[i]) == 16 else "phone") for kind, s, e in added]
        right, wrong = right + any(hits), wrong + len(hits) - sum(hits)

    assert right >= 0.95 * len(truth) and wrong <= 0.05 * right
    one = [(1, "call +19885551234 now. Later again 19885551234."), (2, "call +1 988 555 1234 now. Later again 1 988 555 1234 or 988 555 1234.")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(one + [(i + 10, t) for i, t in rows], "doc_id long, text string")).collect()}
    assert got[1] == "phone:5:17,phone:35:46" and got[2] == "phone:5:20,phone:38:52,phone:56:68"


def test_scores_do_not_depend_on_other_documents():
    rows, _ = planted(n=20)
    r = np.random.default_rng(3)
    model = (r.normal(size=(pii.FEATURES, pii.LABELS)).astype(np.float32), r.normal(size=(pii.LABELS, pii.LABELS)), 3.0)
    together = pii.Graph()
    for i, t in rows:
        together.add(i, t, pii.base_spans(t))
    whole, at = pii.marginals(together.arrays(), model), 0
    for i, t in rows:
        alone = pii.Graph()
        alone.add(i, t, pii.base_spans(t))
        assert np.array_equal(pii.marginals(alone.arrays(), model), whole[at : at + len(alone)])
        at += len(alone)


def test_long_run_of_numbers():
    graph, text = pii.Graph(), "12 " * 200_000
    graph.add(0, text, pii.base_spans(text))
    model = (np.ones((pii.FEATURES, pii.LABELS), np.float32) * np.arange(pii.LABELS, dtype=np.float32), np.eye(pii.LABELS), 3.0)
    known = graph.arrays()
    chance = pii.marginals(known, model)
    assert np.isfinite(chance).all() and len(chance) == 200_000
    assert all(9 <= (e - s + 1) // 3 * 2 <= 15 for _, _, s, e in pii.added_spans(graph, known, chance, [text]))


def corpus(spark, n=1200):
    r = np.random.default_rng(4)
    vocab = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(400)]
    bad = ["idiotic", "scummy", "moronic", "trashy"]
    rows, labels = [], []
    for i in range(n):
        words = list(r.choice(vocab, int(r.integers(20, 120))))
        toxic, low = i % 5 == 0, i % 4 == 0
        if toxic:
            for _ in range(3):
                words[int(r.integers(len(words)))] = str(r.choice(bad))
        if low:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "clash"))
        labels.append((i, int(not low), int(toxic)))
    return spark.createDataFrame(rows + [(i, t, "clash") for i, t in ODD], "doc_id long, text string, label string"), spark.createDataFrame(labels + [(None, 1, 1), (0, None, None), (99_999, 1, 0)], "doc_id long, quality int, toxic int"), labels


@pytest.mark.parametrize(("module", "column", "at"), [(toxicity, "toxic", 2), (quality, "quality", 1)])
def test_held_out_accuracy(spark, module, column, at):
    docs, labels, truth = corpus(spark)
    model = module.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in module.scored(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and module.scored(docs, model).count() == docs.count()
    limit = toxicity.THRESHOLD if module is toxicity else 0.5
    held = [x for x in truth if zlib.crc32(str(x[0]).encode()) % module.FOLDS == module.HELD_OUT]
    right = [(got[x[0]] >= limit) == (x[at] == 1) for x in held]
    assert len(held) > 200 and np.mean(right) > 0.97
    again = {r["doc_id"]: r["score"] for r in module.scored(docs.repartition(3), module.fit(docs.repartition(5), labels)).collect()}
    assert max(abs(got[i] - again[i]) for i in got) < 1e-5
    assert module.scored(docs.limit(0), model).count() == 0


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels, _ = corpus(spark, 300)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_without_labels(spark):
    docs, labels, _ = corpus(spark, 20)
    assert toxicity.fit(docs, labels.limit(0)) is None and quality.fit(docs, labels.limit(0)) is None
    assert toxicity.scored(docs, None).where("score <> 0").count() == 0 and quality.scored(docs, None).where("score <> 0.5").count() == 0
    assert toxicity.clean(docs, None).count() == docs.count()


def test_clean_keeps_columns(spark):
    docs, labels, _ = corpus(spark)
    model = toxicity.fit(docs, labels)
    out = toxicity.clean(docs, model)
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    assert out.where("doc_id = 5000 and text is null").count() == 1
    assert toxicity.clean(docs.limit(0), model).count() == 0


def test_pooling_in_pieces(monkeypatch):
    r = np.random.default_rng(0)
    net = toxicity.Network()
    net.words[:], net.stems[:] = r.normal(size=net.words.shape), r.normal(size=net.stems.shape)
    tables = net.tables()
    sizes = [0, 1, 2, 7, 0, 30, 3, 0]
    first = np.concatenate([[0], np.cumsum(sizes)])
    w, s = r.integers(0, 100, first[-1]).astype(np.int32), r.integers(0, 100, first[-1]).astype(np.int32)
    whole = toxicity.pooled(tables, w, s, first)
    for chunk in (1, 2, 5, 11):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        assert np.allclose(whole, toxicity.pooled(tables, w, s, first))
    for i, n in enumerate(sizes):
        alone = toxicity.pooled(tables, w[first[i] : first[i + 1]], s[first[i] : first[i + 1]], np.array([0, n]))
        assert np.allclose(whole[i], alone[0])


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_thresholds_come_from_all_labelled_rows(spark, monkeypatch, sent):
    docs, labels, truth = corpus(spark)
    seen, best = [], toxicity.best_threshold

    def spy(logit, label, times=None):
        times = np.ones(len(logit)) if times is None else times
        seen.append((times[label == 1].sum(), times[label == 0].sum()))
        return best(logit, label, times)

    monkeypatch.setattr(toxicity, "best_threshold", spy)
    monkeypatch.setattr(toxicity, "SENT", sent, raising=False)
    toxicity.fit(docs, labels, train_docs=60)
    own = [t for i, _, t in truth if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT]
    assert seen[0] == (sum(own), len(own) - sum(own))


def test_threshold_weighs_documents():
    logit, label = np.array([3.0, 2.0, 1.0, 0.0, -1.0]), np.array([1.0, 1.0, 0.0, 1.0, 0.0])
    assert -1 < toxicity.best_threshold(logit, label) < 0
    assert 1 < toxicity.best_threshold(logit, label, np.array([1, 1, 10, 1, 10.0])) < 2
    assert toxicity.best_threshold(logit, label, np.array([1, 1, 2, 1, 1.0])) == toxicity.best_threshold(logit[[0, 1, 2, 2, 3, 4]], label[[0, 1, 2, 2, 3, 4]])


def test_field_learns_kinds_that_are_rare(spark):
    rows = [(i, f"{i} days and {i % 7} nights") for i in range(3000)] + [(None, "call +1 (988) 555-2485 now"), (5000, "pay with 4111 1111 1111 1111 here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs, 20)
    assert model is not None
    near = np.exp(model[0]).sum(0)
    assert all(np.abs(model[0][:, pii.KINDS.index(k) + 1]).max() > 0.1 for k in ("card", "phone")) and np.isfinite(near).all()


def test_quality_scores_do_not_depend_on_the_slice(spark, monkeypatch):
    import pyarrow as pa

    docs, labels, _ = corpus(spark, 200)
    texts = pa.array([r["text"] or "" for r in docs.collect()])
    whole = quality.Terms().read(texts)
    alone = np.concatenate([quality.Terms().read(texts[i : i + 1]) for i in range(len(texts))])
    assert np.array_equal(whole, alone)
    assert np.array_equal(quality.dense(quality.sparse(whole)), whole.astype(np.float16).astype(np.float32))
    a, b = quality.fit(docs.repartition(1), labels), quality.fit(docs.repartition(7), labels)
    assert all(np.array_equal(a[k], b[k]) for k in a)
    one = {r["doc_id"]: r["score"] for r in quality.scored(docs.repartition(1), a).collect()}
    monkeypatch.setattr("mnemosieve.llm.common.BATCH_ROWS", 1)
    assert one == {r["doc_id"]: r["score"] for r in quality.scored(docs.repartition(5), a).collect()}


def test_vote_against_all_neighbours():
    r = np.random.default_rng(1)
    vectors, labelled = quality.unit(r.normal(size=(300, 48))).astype(np.float32), quality.unit(r.normal(size=(900, 48))).astype(np.float32)
    model = {"vectors": labelled, "labels": r.integers(0, 2, 900).astype(float)}
    got = quality.vote(vectors, model)
    for v, score in zip(vectors, got, strict=True):
        cosine = np.array([float(np.dot(v.astype(float), x.astype(float))) for x in labelled])
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** quality.POWER + 1e-6
        assert abs(score - (weight * model["labels"][near]).sum() / weight.sum()) < 1e-5


def test_statistics_cover_all_documents(spark):
    docs, _, _ = corpus(spark, 120)
    table = quality.represented(docs)
    counts = np.stack([quality.dense(__import__("pyarrow").array([r["terms"]]))[0] for r in table.collect()])
    weights = quality.term_weights(table)
    seen = (counts > 0).sum(0)
    some = quality.SHAPES + quality.STEMS
    assert np.allclose(weights[:some], np.log((1 + len(counts)) / (1 + seen[:some])) + 0.2)
    x = quality.unit(counts * weights).astype(float)
    basis = quality.latent_basis(table, weights).astype(float)
    _, v = np.linalg.eigh(x.T @ x)
    assert np.allclose(np.abs((basis[:, :5] * v[:, ::-1][:, :5]).sum(0)), 1, atol=1e-3)


@pytest.mark.parametrize(("module", "column"), [(toxicity, "toxic"), (quality, "quality")])
def test_long_documents_are_learned_from(spark, module, column):
    r = np.random.default_rng(4)
    vocab = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(400)]
    rows = [(i, " ".join([*r.choice(vocab, 36_000), *(["Idiotic!!", "MORONIC!!"] * 1500 if i % 2 else [])])) for i in range(12)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i, _ in rows], f"doc_id long, {column} int")
    assert min(len(t) for _, t in rows) > 200_000
    model = module.fit(docs, labels)
    assert model is not None
    limit = toxicity.THRESHOLD if module is toxicity else 0.5
    assert all((x["score"] >= limit) == (x["doc_id"] % 2 == 1) for x in module.scored(docs, model).collect())


def test_training_texts_are_bounded(spark, monkeypatch):
    docs, labels, _ = corpus(spark, 400)
    seen, trained = [], toxicity._trained
    monkeypatch.setattr(toxicity, "_trained", lambda s, ids, y, part: (seen.append((len(y), sum(len(w) for w, _ in ids))), trained(s, ids, y, part))[1])
    monkeypatch.setattr(toxicity, "TRAIN_WORDS", 600)
    assert toxicity.fit(docs, labels) is not None
    assert 2 <= seen[0][0] < 60 and seen[0][1] <= 2 * 600


def test_a_long_document_shuts_no_other_out(spark, monkeypatch):
    docs, labels, _ = corpus(spark, 200)
    ids = toxicity.labelled(labels, "toxic", toxicity.FOLDS, toxicity.HELD_OUT).where("label = 1").select("doc_id")
    first = ids.orderBy(F.xxhash64("doc_id")).first()[0]
    docs = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.concat("text", F.lit(" ")), 400)).otherwise(F.col("text")))
    seen, trained = [], toxicity._trained
    monkeypatch.setattr(toxicity, "_trained", lambda s, ids, y, part: (seen.append((int(y.sum()), max(len(w) for w, _ in ids))), trained(s, ids, y, part))[1])
    monkeypatch.setattr(toxicity, "TRAIN_WORDS", 20_000)
    monkeypatch.setattr(toxicity.learned, "__defaults__", (1000, 50))
    assert toxicity.fit(docs, labels) is not None
    assert seen[0] == (ids.count(), 1000)


def test_places_of_a_long_document():
    assert toxicity.learned(5, 5, 2) == slice(None)
    assert toxicity.learned(11, 4, 2).tolist() == [0, 1, 9, 10]


def test_gradient_of_the_network():
    """One step of training moves each parameter against the slope of the loss, as differences show it."""
    r = np.random.default_rng(2)
    docs = [(r.integers(0, 40, 12).astype(np.int32), r.integers(0, 20, 12).astype(np.int32)) for _ in range(6)]
    net = toxicity.Network(3)
    net.words[:40], net.stems[:20] = r.normal(size=(40, toxicity.DIMENSION)), r.normal(size=(20, toxicity.DIMENSION))

    def loss(net):
        total = 0.0
        for i, (w, s) in enumerate(docs):
            logit = float((toxicity.pooled(net.tables(), w, s, np.array([0, len(w)])) * net.last).sum()) + net.base
            total += np.log1p(np.exp(-logit)) if i % 2 else np.log1p(np.exp(logit))
        return total

    import copy

    logits = [float((toxicity.pooled(net.tables(), w, s, np.array([0, len(w)])) * net.last).sum()) + net.base for w, s in docs]
    for k in range(4):
        bumped = copy.deepcopy(net)
        bumped.last[k] += 1e-3
        slope = (loss(bumped) - loss(net)) / 1e-3
        want = sum((1 / (1 + np.exp(-z)) - i % 2) * toxicity.pooled(net.tables(), w, s, np.array([0, len(w)]))[0, k] for i, (z, (w, s)) in enumerate(zip(logits, docs, strict=True)))
        assert abs(slope - want) < 2e-2 * max(1, abs(want))
    y = np.arange(6) % 2
    after = toxicity.train(docs, np.arange(6) % 2.0, epochs=60)
    at = lambda n: np.mean([np.log1p(np.exp(-(2 * y[i] - 1) * toxicity._logits_of(n.tables(), [d])[0])) for i, d in enumerate(docs)])
    assert at(after) < 0.1 < at(toxicity.Network(3))


def test_wide_filters_tell_what_single_words_cannot():
    """Toxic where two words follow each other; both words occur in all documents."""
    r = np.random.default_rng(5)
    docs, y = [], []
    for i in range(400):
        words = r.integers(10, 200, 20).astype(np.int32)
        a = int(r.integers(0, 9))
        b = a + 1 if i % 2 else a + 10
        words[a], words[b] = 1, 2
        docs.append((words, words))
        y.append(i % 2)
    y = np.array(y, float)
    net = toxicity.train(docs[:300], y[:300], epochs=40)
    wide = toxicity._logits_of(net.tables(), docs[300:])
    alone = net.tables() | {"last": net.last * (np.arange(len(net.last)) < toxicity.FILTERS)}
    auc = lambda z: np.mean(z[y[300:] == 1][:, None] > z[y[300:] == 0][None])
    assert auc(wide) > 0.9 > 0.75 > auc(toxicity._logits_of(alone, docs[300:]))


def test_strongest_in_pieces(monkeypatch):
    r = np.random.default_rng(7)
    net = toxicity.Network(2)
    net.words[:], net.stems[:] = r.normal(size=net.words.shape), r.normal(size=net.stems.shape)
    for n in (0, 1, 2, 3, 57):
        w, s = r.integers(0, 90, n).astype(np.int32), r.integers(0, 90, n).astype(np.int32)
        where, value = toxicity.strongest(net, w, s)
        for chunk in (1, 2, 10):
            monkeypatch.setattr(toxicity, "CHUNK", chunk)
            again = toxicity.strongest(net, w, s)
            assert np.array_equal(where, again[0]) and np.allclose(value, again[1])
        monkeypatch.undo()
        pooled = toxicity.pooled(net.tables(), w, s, np.array([0, n]))[0]
        assert np.allclose(np.maximum(value + net.bias, 0), pooled, atol=1e-4)
