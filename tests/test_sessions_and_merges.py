"""Prefixes by ranges, metering, sessions, merges, digest trees and word pieces, against plain versions of each."""

import hashlib
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from mnemosieve import streaming
from mnemosieve.functions.text import truncate_to_budget
from mnemosieve.functions.wordpiece import CHINESE, WordPiece, encode
from mnemosieve.operators import events as en
from mnemosieve.operators import instruments as im
from mnemosieve.operators import merging as mg
from mnemosieve.operators.identity import identity_tree
from mnemosieve.operators.ordering import placed
from mnemosieve.sources.observations import tree_digest
from tests.conftest import DATA

RNG = random.Random(5)


def test_places_across_ranges(spark):
    rows = [("hot" if i % 3 else None if i % 5 else "cold", i % 97, i, float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, at long, id long, v double").repartition(7)
    got = {r["id"]: (r["place"], r["running_v"]) for r in placed(df, ["k"], ["at", "id"], ("v",)).collect()}
    seen = {}
    for k, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        n, total = seen.get(k, (0, 0.0))
        seen[k] = (n + 1, total + v)
        assert got[i] == seen[k]
    assert placed(df.limit(0), ["k"], ["at", "id"]).count() == 0


@pytest.mark.parametrize(("every", "most"), [(20, 60_000), (3, 1e9), (1000, 5_000)])
def test_flushes(spark, every, most):
    rows = [("hot" if i % 3 else "cold", i, 1000 + i // 4, RNG.choice([0.0, 10.0, 7_000.0, 70_000.0])) for i in range(400)] + [("none", 1, 1, None)]
    calls = spark.createDataFrame(rows, "tool string, call_id long, at long, ms double")
    want, state = [], {}
    for tool, i, at, ms in sorted(rows, key=lambda r: (r[2], r[1])):
        n, total, since = state.get(tool, (0, 0.0, 0.0))
        n, total, since = n + 1, total + (ms or 0), since + (ms or 0)
        if n % every == 0 or since >= most:
            want.append((tool, n, total / n, since, at))
            since = 0.0
        state[tool] = (n, total, since)
    assert sorted(map(tuple, im.flushes(calls, ["tool"], every, most).collect())) == sorted(want)


def brute_lives(rows, now, most):
    out = []
    for w in {r[0] for r in rows}:
        lives = []
        for _, _, s, f in sorted((r for r in rows if r[0] == w), key=lambda r: (r[2], r[1])):
            f = float("inf") if f is None else max(f, s)
            if lives and (most == 0 or s < lives[-1][1] + most):
                lives[-1] = (lives[-1][0], max(lives[-1][1], f), lives[-1][2] + 1)
            else:
                lives.append((s, f, 1))
        out += [(w, s, None if f == float("inf") else f, n, f + most if most and f + most <= now else None) for s, f, n in lives]
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [0, 50, 1000])
def test_idle_connections(spark, most):
    rows = [(RNG.choice(["w", "w", "x"]), i, s := RNG.randrange(5000), s + RNG.choice([0, 10, 400])) for i in range(200)] + [("open", 0, 10, None), ("open", 1, 3000, 3001), ("edge", 0, 0, 10), ("edge", 1, 60, 70)]
    df = spark.createDataFrame(rows, "workspace string, call_id long, started_at long, finished_at long")
    assert sorted(map(tuple, en.idle_reclaims(df, 4000, most).collect()), key=str) == brute_lives(rows, 4000, most)
    assert en.idle_reclaims(df.limit(0), 4000, most).count() == 0


EVENTS = "session_id string, seq long, at timestamp, kind string, ids array<long>, verb string"


def test_reports_dont_depend_on_batches(spark, tmp_path):
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000) + s)
    rows = [("a", 0, 0, "read", [1], None), ("a", 1, 10, "verdict", [1], "related"), ("a", 2, 20, "verdict", [2], "related"), ("a", 3, 30, "verdict", None, "supersedes"), ("a", 4, 2000, "verdict", [1], "related"), ("a", 5, 2010, "end", None, None),
            ("b", 0, 5, "saved", [7], None), ("b", 1, 6, "verdict", [7], "related"), ("c", 0, 20_000, "read", [1], None), ("a", 6, 20_001, "verdict", [], "related")]
    df = spark.createDataFrame(rows, EVENTS.replace("timestamp", "long")).withColumn("at", at(F.col("at")))
    got = []
    for name, cuts in (("one", [11]), ("many", [3, 5, 8, 11])):
        begin = 0
        for i, end in enumerate(cuts):
            spark.createDataFrame(df.orderBy("at").collect()[begin:end], EVENTS).write.parquet(f"{tmp_path}/{name}/in/{i}")
            begin = end
            stream = spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{name}/in")
            out = streaming.run_once(streaming.session_reports(stream, 1_000_000, "100 seconds"), f"{tmp_path}/{name}/out", f"{tmp_path}/{name}/log")
        got.append(sorted((r["session_id"], r["opened_at"] // 1000 - 1_700_000_000, r["last_at"] // 1000 - 1_700_000_000, r["read_first"], r["blind"], r["unknown"], r["verdicts"], r["reason"]) for r in out.collect()))
    assert got[0] == got[1] == [("a", 0, 30, 1, 1, 1, {"related": 2, "supersedes": 1}, "idle"), ("a", 2000, 2010, 0, 1, 0, {"related": 1}, "end"), ("b", 5, 6, 1, 0, 0, {"related": 1}, "idle")]


def test_idle_sessions_of_a_stream(spark, tmp_path):
    rows = [("w", 0), ("w", 50), ("w", 400), ("x", 10), ("x", 100_000)]
    df = spark.createDataFrame(rows, "workspace string, s long").select("workspace", F.timestamp_seconds("s").alias("at"))
    df.write.parquet(f"{tmp_path}/in")
    stream = streaming.idle_sessions(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "100 seconds")
    out = streaming.run_once(stream, f"{tmp_path}/out", f"{tmp_path}/log").select("workspace", F.unix_seconds("opened_at"), F.unix_seconds("reclaimed_at"), "calls")
    assert sorted(map(tuple, out.collect())) == [("w", 0, 150, 2), ("w", 400, 500, 1), ("x", 10, 110, 1)]


def test_repeats(spark):
    rows = [(i, RNG.randrange(20_000), RNG.choice(["a", None, "a"]), RNG.choice(["x", "y"])) for i in range(600)] + [(1000, 0, "edge", "z"), (1001, 900, "edge", "z"), (1002, 901, "edge", "z"), (1003, 901, "edge", "z"), (1004, 1801, "edge", "z"), (1005, 1802, "edge", "z")]
    df = spark.createDataFrame(rows, "id long, s long, project string, title string").withColumn("at", F.timestamp_seconds("s")).repartition(5)
    kept, want = {}, []
    for i, s, p, t in sorted(rows, key=lambda r: (r[1], r[0])):
        if (p, t) not in kept or s - kept[p, t][0] > 900:
            kept[p, t] = (s, i)
        want.append((i, kept[p, t][1], kept[p, t][1] == i))
    assert sorted(map(tuple, mg.repeats(df, ["project", "title"]).collect())) == sorted(want)
    assert mg.repeats(df.limit(0), ["project", "title"]).count() == 0
    text = spark.createDataFrame([(" A  b\n",), ("a B",), (None,)], "t string").select(mg.normalized_hash(F.col("t")).alias("h")).collect()
    assert text[0] == text[1] and text[2]["h"] == hashlib.sha256(b"").hexdigest()


def test_topics_and_relations(spark):
    schema = "id long, project string, scope string, topic_key string, title string, content string, seq long"
    first = spark.createDataFrame([(1, "p", "s", "t", "one", "", 1), (2, "p", "s", "t", "two", None, 2), (3, "p", "s", "", "alone", "", 3), (4, None, "s", None, "alone too", "", 4)], schema)
    later = spark.createDataFrame([(9, "p", "s", "t", "late", "", 0), (5, "q", "s", "t", "other", "", 5), (3, "p", "s", "", "again", "", 6)], schema)
    state = mg.upserted_topics(mg.upserted_topics(None, first), later)
    got = {(r["project"], r["topic_key"]): (r["id"], r["title"], r["revision_count"]) for r in state.collect()}
    assert got == {("p", "topic:t"): (2, "two", 3), ("q", "topic:t"): (5, "other", 1), ("p", "id:3"): (3, "again", 2), ("", "id:4"): (4, "alone too", 1)}
    verdict = "source_id long, target_id long, verb string, seq long"
    state = mg.upserted_relations(None, spark.createDataFrame([(1, 2, "related", 1), (2, 1, "supersedes", 2), (3, 3, "related", 3), (4, 5, "related", 4)], verdict))
    state = mg.upserted_relations(state, spark.createDataFrame([(5, 4, "not_conflict", 5), (1, 2, "late", 0)], verdict))
    assert {tuple(r) for r in state.collect()} == {(1, 2, "supersedes", 2, 3), (4, 5, "not_conflict", 5, 2)}
    assert [r["low"] for r in mg.standing_relations(state).collect()] == [1]


def test_digest_trees(spark):
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for n in (0, 1, 7, 30):
        df = spark.createDataFrame([(i, f"leaf {i}") for i in range(n)], "id long, t string")
        nodes = [digest(f"leaf {i}") for i in range(n)]
        for _ in range(4):
            nodes = [digest("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        want = nodes[0] if nodes else digest("")
        assert tree_digest(df.repartition(5), ["id"], F.col("t"), 3) == tree_digest(df.coalesce(1), ["id"], F.col("t"), 3) == want
    with pytest.raises(ValueError, match="levels"):
        tree_digest(df, ["id"], F.col("t"), 2, 4)
    files = spark.createDataFrame([("b", 1, "x"), ("a", 2, "y")], "rel_path string, bytes long, sha256 string")
    assert identity_tree(files) == identity_tree(files.orderBy("rel_path")) != identity_tree(files.withColumn("bytes", F.lit(3)))


def plain_pieces(model, text, most):
    """Character by character, as the published algorithm goes."""
    clean = ""
    for c in text:
        kind = unicodedata.category(c)
        if c in "\t\n\r" or kind in ("Zs", "Zl", "Zp"):
            clean += " "
        elif c not in "\0�" and kind not in ("Cc", "Cf", "Co", "Cs"):
            clean += f" {c} " if any(a <= ord(c) <= b for a, b in CHINESE) else c
    words, word = [], ""
    for c in (clean.lower() if model.lower else clean) + " ":
        apart = unicodedata.category(c)[0] == "P" or (ord(c) < 128 and not c.isalnum() and c != " ")
        if c == " " or apart:
            words += [word] if word else []
            words += [c] if apart else []
            word = ""
        else:
            word += c
    ids = [model.vocab["[CLS]"]]
    for w in words:
        found, at = [], 0
        while at < len(w) <= 100:
            ends = [e for e in range(len(w), at, -1) if ("##" if at else "") + w[at:e] in model.vocab]
            if not ends:
                break
            found, at = [*found, model.vocab[("##" if at else "") + w[at : ends[0]]]], ends[0]
        ids += found if at == len(w) else [model.vocab["[UNK]"]]
    return [*ids[: most - 1], model.vocab["[SEP]"]]


def test_word_pieces_against_the_plain_algorithm(spark):
    docs = [r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()]
    words = sorted({w for t in docs[:60] for w in t.lower().split()})
    pieces = dict.fromkeys(["[UNK]", "[CLS]", "[SEP]", *(p for w in words for p in (w[:3], "##" + w[-2:], "##" + w[3:5]) if p), *"abcdefghijklmnopqrstuvwxyz.,!", *(f"##{c}" for c in "abcdefghijklmnopqrst")])
    odd = ["a b c d　e", "a\x00b\x0bc\x7fd​e", "a.b,c!d_e", "中文ab中", "x" * 100 + " " + "a" * 101, "￿\U0001f600", "", "ÀÉİ tab\tnew\nline\rend"]
    for lower in (True, False):
        model = WordPiece({p: i for i, p in enumerate(pieces)}, lower)
        texts = docs + odd
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "i long, t string")
        for most in (512, 16):
            got = {r["i"]: r["ids"] for r in df.select("i", encode(F.col("t"), model, most).alias("ids")).collect()}
            assert all(got[i] == plain_pieces(model, t, most) for i, t in enumerate([*texts, ""]))
    assert WordPiece({"[UNK]": 0, "[CLS]": 1, "[SEP]": 2, "a": 3, "b": 4}).encode("a b a") == [1, 3, 4, 3, 2]
    with pytest.raises(ValueError, match="lacks"):
        WordPiece({"a": 1})


def test_the_query_of_word_pieces(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from mnemosieve import catalog
    from mnemosieve.functions.wordpiece import from_word_ends

    model = from_word_ends(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        ids = plain_pieces(model, r["text"] or "", 512)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_ids"], r["ids_sha256"]) for r in catalog.queries()["x23_word_pieces"](spark, str(DATA)).collect()}
    assert got == want and any(n > 100 for n, _ in got.values())


def test_a_model_tells_its_names():
    told = '{"model": {"vocab": {"<u>": 0, "<s>": 1, "</s>": 2, "a": 3, "@@b": 4}, "continuing_subword_prefix": "@@", "max_input_chars_per_word": 3, "unk_token": "<u>"}, "post_processor": {"special_tokens": {"[CLS]": {"id": "<s>"}, "[SEP]": {"id": "</s>"}}}}'
    model = WordPiece.from_json(told)
    assert model.encode("ab abbb") == [1, 3, 4, 0, 2]


def test_a_budget_counts_utf16_units(spark):
    rows = [("a" * 8,), ("a" * 9,), ("\U0001f600" * 4,), ("\U0001f600" * 5,), ("a" + "\U0001f600" * 4,), ("",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(truncate_to_budget(F.col("t"), 2)).collect()]
    note = "\n…(truncated to 2 tokens)"
    assert got == ["a" * 8, "a" * 8 + note, "\U0001f600" * 4, "\U0001f600" * 4 + note, "a" + "\U0001f600" * 3 + note, "", None]
