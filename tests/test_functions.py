import hashlib

import pytest
from pyspark.sql import functions as F

from mnemosieve.functions import requests as rq
from mnemosieve.functions import text as tx
from mnemosieve.functions import vectors as vx
from mnemosieve.functions.wordpiece import WordPiece, encode
from mnemosieve.operators.identity import compared, dir_fingerprint

VOCAB = {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3, "hello": 4, "world": 5, "##s": 6, "a": 7, "b": 8, "c": 9, "中": 10, "文": 11}


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(f"{n} {'string' if not isinstance(v, (list, float, int)) or v is None else 'array<float>' if isinstance(v, list) else 'double'}" for n, v in values.items())
    return spark.createDataFrame([tuple(values[n] for n in names)], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [
    ("读层打分", "读层/b 层打/b 打分/b"), ("单", "单/u"), ("Hello-World a b2", "hello/a world/a b2/a"), ("𠀀𠀁x 单", "𠀀𠀁/b 单/u"), ("été", ""), ("", ""), (None, ""),
])
def test_tokens(spark, text, want):
    found = one(spark, tx.tokens(F.col("t")), t=text)
    assert " ".join(f"{x['token']}/{x['kind']}" for x in found) == want


def test_unigrams_and_distinct(spark):
    assert [x["token"] for x in one(spark, tx.tokens(F.col("t"), unigrams=True), t="读层打")] == ["读", "层", "打", "读层", "层打"]
    assert [x["token"] for x in one(spark, tx.distinct_tokens(F.col("t")), t="bb aa bb cc aa")] == ["bb", "aa", "cc"]


def test_digests(spark):
    assert one(spark, tx.content_sha(F.col("a"), F.col("b")), a="t", b="c") == hashlib.sha256(b"t\0c").hexdigest()
    assert one(spark, tx.content_sha(F.col("a"), F.col("b")), a=None, b=None) == hashlib.sha256(b"\0").hexdigest()


def test_excerpt(spark):
    assert one(spark, tx.excerpt(F.col("t")), t=" a 　b\x1c\n c ") == "a b c"
    assert one(spark, tx.excerpt(F.col("t")), t="𠀀" * 201) == "𠀀" * 200 + "…"
    assert one(spark, tx.excerpt(F.col("t")), t="x" * 200) == "x" * 200


def test_envelopes(spark):
    assert tuple(one(spark, tx.parse_envelope(F.col("t")), t='{"project":"","result":"r"}')) == (None, None, "r")
    assert tuple(one(spark, tx.parse_envelope(F.col("t")), t="plain")) == (None, None, "plain")
    assert one(spark, tx.capture_counts(F.col("t"))["saved"], t="extracted=3 saved=2 duplicates=1") == 2
    assert one(spark, tx.capture_counts(F.col("t"))["saved"], t="none") is None


def test_budget(spark):
    assert one(spark, tx.truncate_to_budget(F.col("t"), 2), t="123456789") == "12345678\n…(truncated to 2 tokens)"
    assert one(spark, tx.truncate_to_budget(F.col("t"), 2), t="12345678") == "12345678"


@pytest.mark.parametrize(("asked", "want"), [(None, 10), (float("nan"), 10), (float("inf"), 10), (0.0, 1), (7.9, 7), (500.0, 100), (-3.0, 1)])
def test_limits(spark, asked, want):
    assert rq.limit_of(asked) == want
    got = spark.createDataFrame([(asked,)], "v double").select(rq.clamp_limit(F.col("v"))).first()[0]
    assert got == want


def test_capacity():
    assert rq.embed_capacity(60_000, 1) == 46
    assert rq.embed_capacity(585_000, 16) == 7200
    assert rq.embed_capacity(60_000, 99) == rq.embed_capacity(60_000, 16)
    assert rq.refusal(None, 4).kind == "unknown-backlog"
    assert rq.refusal(100, 4).kind == "catch-up" and rq.refusal(8000, 4).kind == "operator-only"


def test_vectors(spark):
    import numpy as np

    r = np.random.default_rng(1)
    for _ in range(5):
        a, b = r.normal(size=64).astype("f4"), r.normal(size=64).astype("f4")
        s = np.float32(0)
        for x, y in zip(a, b, strict=True):
            s = np.float32(s + np.float32(x * y))
        assert one(spark, vx.dot_f32(F.col("a"), F.col("b")), a=a.tolist(), b=b.tolist()) == float(s)
    digest = hashlib.sha256(b"hi").digest()
    want = [(digest[i % 32] - 127.5) / 128 for i in range(40)]
    assert one(spark, vx.hash_embedding(F.col("t"), 40, normalize=False), t="hi") == want
    assert abs(sum(x * x for x in one(spark, vx.hash_embedding(F.col("t")), t="hi")) - 1) < 1e-6
    assert vx.decode_f32(vx.encode_f32([1.0, -2.5])) == [1.0, -2.5]


@pytest.mark.parametrize(("text", "most", "want"), [
    ("hello", 512, [2, 4, 3]), ("hello world", 512, [2, 4, 5, 3]), ("hellos", 512, [2, 4, 6, 3]), ("zzz", 512, [2, 1, 3]), ("hello hello hello", 4, [2, 4, 4, 3]),
    ("中文", 512, [2, 10, 11, 3]), ("a\x00​b", 512, [2, 1, 3]), ("a\tb", 512, [2, 7, 8, 3]), ("a.b", 512, [2, 7, 1, 8, 3]), ("c" * 101, 512, [2, 1, 3]),
])
def test_wordpiece(spark, text, most, want):
    assert WordPiece(VOCAB).encode(text, most) == want
    assert one(spark, encode(F.col("t"), WordPiece(VOCAB), most), t=text) == want


def test_save_rules(spark):
    def run(**f):
        values = {c: f.get(c) for c in ("title", "content", "observation", "kind", "scope", "topic")}
        return one(spark, rq.normalized_save(*[F.col(c) for c in values]), **values)

    assert run(title="t", content=" x ")["content"] == " x "
    assert run(title="t", content=" ", observation="o")["content"] == "o"
    assert run(title="t", content=" ", observation=" ")["error"] == "content is blank"
    assert run(title=" ", content="x")["error"] == "title is blank"
    assert run(title="t", content="x")["type"] == "manual"


def test_identity(spark):
    files = spark.createDataFrame([("g", "b", 1, "s1"), ("g", "a", 2, "s2")], "`group` string, rel_path string, bytes long, sha256 string")
    assert dir_fingerprint(files).first()["fingerprint"] == hashlib.sha256(b"a\ns2\nb\ns1\n").hexdigest()
    have = spark.createDataFrame([("a", 2, "s2"), ("c", 1, "x"), ("b", 1, "other")], "rel_path string, bytes long, sha256 string")
    assert {r[0]: r[1] for r in compared(files.drop("group"), have).collect()} == {"a": "ok", "b": "mismatch", "c": "extra"}


def test_capacity_of_columns_is_that_of_numbers(spark):
    from mnemosieve.functions import requests as rq

    rows = [(b, t, n) for b in (0, 1, 1300, 58_500, 585_000) for t in (-1, 0, 1, 5, 16, 40) for n in (0, 1, 7, 1000)]
    df = spark.createDataFrame(rows, "b long, t long, n long")
    for r in df.select("*", rq.embed_capacity_of(F.col("b"), F.col("t")).alias("c"), rq.estimate_seconds_of(F.col("n"), F.col("t")).alias("s")).collect():
        assert (r["c"], r["s"]) == (rq.embed_capacity(r["b"], r["t"]), rq.estimate_seconds(r["n"], r["t"]))


def test_text_is_digested_once(spark):
    """A text that differs each time it is computed: components that come of one digest repeat after 32."""
    v = spark.range(3).select(vx.hash_embedding(F.expr("uuid()"), 64).alias("v")).collect()
    assert all(r["v"][:32] == r["v"][32:] for r in v)


def test_a_source_is_digested_in_parts_outside_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from mnemosieve.sources.observations import source_hash

    rows = [(i, f"u{i}", "".join(chr(65 + (i * k) % 26) for k in range(i % 90)) + "读é" * (i % 3)) for i in range(500)]
    want = hashlib.sha256("".join(f"{i}\x1f{u}\x1f{len(c)}\x1f{c}\x1e" for i, u, c in rows).encode()).hexdigest()
    snapshot = spark.createDataFrame(rows[::-1], "id long, updated_at string, content string").repartition(5)
    monkeypatch.setattr(DataFrame, "toLocalIterator", lambda *_: pytest.fail("rows pass the driver"))
    assert source_hash(snapshot) == source_hash(snapshot, 3000) == want
    assert source_hash(snapshot.limit(0)) == hashlib.sha256().hexdigest()
