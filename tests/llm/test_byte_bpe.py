import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from mnemosieve.llm import byte_bpe as bb
from tests.conftest import DATA


@pytest.fixture(scope="module")
def engine():
    with open(bb.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoders():
    return [bb.Encoder(bb.vocabulary(bb.default_ranks()), w) for w in (bb.WINDOW, 16)]


def ids_of(encoder, texts):
    ids, first = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


PIECES = [" ", "  ", "\n", "\t", " ", "'", "'s", "'re", "'ll", "'ve", "'d", "'S", "a", "B", "re", "l", "1", "²", "é", "é", "漢", "Ж", "!", "_", "\U0001f600", "\x1c", "₏", "\U0003fb27", "\x00"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=3)), max_size=30).map("".join), max_size=5))
def test_as_the_library(engine, encoders, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    for encoder in encoders:
        assert ids_of(encoder, texts) == [engine.encode_ordinary(t) for t in texts]


def test_every_code_point(engine, encoders):
    """Each code point between signs that show its class."""
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}a1{c}1!{c}! {c}" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    assert ids_of(encoders[0], texts) == [engine.encode_ordinary(t) for t in texts]


def test_long_pretokens(engine, encoders):
    for text in ("ab" * 40_000, " " * 30_000 + "x", "\n" * 999, "a" + " " * 17 + "b", "'" * 40 + "s", "x" * 15 + "'ll" + "y" * 20):
        for encoder in encoders:
            assert ids_of(encoder, [text, "", text]) == [engine.encode_ordinary(t) for t in (text, "", text)]


def test_perfect_hash_is_minimal_and_finds_whole_entries_only():
    v = bb.vocabulary(bb.default_ranks())
    start, end = v.at[:-1], v.at[1:]
    assert (v.ranks_of(v.raw, start, end, bb.hashes(v.raw, start, end)) == np.arange(len(start))).all()
    assert sorted(v.slot) == list(range(len(start)))
    other = np.frombuffer(b"zqxjzqxj" * 50, np.uint8)
    at = np.arange(0, len(other), 8)
    assert (v.ranks_of(other, at, at + 8, bb.hashes(other, at, at + 8)) == -1).all()


def test_defined_results(spark, engine):
    rows = [(1, None, "x", 5), (1, "", "x", 6), (2, "Don't  stop\n", "y", 7), (2, "Don't  stop\n", "y", 7), (None, "漢字 123", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids_packed string, decoded int")
    out = bb.encoded(df).collect()
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in out) == sorted((d or 0, engine.encode_ordinary(t or "")) for d, t, *_ in rows)
    back = bb.decoded(bb.encoded(df).drop("ids_packed"))
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"])) for r in back.collect()) == sorted((d or 0, (t or "").encode()) for d, t, *_ in rows)
    assert bb.encoded(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="outside the vocabulary"):
        bb.decoded(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>")).collect()
    assert bb.decoded(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).orderBy("doc_id").collect()[0]["decoded"] is None


def test_query_against_the_library(spark, engine):
    from mnemosieve.llm.common import read_table

    want = []
    for r in read_table(spark, str(DATA), "documents").select("doc_id", "text").collect():
        ids = engine.encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(map(tuple, bb.op11(spark, str(DATA)).collect())) == sorted(want)
