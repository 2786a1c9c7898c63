import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemosieve.llm import vector_codes as vc
from mnemosieve.llm import whitening as wh
from tests.conftest import DATA, agree

SCHEMA = "vec_id long, embedding array<float>, label int, n string"


def clustered(n, d, seed=3):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(9, d))
    return (middle[r.integers(0, 9, n)] + r.normal(size=(n, d)) * 0.2).astype(np.float32)


def kept(rows):
    return [r for r in rows if r[1] is not None and len(r[1]) and all(v is not None and np.isfinite(v) for v in r[1])]


def odd_rows(d):
    rows = [(i, v.tolist(), i % 3 or None, "clash") for i, v in enumerate(clustered(300, d))]
    rows += [(5, rows[7][1], 1, "x"), (5, rows[5][1], 2, "x"), (None, rows[8][1], None, None)] + [(1000 + i, rows[0][1], 1, "x") for i in range(200)]
    return rows + [(900, None, 1, "x"), (901, [None] * d, 1, "x"), (902, [float("nan")] + [0.0] * (d - 1), 1, "x"), (903, [float("inf")] * d, 2, "x"), (904, [], 2, "x")]


# whitening


def brute_whitening(x, components):
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    y = u - s / n
    e, v = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-e)[:components]
    return n, s, e[order], v[:, order], e.sum()


def test_whitening(spark):
    rows = odd_rows(6)
    out = wh.whitened(spark.createDataFrame(rows, SCHEMA), components=4)
    out = out.collect()
    good = kept(rows)
    x = np.floor(64 * np.array([r[1] for r in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s, e, v, trace = brute_whitening(x, 4)
    want = {}
    for r, w, dev in zip(good, (x - s / n) @ v / np.sqrt(e), ((n * x - s) ** 2).sum(1), strict=True):
        want.setdefault(r[0], []).append((int(dev), np.abs(w)))
    assert len(out) == len(good)
    for r in out:
        assert r["n"] == n and any(r["deviation"] == dev and np.allclose(np.abs(r["whitened"]), w, atol=1e-9) for dev, w in want[r["vec_id"]])
        assert np.allclose(r["explained"], e / trace, rtol=1e-9) and r["identity_error"] < 1e-9


def test_whitening_signs_are_one_for_all_rows(spark):
    x = clustered(200, 5)
    out = wh.whitened(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(7)).orderBy("vec_id").collect()
    w = np.array([r["whitened"] for r in out])
    assert np.abs(w.T @ w / len(w) - np.eye(5)).max() < 0.02  # all rows are distinct, so the fit list is the table


def test_whitening_of_little(spark):
    assert wh.whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    one = wh.whitened(spark.createDataFrame([(1, [0.5, 1.0], None, None), (2, [0.5, 1.0], None, None)], SCHEMA)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in one] == [(1, 0, [0.0, 0.0], 0.0)] * 2
    flat = wh.whitened(spark.createDataFrame([(i, [float(i), 2.0 * i], None, None) for i in range(9)], SCHEMA)).collect()  # one direction only
    assert all(abs(r["whitened"][1]) == 0 and r["identity_error"] < 1e-9 for r in flat)
    lengths = wh.whitened(spark.createDataFrame([(1, [1.0], 0, ""), (2, [2.0], 0, ""), (3, [1.0, 5.0], 0, ""), (4, [3.0, 1.0], 0, "")], SCHEMA)).collect()
    assert sorted((r["vec_id"], r["n"], len(r["whitened"])) for r in lengths) == [(1, 2, 1), (2, 2, 1), (3, 2, 2), (4, 2, 2)]
    huge = wh.whitened(spark.createDataFrame([(1, [3e38, 0.0], 0, ""), (2, [-3e38, 1.0], 0, "")], SCHEMA)).collect()
    assert [r["deviation"] for r in huge] == [(1 << 63) - 1] * 2


def test_whitening_query(spark):
    from mnemosieve.llm.common import read_table

    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, str(DATA), "embeddings").collect()]
    good = kept(rows)
    x = np.floor(64 * np.array([r[1] for r in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s, e, v, trace = brute_whitening(x, 16)
    want = {(r[0], k + 1): (abs(w[k]), int(dev), e[k] / trace) for r, w, dev in zip(good, (x - s / n) @ v / np.sqrt(e), ((n * x - s) ** 2).sum(1), strict=True) for k in range(16)}
    got = wh.op12(spark, str(DATA)).collect()
    assert len(got) == 16 * len(good)
    for r in got:
        w, dev, share = want[r["vec_id"], r["component"]]
        assert abs(abs(r["whitened"]) - w) < 1e-8 and r["deviation"] == dev and r["n"] == n and abs(r["explained"] / share - 1) < 1e-4 and r["identity_error"] < 1e-4


# codes


def brute_codes(rows, parts, entries, rounds):
    good = kept(rows)
    x = [[int(np.floor(256 * float(np.float32(v)))) for v in r[1]] for r in good]
    edges = np.cumsum([0, *(len(a) for a in np.array_split(np.arange(len(x[0])), parts))])
    first = {}
    for r, v in zip(good, x, strict=True):
        first[r[0]] = min(first.get(r[0], v), v)
    books = [[first[k][a:b] for k in sorted(first, key=lambda k: (k is None, k))[:entries]] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    square = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        codes = [[min(range(len(c)), key=lambda j, c=c, v=v, a=a, b=b: (square(v[a:b], c[j]), j)) for c, a, b in zip(books, edges[:-1], edges[1:], strict=True)] for v in x]
        if turn < rounds:
            for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                for j in range(len(books[p])):
                    own = [v[a:b] for v, c in zip(x, codes, strict=True) if c[p] == j]
                    if own:
                        books[p][j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    sha = hashlib.sha256(",".join(str(v) for c in books for e in c for v in e).encode()).hexdigest()
    error = [sum(square(v[a:b], books[p][c[p]]) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))) for v, c in zip(x, codes, strict=True)]
    return sorted(((-1 if r[0] is None else r[0]), bytes(c), e, sha) for r, c, e in zip(good, codes, error, strict=True))


@pytest.mark.parametrize(("d", "parts", "entries", "rounds"), [(8, 4, 16, 2), (7, 3, 40, 4), (2, 4, 8, 1), (8, 2, 2, 0)])
def test_codes(spark, d, parts, entries, rounds):
    rows = odd_rows(d)
    out = vc.compressed(spark.createDataFrame(rows, SCHEMA).repartition(5), parts=parts, entries=entries, rounds=rounds).collect()
    got = sorted(((-1 if r["vec_id"] is None else r["vec_id"]), bytes(r["code"]), r["error"], r["codebooks_sha256"]) for r in out)
    assert got == brute_codes(rows, parts, entries, rounds)


def test_codes_of_large_numbers(spark):
    rows = [(i, (np.array(v) * 1e12).tolist(), 0, "") for i, v in enumerate(clustered(60, 4))]
    out = vc.compressed(spark.createDataFrame(rows, SCHEMA), parts=2, entries=8).collect()
    want = brute_codes(rows, 2, 8, 2)
    assert sorted((r["vec_id"], bytes(r["code"]), r["error"], r["codebooks_sha256"]) for r in out) == [(a, b, min(e, vc.MOST), s) for a, b, e, s in want]


def test_ties_go_to_the_lower_entry(spark):
    rows = [(0, [0.0, 0.0], 0, ""), (1, [1.0, 1.0], 0, ""), (2, [0.0, 0.0], 0, "")] + [(3 + i, [0.5, 0.5], 0, "") for i in range(4)]
    out = vc.compressed(spark.createDataFrame(rows, SCHEMA), parts=1, entries=3, rounds=0).collect()
    assert {r["vec_id"]: bytes(r["code"])[0] for r in out} == {0: 0, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0}


def test_bounds_hold_and_spare_work():
    x = np.floor(256 * clustered(500, 16).astype(float)).astype(np.int64)
    books = vc.first_books(x[:64], 4)
    state = vc.assign_all(books, x)
    for _ in range(4):
        sums = [np.array([x[state.assigned[:, p] == j][:, a:b].sum(0) for j in range(64)], object) for p, (a, b) in enumerate(books.cuts)]
        books = books.after(sums, np.array([np.bincount(state.assigned[:, p], minlength=64) for p in range(4)]))
        state = vc.assign_again(books, x, state)
        full = vc.assign_all(books, x)
        assert (state.assigned == full.assigned).all()
        assert state.seen < full.seen / 4
        for p, (a, b) in enumerate(books.cuts):
            d = np.sqrt(((x[:, None, a:b] - books.entries[p]) ** 2).sum(2))
            assert (state.lower[:, p] * books.steps[p] <= d + 1e-9).all()
            assert (state.upper[:, p] >= d[np.arange(500), state.assigned[:, p]] - 1e-9).all()


def test_label_errors(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 1, 7), (3, None, 9), (4, 1, vc.MOST)], "vec_id long, label int, error long")
    assert sorted((r["vec_id"], r["label_error"]) for r in vc.with_label_error(df).collect()) == [(1, 14), (2, vc.MOST), (3, 14), (4, vc.MOST)]


def test_codes_of_nothing(spark):
    assert vc.compressed(spark.createDataFrame([], SCHEMA)).count() == 0
    mixed = vc.compressed(spark.createDataFrame([(1, [1.0], 0, ""), (2, [2.0, 3.0], 0, "")], SCHEMA)).collect()
    assert {r["vec_id"]: r["error"] for r in mixed} == {1: 0, 2: 0}


def test_codes_query(spark, duck):
    agree(spark, duck, vc.op13, vc.ORACLE_SQL)


def test_codebook_table(spark):
    books = vc.first_books(np.arange(12).reshape(3, 4), 2)
    rows = books.table(spark).where("part = 1").orderBy("entry").select("entry", "components").collect()
    assert [tuple(r) for r in rows] == [(0, [2, 3]), (1, [6, 7]), (2, [10, 11])]
    assert books.table(spark).agg(F.count(F.lit(1))).first()[0] == 6
