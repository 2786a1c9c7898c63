import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from mnemosieve.llm import ngram_join as nj
from mnemosieve.llm.common import LOWER, UPPER

WORD, FOLD = re.compile("[^\x20\x09-\x0D]+"), str.maketrans(UPPER, LOWER)


def shingles(text, n=4):
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n=4, percent=85):
    """Size and component of each row, by counting all shared shingles."""
    sets, parent = [shingles(t, n) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in where[g]:
                shared[j] += 1
            where[g].append(i)
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def copies(seed=2, n=250):
    r = random.Random(seed)
    base = [str(r.randint(0, 500)) for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            w[r.randrange(len(w))] = f"x{r.randint(0, 3000)}"
        rows.append((i + 5, "  ".join(w)))
    for i in range(60):  # half of the text is a passage that all share
        rows.append((i + 1000, " ".join(base[:60] + [f"y{i}_{k}" for k in range(r.choice([2, 4, 8, 12, 20, 60]))])))
    rows += [(2000, None), (2001, ""), (2002, "A b"), (2003, "a  B"), (2004, "a b c d"), (2005, " \t "), (2006, "a b c"), (2007, "Ä b"), (2008, "ä b"), (5, rows[0][1]), (3000, "long " + "w " * 50_000), (3001, "w " * 50_000)]
    return rows


@pytest.mark.parametrize("region", [2_000_000, 20_000, 2_000])
def test_components(spark, region):
    rows = copies()
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, node string")
    assert sorted(map(tuple, nj.linked(df, region=region).collect())) == brute(rows)


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (2, 50), (1, 95)])
def test_other_measures(spark, words, percent):
    rows = copies(7, 80)
    assert sorted(map(tuple, nj.linked(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect())) == brute(rows, words, percent)


def test_documents(spark):
    from tests.conftest import DATA

    df = spark.read.parquet(f"{DATA}/documents.parquet")
    assert sorted(map(tuple, nj.linked(df).collect())) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_nothing_to_join(spark):
    schema = "doc_id long, text string"
    assert nj.linked(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in nj.linked(spark.createDataFrame([(1, None)], schema)).collect()] == [(1, 0, 1)]
    same_id = [(1, "a b c d e f"), (1, "completely other words stand here"), (2, "a b c d e f")]
    assert sorted(map(tuple, nj.linked(spark.createDataFrame(same_id, schema)).collect())) == [(1, 2, 1), (1, 3, 1), (2, 3, 1)]
    nulls = nj.linked(spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (None, "nobody else has this text")], schema)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in nulls) == [(0, 0), (0, 3), (3, 3)]


def test_representatives(spark):
    docs = spark.createDataFrame([(i, t, "l", "s", 1) for i, t in copies()], "doc_id long, text string, lang string, node string, n long")
    out = nj.representatives(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({c for _, _, c in brute(copies())})


def test_null_and_repeated_doc_ids(spark):
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    changed = lambda w, k: " ".join([*w[:-k], *(f"x{i}" for i in range(k))])
    rows = [
        (7, " ".join(a)), (7, " ".join(b)), (3, changed(a, 2)), (9, changed(b, 2)), (None, "a text that nobody else has at all"), (None, "and one more of them without a number"),
        (None, ""), (20, ""), (20, " "), (5, "one text under a number"), (5, "another text under that very number"), (5, "one text under a number"),
        (30, " ".join(f"c{i}" for i in range(80))), (None, changed([f"c{i}" for i in range(80)], 4)), (31, changed([*"defg", *(f"c{i}" for i in range(4, 80))], 4)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"]) for r in nj.linked(docs).collect())
    assert got == Counter([(7, 3), (7, 7), (3, 3), (9, 7), (None, None), (None, None), (None, None), (20, 20), (20, 20), (5, 5), (5, 5), (5, 5), (30, 30), (None, 30), (31, 30)])
    kept = Counter(tuple(r) for r in nj.representatives(docs).collect())
    assert kept == Counter([rows[2], rows[1], *rows[4:11], rows[12]])


def test_region_join_against_all_pairs():
    r = np.random.default_rng(3)
    sets = []
    for _ in range(15):
        base = r.integers(0, 1 << 60, 80).astype(np.uint64)
        for _ in range(int(r.integers(1, 25))):
            keep = base[r.random(80) > r.choice([0.0, 0.03, 0.08, 0.2])]
            sets.append(np.unique(np.concatenate([keep, r.integers(0, 1 << 60, int(r.integers(0, 8))).astype(np.uint64)])))
    ids = r.permutation(len(sets))
    label = {int(i): int(i) for i in ids}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            k = len(np.intersect1d(sets[a], sets[b]))
            if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
                x, y = find(int(ids[a])), find(int(ids[b]))
                label[max(x, y)] = min(x, y)
    want = {i: find(i) for i in label if find(i) != i}
    assert dict(nj.join_sets(ids, sets)) == want


def test_cells_on_documents(spark):
    """Voronoi cells part the sets of all documents, and the join is that of all pairs."""
    from tests.conftest import DATA

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = nj.Shingler().sets(pa.array([t or "" for _, t in rows]), 4)
    some = {int(n): (i, x) for (i, _), n, x in zip(rows, nj.nodes_of(found), found, strict=True) if len(x)}
    region = nj.Region([x for _, x in some.values()], 85)
    region.solve(np.arange(len(some)))
    assert region.cells > 0
    ids = np.array([i for i, _ in some.values()])
    least = {label: ids[region.label == label].min() for label in set(region.label.tolist())}
    want = {d: c for d, _, c in brute(rows)}
    own = {i: least[k] for i, k in zip(ids.tolist(), region.label.tolist(), strict=True)}
    same = [(a, b) for a in own for b in own if (own[a] == own[b]) != (want[a] == want[b])]
    assert not same


def test_cells_are_not_needed_for_the_result(monkeypatch):
    r = np.random.default_rng(8)
    base = r.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[r.random(60) > 0.05 * (i % 4)], r.integers(0, 1 << 60, i % 9).astype(np.uint64)])) for i in range(300)]
    ids = np.arange(300)
    by_cells = dict(nj.join_sets(ids, sets))
    monkeypatch.setattr(nj, "FEW", 1000)  # all pairs
    assert by_cells == dict(nj.join_sets(ids, sets)) and by_cells


@pytest.mark.parametrize("kind", ["star", "path", "both"])
def test_components_without_a_task_for_each(spark, monkeypatch, kind):
    from mnemosieve.llm import common

    monkeypatch.setattr(common, "hot_limit", lambda rows, groups=2000: 20)
    star = [(i, 0) for i in range(1, 400)] if kind != "path" else []
    path = [(i + 1, i) for i in range(1000, 1060)] if kind != "star" else []
    got = {r["id"]: r["component"] for r in nj.components(spark.createDataFrame(star + path, "a long, b long")).collect()}
    assert got == {i: 0 for e in star for i in e} | {i: 1000 for e in path for i in e}


def test_groups_in_shares(spark):
    from mnemosieve.llm.common import attach_groups

    rows = spark.createDataFrame([(k, i) for k in range(5) for i in range(3 + 300 * k)], "k int, i int")
    groups = rows.groupBy("k").count()
    for together in (7, 400, 1_000_000):
        out = attach_groups(rows, groups, ["k"], "count", together)
        assert out.columns == ["k", "i", "count"] and sorted(map(tuple, out.collect())) == sorted((k, i, 3 + 300 * k) for k in range(5) for i in range(3 + 300 * k))


def test_key_filter(spark):
    r = np.random.default_rng(0)
    keys = r.integers(-(1 << 62), 1 << 62, 5000)
    held = nj.KeyFilter(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key", len(keys))
    assert held.may_hold(keys).all() and held.may_hold(r.integers(-(1 << 62), 1 << 62, 20_000)).mean() < 0.05


def test_packing_of_fingerprints():
    r = np.random.default_rng(1)
    for size in (1, 2, 3):
        values = np.sort(r.integers(0, 1 << 30, 500).astype(np.uint64)) if size > 1 else np.sort(r.integers(0, 5000, 500).astype(np.uint64))
        assert np.array_equal(nj.unpacked(nj.packed(values, size), size), values)
    edge = np.array([0, 255, 256, 511, 511, 1022], np.uint64)
    assert np.array_equal(nj.unpacked(nj.packed(edge, 1), 1), edge)


def test_shingles_follow_words():
    s = nj.Shingler()
    texts = ["A b\tc  D e", "a B c d E", "a b", "a  b ", "ab", "", "a b c d", "x a b c d e", "é b c d"]
    sets = s.sets(pa.array(texts), 4)
    assert [len(x) for x in sets] == [len(shingles(t)) for t in texts]
    assert np.array_equal(sets[0], sets[1]) and np.array_equal(sets[2], sets[3]) and not np.array_equal(sets[2], sets[4])
    assert np.isin(sets[0], sets[7]).all() and np.isin(sets[6], sets[0]).all()
