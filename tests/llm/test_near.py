import random
import sys
from pathlib import Path

import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).parent))

import helpers as h  # noqa: E402
from tallycast.llm import embeddings, graph, minhash  # noqa: E402


def near_rows():
    r = random.Random(5)
    rows = h.awkward()
    base = h.prose(7, 150).split()
    for k in range(120):  # copies with few to many changes, so that some link only through others
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 6, 9])):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        rows.append((300 + k, " ".join(w), "s"))
    return rows + [(500, "One two THREE four", "s"), (501, "one\ttwo three  four", "s"), (502, "É two three four", "s"), (503, "é two three four", "s")]


def expected(rows, width, percent):
    sets = [h.shingles(t, width) for _, t, _ in rows]
    links = [(a, b) for b in range(len(rows)) for a in range(b) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, h.classes(len(rows), links)


def test_near_groups(spark):
    rows = near_rows()
    docs = h.table(spark, rows)
    for width, percent in ((3, 85), (5, 80)):
        sets, root = expected(rows, width, percent)
        ids = {c: h.smallest([i for (i, _, _), k in zip(rows, root) if k == c]) for c in set(root)}
        want = [(i, len(s), i if not s else ids[k]) for (i, _, _), s, k in zip(rows, sets, root)]
        got = minhash.near_groups(docs, width=width, percent=percent)
        assert h.rows_of(got.select("doc_id", "n_shingles", "component_id")) == h.ordered(want)
        assert got.filter("kept <> (doc_id <=> component_id)").count() == 0
    left = minhash.drop_near_copies(docs)
    sets, root = expected(rows, 5, 80)
    wordless = sum(not s for s in sets)
    assert left.columns == docs.columns
    assert left.count() == wordless + len({k for k, s in zip(root, sets) if s})
    assert minhash.near_groups(docs.limit(0)).count() == 0 and minhash.drop_near_copies(docs.limit(0)).count() == 0


def test_bands_follow_the_threshold(spark, monkeypatch):
    seen = []
    real = minhash._sketch
    monkeypatch.setattr(minhash, "_sketch", lambda width, bands, rows: seen.append((bands, rows)) or real(width, bands, rows))
    docs = h.table(spark, [(1, h.prose(1, 30), "s"), (2, h.prose(1, 30), "s")])
    for percent in (85, 80, 50):
        assert minhash.near_groups(docs, percent=percent).filter("kept").count() == 1
        bands, rows = seen[-1]
        assert (1 - (percent / 100) ** rows) ** bands <= 3e-7 and bands * rows <= minhash.COORDINATES
    assert seen[:2] == [(32, 6), (50, 6)]


def test_sketches_estimate_similarity():
    r = np.random.default_rng(1)
    for share in (0.5, 0.85):
        off = []
        for n in (3, 40, 1000):
            both = int(share * n)
            pool = r.integers(0, 2**63, 2 * n, dtype=np.uint64)
            a, b = pool[:n], np.r_[pool[:both], pool[n : 2 * n - both]]
            s = minhash.sketches([a, b], 1024)
            assert (s != np.iinfo(np.uint64).max).all()
            off.append((s[0] == s[1]).mean() - both / (2 * n - both))
        assert np.abs(off).max() < 0.08


def test_tiles_find_what_pairs_find():
    r = random.Random(3)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(r.choice([w, w, w, w, w, w, w, "z"]) for w in base) for _ in range(40)]
    sets = [minhash.shingle_set(t.encode(), minhash._Words(), 2) for t in texts]
    both = minhash._overlaps(sets)
    assert all(both[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40) if i != j)


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(400, 480)] + [(5, 5), (600, 601), (600, 601)]
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = h.classes(700, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_vectors(spark):
    r = np.random.default_rng(4)
    base = r.normal(size=(6, 16))
    rows = [(int(k), (base[k % 6] + r.normal(size=16) * r.choice([0.01, 0.1, 0.2])).tolist(), k % 3) for k in range(150)]
    same = rows[0][1]
    rows += [(200 + k, same, 0) for k in range(5)] + [(210, [2 * x for x in same], 0), (211, same, None), (212, None, 0), (213, [0.0] * 16, 0), (214, [], 0)]
    rows += [(215, [float("nan")] + same[1:], 0), (216, [None] + same[1:], 0), (217, same + [0.0], 0), (218, same + [0.0], 0), (200, same, 0), (None, same, 0)]
    rows += [(219, [1e300] * 16, 1), (220, [float("inf")] + same[1:], 0)]
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and 0 < np.linalg.norm(v) < np.inf and c is not None for _, v, c in rows]
    links = []
    for b in range(len(rows)):
        for a in range(b):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    links.append((a, b))
    root = h.classes(len(rows), links)
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    ids = {c: h.smallest([i for (i, _, _), k in zip(rows, root) if k == c]) for c in set(root)}
    want = [(i, int(n), ids[k]) for (i, _, _), n, k in zip(rows, count, root)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "'x' AS node", "'y' AS vector", "'z' AS row_id")
    got = embeddings.near_vectors(table)
    assert h.rows_of(got.select("vec_id", "n_links", "component_id")) == h.ordered(want)
    assert embeddings.near_vectors(table.limit(0)).count() == 0


def test_early_stop_loses_no_pair():
    r = np.random.default_rng(9)
    x = r.normal(size=(200, 48)) * np.linspace(3, 0.1, 48)
    x[100:] = x[:100] + r.normal(size=(100, 48)) * 0.08
    unit = embeddings._unit(x)
    _, axes = np.linalg.eigh(unit.T @ unit)
    p = unit @ axes[:, ::-1]
    for least in (0.9, 0.98, 0.999):
        i, j = embeddings.reaching_pairs(x, x, p, p, least, True)
        want = np.argwhere(np.triu(unit @ unit.T >= least, 1))
        assert sorted(zip(i, j)) == [tuple(w) for w in want]


def test_tiles_join_components_only():
    r = random.Random(8)
    base = [f"w{k}" for k in range(80)]
    sets = [minhash.shingle_set(" ".join(r.choice([w] * 30 + ["z"]) for w in base).encode(), minhash._Words(), 2) for _ in range(60)]
    linked = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
    for answering in (0, 40):
        parts = [k if k >= answering else 0 for k in range(60)]
        tile = pd.DataFrame({"node": range(60), "component": parts, "answers": [k < answering for k in range(60)], "shingles": [s.tobytes() for s in sets]})
        got = list(minhash._meeting(85)(tile).itertuples(index=False, name=None))
        assert all(linked(a, b) and parts[a] != parts[b] for a, b in got)
        want = [(a, b) for a in range(answering, 60) for b in range(60) if parts[a] != parts[b] and linked(a, b)]
        assert want and h.classes(60, got) == h.classes(60, want) and len(got) < 60
    assert minhash._meeting(85)(tile[tile["answers"]]).empty
