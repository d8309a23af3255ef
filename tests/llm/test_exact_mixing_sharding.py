import hashlib
import itertools
import os
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import helpers as h  # noqa: E402
from tallycast.llm import exact, mixing, sharding  # noqa: E402


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def test_exact_groups(spark):
    rows = h.awkward()
    rows += [(40, "x" * 256, "s"), (41, "x" * 256, "s"), (42, "x" * 257, "s"), (43, "x" * 3000, "s"), (44, "x" * 3000, "s"), (45, "x" * 2999 + "y", "s")]
    docs = h.table(spark, rows)
    _, verdicts = exact.exact_groups(docs)
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[normal(t)].append(i)
    want = [(i, h.smallest(groups[normal(t)]), len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t, _ in rows]
    assert h.rows_of(verdicts.select("doc_id", "keep_id", "group_size", "text_sha256")) == h.ordered(want)
    assert verdicts.filter("kept").count() == len(groups)
    assert verdicts.filter("kept AND NOT (doc_id <=> keep_id)").count() == 0
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    assert Counter(normal(r["text"]) for r in left.collect()) == Counter(list(groups))
    assert exact.drop_copies(docs.limit(0)).count() == 0


def filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        share = left / max(1, sum(weight[s] for s in names if s not in full))
        over = {s for s in names if s not in full and weight[s] * share > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else weight[s] * share for s in names}
        full |= over


def test_mix(spark):
    rows = h.awkward() + [(100 + k, h.prose(200 + k, 20), "big") for k in range(40)]
    docs = h.table(spark, rows)
    got = mixing.mix(docs).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(h.words(t))
    targets = filled(sizes)
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(h.words(t))) for i, t, _ in rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[r["source_size"], round(r["target"], 6)] += r["taken"]
    want = Counter()
    for s, t in targets.items():
        want[sizes[s], round(t, 6)] += round(t)
    assert all(abs(taken[k] - want[k]) <= len(sizes) for k in want) and set(taken) == set(want)
    assert h.rows_of(mixing.mix(docs)) == h.ordered([tuple(r) for r in got])
    whole = mixing.mixed_rows(docs)
    assert whole.columns == docs.columns
    assert max(Counter((r["doc_id"], r["text"], r["source"]) for r in whole.filter("doc_id <> 21").collect()).values()) <= 3
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_rows(docs.limit(0)).count() == 0


def test_flow_moves_the_fewest_bytes():
    cost = [[0, 3, 1], [2, 0, 4], [5, 1, 0]]
    for supply in itertools.product(range(4), repeat=3):
        capacity = {0: 3, 1: 3, 2: 3}
        flow = sharding.min_cost_flow(dict(enumerate(supply)), capacity, lambda i, j: cost[i][j])
        assert all(sum(v for (i, _), v in flow.items() if i == k) == supply[k] for k in range(3))
        assert all(sum(v for (_, j), v in flow.items() if j == k) <= 3 for k in range(3))
        units = [k for k in range(3) for _ in range(supply[k])]
        room = [j for j in range(3) for _ in range(3)]
        # the cheapest way to seat one byte after the other, over all ways
        best = {(0, 0, 0): 0}
        for i in units:
            nxt = {}
            for used, c in best.items():
                for j in range(3):
                    if used[j] < 3:
                        u = tuple(x + (k == j) for k, x in enumerate(used))
                        nxt[u] = min(nxt.get(u, 10**9), c + cost[i][j])
            best = nxt
        assert sum(v * cost[i][j] for (i, j), v in flow.items()) == min(best.values()) and room
    flow = sharding.min_cost_flow({0: 10, 1: 4, 5: 4}, sharding.equal_capacities(18, 3))
    assert sum(v for (i, j), v in flow.items() if i != j) == 8


def test_shard_table(spark):
    rows = h.awkward() + [(200 + k, h.prose(k, 5 + k % 50), "s") for k in range(400)]
    docs = h.table(spark, rows)
    got = sharding.shard_table(docs, F.pmod(F.xxhash64("doc_id"), F.lit(5)), 8).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append(r)
    assert set(shards) <= set(range(8))
    assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
    mean = sum(r["size"] for r in got) / 8
    largest = max(r["size"] for r in got)
    assert all(abs(sum(r["size"] for r in s) - mean) <= largest for s in shards.values())
    old = Counter()
    for r in got:
        old[r["old"]] += r["size"]
    moved = sum(r["size"] for r in got if r["old"] != r["shard"])
    assert moved <= sum(max(0, v - mean) for v in old.values()) + 4 * largest
    assert sharding.shard_table(docs.limit(0), F.lit(0), 4).count() == 0


def test_reshard_folder(spark, tmp_path):
    folder = str(tmp_path / "shards")
    rows = [(k, h.prose(k, 30), "s") for k in range(300)] + [(None, None, None), (7, h.prose(7, 30), "s")]
    docs = h.table(spark, rows).drop("shard")
    docs = docs.withColumn("shard", F.coalesce((F.col("doc_id") % 4).cast("int"), F.lit(0)))
    docs.filter("shard < 3 OR doc_id < 260").write.partitionBy("shard").parquet(folder)
    before = spark.read.parquet(folder)
    want = h.rows_of(before.select(*[c for c in docs.columns if c != "shard"]))
    told = sharding.reshard_folder(spark, folder, 3)
    assert told["moved_bytes"] > 0 and not os.path.exists(f"{folder}/shard=3")
    assert len([x for x in os.listdir(tmp_path)]) == 1
    after = spark.read.parquet(folder)
    assert h.rows_of(after.select(*[c for c in docs.columns if c != "shard"])) == want
    sizes = {r[0]: r[1] for r in after.groupBy("shard").agg(F.sum(sharding.byte_size(F.col("text")))).collect()}
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 300
    files = {p: os.stat(p).st_mtime_ns for p in map(str, Path(folder).rglob("*.parquet"))}
    assert sharding.reshard_folder(spark, folder, 3)["moved_bytes"] <= 300
    assert set(files) & set(map(str, Path(folder).rglob("*.parquet")))
