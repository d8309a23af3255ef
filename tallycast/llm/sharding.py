"""Resharding by minimum-cost flow.

Old shard sizes are supplies, new capacities are demands, a byte that stays costs nothing and a byte that moves costs
one. The flow (a small problem: its nodes are shards, not rows) says how many bytes go from each old shard to each new
one. An old shard is then laid out in one order and cut at the flow's amounts: the first block stays, the others move.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.common import BUCKET_BITS, hash_bucket, prefix_starts, running_before
from tallycast.session import cut_lineage

#: A plan names shards, never rows. Beyond so many shards it is refused: it is solved on the driver and broadcast.
MAX_SHARDS = 4096
#: Documents above this part of a shard's capacity come first in an old shard's order, so cuts fall between small ones.
LARGE_PART = 1 / 1000


def min_cost_flow(supply: dict[int, int], capacity: dict[int, int], cost=lambda old, new: int(old != new)) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard, at the least cost, by successive shortest paths with potentials.

    ``capacity`` must have room for all of ``supply``. ``cost`` is the price of a byte (never negative).
    """
    if sum(capacity.values()) < sum(supply.values()):
        raise ValueError("the new shards have no room for all bytes")
    olds, news = sorted(supply), sorted(capacity)
    left, room, flow = dict(supply), dict(capacity), {}
    price = {("o", i): 0 for i in olds} | {("n", j): 0 for j in news}
    while any(left.values()):
        best, via, heap = {}, {}, []
        for i in olds:
            if left[i]:
                best["o", i] = 0
                heap.append((0, ("o", i)))
        heapq.heapify(heap)
        settled = set()
        while heap:
            d, node = heapq.heappop(heap)
            if node in settled:
                continue
            settled.add(node)
            side, k = node
            if side == "o":
                steps = ((("n", j), cost(k, j)) for j in news)
            else:
                steps = ((("o", i), -cost(i, k)) for i in olds if flow.get((i, k)))
            for to, c in steps:
                reached = d + c + price[node] - price[to]
                if to not in settled and reached < best.get(to, float("inf")):
                    best[to], via[to] = reached, node
                    heapq.heappush(heap, (reached, to))
        far = max(best.values())
        for node in price:
            price[node] += best.get(node, far)
        end = min((("n", j) for j in news if room[j]), key=lambda n: (price[n] if n in best else float("inf"), n))
        path = [end]
        while path[-1] in via:
            path.append(via[path[-1]])
        path.reverse()
        amount = min(left[path[0][1]], room[end[1]])
        for a, b in zip(path, path[1:]):
            if a[0] == "n":  # taken back
                amount = min(amount, flow[b[1], a[1]])
        for a, b in zip(path, path[1:]):
            pair, sign = ((a[1], b[1]), 1) if a[0] == "o" else ((b[1], a[1]), -1)
            flow[pair] = flow.get(pair, 0) + sign * amount
            if not flow[pair]:
                del flow[pair]
        left[path[0][1]] -= amount
        room[end[1]] -= amount
    return flow


def equal_capacities(total: int, shards: int) -> dict[int, int]:
    return {k: total // shards + (k < total % shards) for k in range(shards)}


def reshard(rows: DataFrame, capacity_of, shards: int) -> DataFrame:
    """``rows`` (``size``, ``old`` shard, ``key`` hash, ``tie`` columns) with ``shard`` and a gapless ``slot``.

    ``capacity_of(total)`` gives the new capacities. Only the narrow rows are shuffled; bytes per old shard are the
    only figures that reach the driver. Sizes end within a large document's part of the capacity.
    """
    sizes = {r["old"]: int(r["size"]) for r in rows.groupBy("old").agg(F.sum("size").alias("size")).limit(MAX_SHARDS + 1).collect()}
    if max(len(sizes), shards) > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards")
    total = sum(sizes.values())
    capacity = capacity_of(total)
    flow = min_cost_flow(sizes, capacity)
    blocks = []
    for old in sizes:
        parts = sorted(((new != old, new, amount) for (i, new), amount in flow.items() if i == old))
        ends, at = [], 0
        for _, _, amount in parts:
            at += amount
            ends.append(at)
        blocks.append((old, ends[:-1], [new for _, new, _ in parts]))
    spark = rows.sparkSession
    plan = F.broadcast(spark.createDataFrame(blocks, "old int, ends array<long>, news array<int>"))

    # large documents first, by powers of two; hash order within a power
    least = max(1.0, total / shards * LARGE_PART)
    power = F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / F.lit(least)))).cast("long")
    rows = rows.withColumn("bucket", F.shiftleft(63 - power, BUCKET_BITS) + hash_bucket("key"))
    ahead = running_before("size", ["old"], "bucket", ["key", "doc_id", "size", "text_crc32"])
    middle = F.col("start") + F.col("ahead") + F.col("size") / 2
    passed = F.size(F.filter("ends", lambda end: end.cast("double") <= F.col("middle")))
    starts = prefix_starts(rows, ["old"], "bucket", "size")
    placed = (
        rows.withColumn("ahead", ahead)
        .join(starts, ["old", "bucket"])
        .withColumn("middle", middle)
        .join(plan, "old")
        .withColumn("shard", F.element_at("news", passed + 1))
        .drop("ends", "news", "ahead", "start", "middle")
    )
    placed = cut_lineage(placed, "shard-placed")
    # position within a new shard: by old shard, bucket and key
    counted = placed.withColumn("one", F.lit(1)).withColumn("place", F.struct("old", "bucket"))
    starts = prefix_starts(counted, ["shard"], "place", "one").select("shard", "place.old", "place.bucket", "start")
    ahead = running_before("one", ["shard", "old"], "bucket", ["key", "doc_id", "size", "text_crc32"])
    slots = counted.withColumn("ahead", ahead).join(starts, ["shard", "old", "bucket"])
    return slots.withColumn("slot", F.col("start") + F.col("ahead")).drop("ahead", "start", "one", "place")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text and one for its end; a null text has none of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_table(docs: DataFrame, old: Column, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where each document of ``docs`` goes when its ``old`` shards become ``shards`` of near equal bytes.

    Returns ``doc_id``, ``size``, ``text_crc32`` (0 for null), ``old``, ``shard``, ``slot``. Null and repeated ids are
    ordinary values: repeated rows each get a slot. An empty table gives an empty plan.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        byte_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        old.cast("int").alias("old"),
    ).withColumn("key", F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text_crc32")))
    rows = cut_lineage(rows, "shard-rows")
    return reshard(rows, lambda total: equal_capacities(total, shards), shards).drop("key", "bucket")


def reshard_folder(spark: SparkSession, folder: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """Reshard a folder of ``shard=N`` partitions in place; only shards that gain or lose a document are rewritten.

    The new contents of the affected shards are written to a folder beside first. Then they replace the old ones, and
    shards that are no longer in use go. A run that breaks off leaves the staged folder, and the
    documents in it are complete. Returns how many bytes moved and which shards were rewritten.
    """
    docs = spark.read.parquet(folder)
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.struct(*[c for c in docs.columns if c != "shard"]).alias("row"),
        F.col("shard").cast("int").alias("old"),
        F.col(f"`{id_col}`").alias("doc_id"),
        byte_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("key", F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text_crc32")))
    rows = cut_lineage(rows, "reshard-rows")
    moves = cut_lineage(reshard(rows.drop("row"), lambda total: equal_capacities(total, shards), shards).select("row_id", "old", "size", "shard"), "reshard-moves")
    moved = moves.filter("old <> shard")
    changed = sorted(
        {r[0] for r in moved.select("old").distinct().limit(MAX_SHARDS).collect()}
        | {r[0] for r in moved.select("shard").distinct().limit(MAX_SHARDS).collect()}
    )
    total = moved.agg(F.sum("size")).first()[0] or 0
    if not changed:
        return {"moved_bytes": 0, "rewritten": []}
    stage = f"{folder.rstrip('/')}.staged-{uuid.uuid4().hex}"
    affected = rows.drop("size").join(moves.filter(F.col("shard").isin(changed)).select("row_id", "shard"), "row_id")
    affected.select("row.*", "shard").write.partitionBy("shard").parquet(stage)
    fs = spark._jvm.org.apache.hadoop.fs
    path = lambda p: fs.Path(p)
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for k in changed:
        files.delete(path(f"{folder}/shard={k}"), True)
        if files.exists(path(f"{stage}/shard={k}")):
            files.rename(path(f"{stage}/shard={k}"), path(f"{folder}/shard={k}"))
    files.delete(path(stage), True)
    return {"moved_bytes": int(total), "rewritten": changed}
