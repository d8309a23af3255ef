"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are turned onto the principal axes of the whole table, largest variance first. Vectors within the
threshold are close on every axis, so cells on the leading axes and the extents of tiles say which tiles can meet at
all. Two tiles are compared by accumulating the products of leading dimensions; the rest of a product is at most the
product of the two suffix norms, and a pair is dropped as soon as it cannot reach the threshold. What is left is
confirmed on the vectors as given, in double precision. Equal vectors are one node from the start.
"""

from __future__ import annotations

import math
import sys
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm.graph import components
from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of a tile, axes that cut cells, axes whose extents a tile keeps, dimensions of the steps of a product.
TILE, CELL_AXES, BOX_AXES = 1024, 2, 8
STEPS = (8, 16, 32, 64, 128, 256, 512, 1024)
#: The second moments reach the driver, so the dimension is bounded.
MAX_DIMENSION = 2048
#: Allowance for rounding where products are compared with bounds.
SLACK = 1e-9


@contextmanager
def rows_at_once(spark: SparkSession, rows: int):
    """Tiles are large values: few of them go to Python at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def _valid(batches):
    """Vectors as bytes of doubles, null where they link with nothing."""
    for batch in batches:
        given = batch.column(1)
        vectors: list = [None] * len(given)
        offsets = np.asarray(given.offsets)
        lengths = np.diff(offsets)
        values = given.values.cast(pa.float64())
        missing = np.asarray(values.is_null())
        numbers = np.asarray(values.fill_null(0.0), dtype=np.float64) + 0.0  # no negative zero
        usable = ~np.asarray(given.is_null())
        for n in np.unique(lengths[usable]):
            if n == 0:
                continue
            which = np.flatnonzero(usable & (lengths == n))
            places = offsets[which][:, None] + np.arange(n)
            x = numbers[places]
            with np.errstate(over="ignore", invalid="ignore"):
                norm = np.sqrt((x * x).sum(axis=1))
            good = np.isfinite(norm) & (norm > 0) & ~missing[places].any(axis=1)
            for k, row in zip(which[good], x[good]):
                vectors[k] = row.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary()), batch.column(2)], ["vec_id", "vector", "label"])


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(vectors: list[bytes]) -> list[np.ndarray]:
    lengths = np.array([len(v) for v in vectors])
    return [np.flatnonzero(lengths == n) for n in np.unique(lengths)]


def _moments(size: int):
    """Sums of outer products over a task, vectors padded to ``size``."""

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            vectors = batch.column(0).to_pylist()
            for which in _by_length(vectors):
                x = _unit(_matrix([vectors[k] for k in which]))
                total[: x.shape[1], : x.shape[1]] += x.T @ x
        cells = total.ravel()
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(cells)), "total": cells})

    return run


def _rotated(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return _unit(x) @ axes[: x.shape[1]]


def _placed(axes: np.ndarray, reach: float):
    names = ["node", "copies", "vector", "label", "size", "c0", "c1", "along"]

    def run(batches):
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            lead = np.zeros((len(vectors), CELL_AXES + 1))
            for which in _by_length(vectors):
                y = _rotated(_matrix([vectors[k] for k in which]), axes)[:, : CELL_AXES + 1]
                lead[which, : y.shape[1]] = y
            cell = np.floor(lead[:, :CELL_AXES] / reach).astype(np.int32)
            size = pa.array([len(v) // 8 for v in vectors], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, size, pa.array(cell[:, 0]), pa.array(cell[:, 1]), pa.array(lead[:, CELL_AXES])], names)

    return run


def _tiles(axes: np.ndarray):
    """Consecutive rows of one cell, at most TILE of them, as one row with their extents on the leading axes."""
    names = ["tile", "label", "size", "c0", "c1", "nodes", "copies", "vectors", "low", "high"]
    doubles = pa.list_(pa.float64())
    kinds = [pa.int64(), None, pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), doubles, doubles]

    def run(batches):
        number, held, key = TaskContext.get().partitionId() << 32, [], None

        def closed(label_kind):
            nonlocal number
            x = _matrix([h[2] for h in held])
            box = _rotated(x, axes)[:, :BOX_AXES]
            ids, copies = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
            row = [number, *key, ids.tobytes(), copies.tobytes(), x.tobytes(), box.min(axis=0), box.max(axis=0)]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v], k or label_kind) for v, k in zip(row, kinds)], names)

        for batch in batches:
            kind = batch.column(3).type
            columns = [c.to_pylist() for c in batch.columns]
            for node, copies, vector, *cell in zip(*columns[:7]):
                if held and (cell != key or len(held) == TILE):
                    yield closed(kind)
                    held = []
                key = cell
                held.append((node, copies, vector))
        if held:
            yield closed(kind)

    return run


def reaching_pairs(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows with a cosine of ``least`` or more.

    ``p`` and ``q`` are the unit vectors of ``x`` and ``y`` on the principal axes; ``same``: one tile with itself, each
    pair once.
    """
    d = p.shape[1]
    ends = [k for k in STEPS if k < d] + [d]
    rest_p = np.sqrt(np.maximum(0, 1 - np.cumsum(p * p, axis=1)))
    rest_q = np.sqrt(np.maximum(0, 1 - np.cumsum(q * q, axis=1)))
    k = ends[0]
    product = p[:, :k] @ q[:, :k].T
    can = product + rest_p[:, k - 1, None] * rest_q[None, :, k - 1] >= least - SLACK
    if same:
        can = np.triu(can, 1)
    i, j = np.nonzero(can)
    sums = product[i, j]
    for a, b in zip(ends, ends[1:]):
        if not len(i):
            break
        parts = [np.einsum("ij,ij->i", p[i[s : s + 65536], a:b], q[j[s : s + 65536], a:b]) for s in range(0, len(i), 65536)]
        sums = sums + np.concatenate(parts)
        stay = sums + rest_p[i, b - 1] * rest_q[j, b - 1] >= least - SLACK
        i, j, sums = i[stay], j[stay], sums[stay]
    # on the vectors as given
    keep = []
    norm_x, norm_y = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    for s in range(0, len(i), 65536):
        a, b = i[s : s + 65536], j[s : s + 65536]
        keep.append(np.einsum("ij,ij->i", x[a], y[b]) / (norm_x[a] * norm_y[b]) >= least)
    hit = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[hit], j[hit]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index each of ``n`` nodes reaches by the links (i, j)."""
    root = np.arange(n)
    while True:
        was = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == was).all():
            return root


def _compare(axes: np.ndarray, least: float):
    """For each linked node of a pair of tiles: how many vectors it links to there, and a node it reaches."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = [np.frombuffer(row[f"{s}_nodes"], np.int64) for s in "ab"]
                copies = [np.frombuffer(row[f"{s}_copies"], np.int64) for s in "ab"]
                x, y = (np.frombuffer(row[f"{s}_vectors"], np.float64).reshape(len(n), -1) for s, n in zip("ab", ids))
                same = row["a"] == row["b"]
                i, j = reaching_pairs(x, y, _rotated(x, axes), _rotated(y, axes), least, same)
                if not len(i):
                    continue
                j = j if same else j + len(x)
                node = ids[0] if same else np.concatenate(ids)
                weight = copies[0] if same else np.concatenate(copies)
                count = np.zeros(len(node), np.int64)
                np.add.at(count, i, weight[j])
                np.add.at(count, j, weight[i])
                root = _roots(len(node), i, j)
                linked = np.flatnonzero(count)
                yield pa.RecordBatch.from_pydict({"node": node[linked], "links": count[linked], "reached": node[root[linked]]})

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98
) -> DataFrame:
    """Per vector: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Vectors link when their labels are equal and not null, their lengths are equal and their cosine is ``least`` or
    more. Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing. Null ids count
    in a component only where all are null; repeated rows are vectors of their own. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"), F.col(f"`{label_col}`").alias("label")
    )
    id_kind, label_kind = (given.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    rows = given.mapInArrow(_valid, f"vec_id {id_kind}, vector binary, label {label_kind}")
    rows = cut_lineage(rows.withColumn("row_id", F.monotonically_increasing_id()), "vector-rows")
    usable = rows.filter("vector IS NOT NULL AND label IS NOT NULL")
    nodes = usable.groupBy("label", "vector").agg(F.min("row_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    nodes = cut_lineage(nodes, "vector-nodes")

    size = int((nodes.agg(F.max(F.length("vector"))).first()[0] or 8) // 8)
    if size > MAX_DIMENSION:
        raise ValueError(f"vectors of more than {MAX_DIMENSION} dimensions")
    sums = nodes.select("vector").mapInArrow(_moments(size), "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    moments = np.zeros(size * size)
    for r in sums.collect():  # as many as the square of the dimension
        moments[r["cell"]] = r["total"]
    moments = moments.reshape(size, size)
    _, axes = np.linalg.eigh((moments + moments.T) / 2)
    axes = np.ascontiguousarray(axes[:, ::-1])

    reach = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-6  # how far apart unit vectors of that cosine are at most
    kinds = f"node long, copies long, vector binary, label {label_kind}, size int, c0 int, c1 int, along double"
    placed = nodes.select("node", "copies", "vector", "label").mapInArrow(_placed(axes, reach), kinds)
    order = ["label", "size", "c0", "c1", "along"]
    kinds = f"tile long, label {label_kind}, size int, c0 int, c1 int, nodes binary, copies binary, vectors binary, low array<double>, high array<double>"
    tiles = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_tiles(axes), kinds)
    tiles = cut_lineage(tiles, "vector-tiles")

    step = F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)]))
    a = tiles.select(F.col("tile").alias("a"), "label", "size", "c0", "c1", F.col("low").alias("low_a"), F.col("high").alias("high_a"))
    a = a.withColumn("d0", step).withColumn("d1", step).select("a", "label", "size", (F.col("c0") + F.col("d0")).alias("c0"), (F.col("c1") + F.col("d1")).alias("c1"), "low_a", "high_a")
    b = tiles.select(F.col("tile").alias("b"), "label", "size", "c0", "c1", F.col("low").alias("low_b"), F.col("high").alias("high_b"))
    gap = F.aggregate(
        F.zip_with(F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))),
        F.lit(0.0),
        lambda total, x: total + x * x,
    )
    pairs = a.join(b, ["label", "size", "c0", "c1"]).filter((F.col("a") <= F.col("b")) & (gap <= reach * reach)).select("a", "b")
    pairs = cut_lineage(pairs, "vector-pairs")
    side = lambda s: tiles.select(F.col("tile").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("nodes", "copies", "vectors")])
    with rows_at_once(spark, 16):
        met = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_compare(axes, least), "node long, links long, reached long")
        met = cut_lineage(met, "vector-links")

    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    reached = cut_lineage(components(met.select(F.col("node").alias("a"), F.col("reached").alias("b"))), "vector-components")
    ids = nodes.join(reached, "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    special = nodes.join(links, "node", "left").join(reached, "node", "left").filter("copies > 1 OR links > 0").join(ids, "component", "left")
    special = special.select("label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id"))
    special = cut_lineage(special, "vector-special")
    out = rows.select("vec_id", "label", "vector").join(special, ["label", "vector"], "left")
    own = F.when(F.col("n_links").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
