"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has T coordinates. In round i < T every shingle is thrown into one coordinate by a hash of its own and may
lower the value there; values of earlier rounds are below all later ones. In rounds T to 2T - 1 all shingles go to
coordinate i - T. So each coordinate is filled after 2T rounds at the latest, most sets fill theirs within a few, and
the share of equal coordinates of two sets is concentrated around their similarity as if coordinates were independent.

Sets that agree in a whole band of coordinates are candidates. Every link is confirmed on the full sets. Equal sets
are one node from the start. Within a band's bucket nobody emits all pairs. Each node is first compared with the middle
of its group, the node whose buckets are fullest. Where a bucket still holds several components, nodes outside its main
one are compared with one node of that for each bucket they share. Only what is left meets in tiles of bounded size:
nodes outside the main component with each other and with that one, never two nodes of one component. A tile returns no
more links than it has nodes.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import in_slices
from tallycast.llm.graph import components
from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A pair at the threshold misses all bands with this probability at most. Rows of a band and coordinates at most.
MISSED, ROWS, COORDINATES = 3e-7, 6, 2048
#: Nodes and shingles of a tile.
TILE_NODES, TILE_SHINGLES = 256, 500_000
#: Distinct words whose hashes a task remembers.
REMEMBERED = 150_000


class _Words(dict):
    """Word to 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_SEEDS = _mixed(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: bytes | None, words: _Words, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words; a shorter text is one shingle."""
    tokens = text.lower().split() if text else []  # bytes: A-Z and the six white-space bytes only
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(hashes) - width + 1)
    total = np.full(n, _SEEDS[4000 + min(width, len(hashes))], np.uint64)
    for k in range(min(width, len(hashes))):
        total += _mixed(hashes[k : k + n] ^ _SEEDS[k]) * (_SEEDS[k + 100] | np.uint64(1))
    return np.unique(_mixed(total))


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` coordinates for each set; sets must not be empty."""
    out = np.full(len(sets) * size, np.iinfo(np.uint64).max, np.uint64)
    open_sets = np.arange(len(sets))
    owner = np.repeat(open_sets, [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * size):
        thrown = _mixed(items + _SEEDS[i])
        if i < size:
            place = ((thrown >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        else:
            place = np.uint64(i - size)
        np.minimum.at(out, owner * size + place.astype(np.int64), (np.uint64(i) << np.uint64(32)) | (thrown & low))
        still = (out.reshape(-1, size)[open_sets] == np.iinfo(np.uint64).max).any(axis=1)
        if not still.all():
            open_sets = open_sets[still]
            if not len(open_sets):
                break
            is_open = np.zeros(len(sets), bool)
            is_open[open_sets] = True
            held = is_open[owner]
            owner, items = owner[held], items[held]
    return out.reshape(-1, size)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band; keys of different bands differ."""
    total = np.broadcast_to(_SEEDS[2000 : 2000 + bands], (len(sketch), bands)).copy()
    cells = sketch.reshape(len(sketch), bands, rows)
    for k in range(rows):
        total = _mixed(total ^ (cells[:, :, k] + _SEEDS[3000 + k]))
    return total.view(np.int64)


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows for a threshold: 32 of 6 at 85 %, 50 of 6 at 80 %; fewer rows where that takes too many bands."""
    for rows in range(ROWS, 0, -1):
        agree = (percent / 100) ** rows
        bands = 1 if agree >= 1 else math.ceil(math.log(MISSED) / math.log1p(-agree))
        if bands * rows <= COORDINATES:
            return bands, rows
    raise ValueError(f"no bands find pairs at {percent} %")


def _sketch(width: int, bands: int, rows: int):
    fields = ["row_id", "doc_id", "text_hash", "n_shingles", "set_key", "bands"]

    def run(batches):
        words = _Words()
        for batch in in_slices(batches):
            sets = [shingle_set(t, words, width) for t in batch.column(3).cast(pa.binary()).to_pylist()]
            full = [k for k, s in enumerate(sets) if len(s)]
            keys = band_keys(sketches([sets[k] for k in full], bands * rows), bands, rows)
            found: list = [None] * len(sets)
            for k, row in zip(full, keys):
                found[k] = row
            digest = [hashlib.sha256(s.tobytes()).digest() if len(s) else None for s in sets]
            made = [pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *made], fields)

    return run


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that span what ``linked`` connects, one fewer than the nodes of each part."""
    new, out = np.ones(len(linked), bool), []
    for start in range(len(linked)):
        if not new[start]:
            continue
        new[start], queue = False, [start]
        while queue:
            i = queue.pop()
            found = np.flatnonzero(linked[i] & new)
            new[found] = False
            out += [(i, int(j)) for j in found]
            queue += found.tolist()
    return out


def _shingle_sets(width: int):
    def run(batches):
        words = _Words()
        for batch in in_slices(batches):
            sets = [shingle_set(t, words, width).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["node", "n_shingles", "shingles"])

    return run


def _overlaps(sets: list[np.ndarray], askers: int | None = None) -> np.ndarray:
    """Sizes of the intersections of the first ``askers`` sets (all unless given) with each set, by products of the
    incidence matrix in strips."""
    askers = len(sets) if askers is None else askers
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1  # what only one set has is in no intersection
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    total = np.zeros((askers, len(sets)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    strip = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, strip):
        a, b = np.searchsorted(column, [first, first + strip])
        part = np.zeros((len(sets), strip), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        total += part[:askers] @ part.T
    return total.astype(np.int64)


def _star(percent: int):
    """Links of one hub's tile: (a, b)."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, np.uint64) for s in tile["shingles"]]
        hub = int(np.flatnonzero(tile["is_hub"].to_numpy())[0])
        nodes, pairs = tile["node"].to_numpy(), []
        for k, other in enumerate(sets):
            if k != hub and 100 * min(len(other), len(sets[hub])) >= percent * max(len(other), len(sets[hub])):
                both = len(np.intersect1d(sets[hub], other, assume_unique=True))
                if 100 * both >= percent * (len(sets[hub]) + len(other) - both):
                    pairs.append((nodes[hub], nodes[k]))
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    return run


def _meeting(percent: int):
    """Links that join components in one tile: those who ask with those who answer, or with each other where none does."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["answers", "node"], kind="stable")
        nodes, parts, answers = tile["node"].to_numpy(), tile["component"].to_numpy(), tile["answers"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in tile["shingles"]]
        askers = int((~answers).sum())
        if not askers:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sizes = np.array([len(s) for s in sets])
        both = _overlaps(sets, askers)
        hit = 100 * both >= percent * (sizes[:askers, None] + sizes[None, :] - both)
        hit &= parts[:askers, None] != parts[None, :]
        linked = np.zeros((len(sets), len(sets)), bool)
        linked[:askers] = hit
        linked[:, :askers] |= hit.T
        pairs = _forest(linked)
        return pd.DataFrame({"a": [nodes[i] for i, _ in pairs], "b": [nodes[j] for _, j in pairs]}, dtype="int64")

    return run


def _tiles(where: str | None = None):
    """Tiles that hold the rows of a group (those that meet ``where``), bounded in nodes and in shingles."""
    one, size = F.lit(1), F.col("n_shingles")
    if where:
        one, size = F.when(F.expr(where), one), F.when(F.expr(where), size)
    return F.ceil(F.greatest(F.count(one) / TILE_NODES, F.coalesce(F.sum(size), F.lit(0)) / TILE_SHINGLES)).cast("int")


def _star_links(asked: DataFrame, sets: DataFrame, percent: int, purpose: str) -> DataFrame:
    """Links found when every ``node`` of ``asked`` is compared with its ``hub``."""
    per_hub = cut_lineage(asked.groupBy("hub").agg(_tiles().alias("tiles")), f"{purpose}-hubs")
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    spokes = asked.join(per_hub, "hub").select("hub", tile.alias("tile"), "node", F.lit(False).alias("is_hub"))
    hubs = per_hub.select("hub", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), F.col("hub").alias("node"), F.lit(True).alias("is_hub"))
    stars = spokes.unionByName(hubs).join(sets, "node")
    return cut_lineage(stars.groupBy("hub", "tile").applyInPandas(_star(percent), "a long, b long"), f"{purpose}-links")


def _open_buckets(members: DataFrame, joined: DataFrame, asked: DataFrame, purpose: str) -> DataFrame:
    """Rows of the buckets that hold several components, with ``main``, the component with most nodes there.

    Of buckets with the same nodes one is returned, and none of two nodes that have been compared.
    """
    labelled = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    node = F.col("node")
    parts = labelled.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n"), F.min(node).alias("a"), F.max(node).alias("b"),
        F.bit_xor(F.xxhash64(node)).alias("x"), F.bit_xor(F.xxhash64(F.lit(2), node)).alias("y"),
    )
    spread = parts.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"),
        F.min("a").alias("a"), F.max("b").alias("b"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
    ).filter("parts > 1")
    pairs = asked.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"), F.lit(2).cast("long").alias("n"))
    once = spread.groupBy("a", "b", "n", "x", "y").agg(F.min(F.struct("key", "main.component")).alias("least"))
    once = once.join(pairs, ["a", "b", "n"], "left_anti").select("least.key", F.col("least.component").alias("main"))
    return cut_lineage(labelled.join(cut_lineage(once, f"{purpose}-keys"), "key"), f"{purpose}-rows")


def _exhausted(inside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of open buckets: nodes outside the main component of a bucket meet each other and all nodes of that one."""
    minor = "component <> main"
    tiles = inside.groupBy("key").agg(_tiles(minor).alias("asking"), _tiles("component = main").alias("answering"))
    placed = inside.join(cut_lineage(tiles, "near-tiles"), "key").withColumn("minor", F.expr(minor))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("minor"), F.col("asking")).otherwise(F.col("answering"))).cast("int"))
    upto = lambda end: F.sequence(F.lit(0), end)
    place = lambda i, j, inner, answers: F.struct(i.alias("i"), j.alias("j"), F.lit(inner).alias("inner"), answers.alias("answers"))
    own, none, yes = F.col("own"), F.lit(False), F.lit(True)
    asks = F.concat(
        F.transform(upto(F.col("answering") - 1), lambda j: place(own, j, False, none)),
        F.transform(F.sequence(own, F.col("asking") - 1), lambda j: place(own, j, True, none)),
        F.filter(F.transform(upto(own), lambda i: place(i, own, True, yes)), lambda p: p["i"] < p["j"]),
    )
    answers = F.transform(upto(F.col("asking") - 1), lambda i: place(i, own, False, yes))
    placed = placed.select("key", "node", "component", F.explode(F.when(F.col("minor"), asks).otherwise(answers)).alias("at"))
    met = placed.select("key", "node", "component", "at.*").join(sets, "node").groupBy("key", "i", "j", "inner")
    return cut_lineage(met.applyInPandas(_meeting(percent), "a long, b long"), "near-met")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id``, ``kept``.

    Words are runs without white space, A-Z lower-cased; sets hold the distinct shingles of ``width`` words. Documents
    are linked when 100 * intersection >= percent * union. ``component_id`` is the smallest id reachable; null ids count
    only where all are null. Documents without words are linked with nothing. Equal texts have equal sets and
    so one component; rows that repeat an id are each returned. An empty table gives no rows.
    ``text_hash`` tells apart rows that share an id. Options: ``width``, ``percent``; ``bands`` and ``rows``, which follow
    from ``percent`` unless both are given.
    """
    out = _groups(docs, id_col, text_col, **options).drop("component")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _groups(docs: DataFrame, id_col: str, text_col: str, width: int = 5, percent: int = 80, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """``near_groups`` with ``component``, a number for each component of several rows and null elsewhere."""
    if bands is None or rows is None:
        bands, rows = banding(percent)
    texts = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
        F.col(f"`{text_col}`").alias("text"),
    )
    id_kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"row_id long, doc_id {id_kind}, text_hash long, n_shingles long, set_key binary, bands array<long>"
    sketched = cut_lineage(texts.mapInArrow(_sketch(width, bands, rows), schema), "near-sketches")

    first = F.min(F.struct("row_id", "doc_id", "text_hash", "n_shingles", "bands")).alias("first")
    nodes = sketched.filter("n_shingles > 0").groupBy("set_key").agg(first, F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    nodes = cut_lineage(nodes.select("set_key", F.col("first.row_id").alias("node"), "first.doc_id", "first.text_hash", "first.n_shingles", "first.bands", "least_id", "copies"), "near-nodes")

    keyed = nodes.select("node", "n_shingles", F.explode("bands").alias("key"))
    sizes = cut_lineage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-buckets")
    members = cut_lineage(keyed.join(sizes, "key"), "near-placed")
    # a node that agrees with many is near the middle of its group
    scores = cut_lineage(members.groupBy("node").agg(F.sum("n").alias("score")), "near-scores")
    members = cut_lineage(members.join(scores, "node").select("key", "node", "n_shingles", "score"), "near-members")

    wanted = nodes.join(scores.select("node"), "node", "left_semi")
    wanted = wanted.select("node", F.col("doc_id").alias("want_id"), F.col("text_hash").alias("want_hash"), "n_shingles")
    same = (F.col("text_hash") == F.col("want_hash")) & F.col("doc_id").eqNullSafe(F.col("want_id"))
    # by key at every size, as a large corpus needs it; of rows that repeat id and text one is kept
    found = texts.select("doc_id", "text_hash", F.col("text").cast("binary").alias("text")).join(wanted.hint("merge"), same)
    found = found.groupBy("node", "n_shingles").agg(F.first("text").alias("text"))
    sets = cut_lineage(found.mapInArrow(_shingle_sets(width), "node long, n_shingles long, shingles binary"), "near-sets").select("node", "shingles")

    # each node with the middle one of a bucket, the one that most of its buckets have in common
    hubs = cut_lineage(members.groupBy("key").agg(F.max(F.struct("score", "node")).alias("hub")), "near-middles")
    meant = members.join(hubs, "key").filter("node <> hub.node").groupBy("node", "n_shingles", "hub").agg(F.count(F.lit(1)).alias("shared"))
    chosen = meant.groupBy("node", "n_shingles").agg(F.max(F.struct("shared", "hub")).alias("best"))
    asked = cut_lineage(chosen.select(F.col("best.hub.node").alias("hub"), "node", "n_shingles"), "near-asked")
    linked = _star_links(asked, sets, percent, "near-first")
    joined = cut_lineage(components(linked), "near-joined")

    # who is still outside a bucket's main component, with one node of it for each bucket
    inside = _open_buckets(members, joined, asked, "near-open")
    pick = F.min(F.struct(F.xxhash64("key", "node"), "node")).alias("pick")
    picks = cut_lineage(inside.filter("component = main").groupBy("key").agg(pick), "near-picks")
    again = inside.filter("component <> main").join(picks, "key").select(F.col("pick.node").alias("hub"), "node", "n_shingles").distinct()
    again = cut_lineage(again.join(asked, ["hub", "node"], "left_anti"), "near-asked-again")
    linked = linked.unionByName(_star_links(again, sets, percent, "near-second"))
    joined = cut_lineage(components(linked), "near-joined-again")

    inside = _open_buckets(members, joined, asked.unionByName(again), "near-left")
    linked = linked.unionByName(_exhausted(inside, sets, percent))
    joined = cut_lineage(components(linked), "near-components")

    # ids back to the documents, for sets with copies or links
    least = nodes.join(joined, "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    special = nodes.join(joined, "node", "left").filter("copies > 1 OR component IS NOT NULL").select("set_key", "least_id", F.coalesce("component", "node").alias("component"))
    special = special.join(least, "component", "left").select("set_key", F.coalesce("component_id", "least_id").alias("component_id"), "component")
    special = cut_lineage(special, "near-special")
    out = sketched.select("doc_id", "text_hash", "n_shingles", "set_key").join(special, "set_key", "left")
    own = F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"), "component")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Null ids come last; rows that share the smallest id keep the one with the smaller text hash, and of rows that
    repeat both one is kept. Documents without words all stay.
    """
    grouped = _groups(docs, id_col, text_col, **options).filter("component IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash").alias("key")
    members = cut_lineage(grouped.groupBy("component", order).agg(F.count(F.lit(1)).alias("n")), "near-keys")
    best = cut_lineage(members.groupBy("component").agg(F.min("key").alias("best")), "near-best")
    members = members.join(best, "component")
    again = members.filter("key = best AND n > 1").select("key")
    gone = members.filter("key <> best").select("key").unionByName(again)
    own = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"))
    rows = docs.select(own.alias("key"), F.struct("*").alias("row"))
    stay = rows.join(cut_lineage(gone, "near-gone"), "key", "left_anti")
    one = rows.join(cut_lineage(again, "near-again"), "key", "left_semi").dropDuplicates(["key"])
    return stay.unionByName(one).select("row.*")
