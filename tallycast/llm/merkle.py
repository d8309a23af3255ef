"""A Merkle manifest of a dataset: content-addressed records, proofs by descent from the root.

Rows become leaves. Each group of rows has a tree over its leaves in order, and the groups' roots have a tree of their
own; a node is the digest of its two children's hexadecimal digests, or of its only child's. Records lead from a digest
to the nodes below it, over as many levels as one digit of a rank spans. Proofs are found without the tree's layout:
requests start at the root and follow the digits of their rank from record to record. Requests whose leading digits
agree travel as one, so the root is visited once and no digest is a hot key. The nodes passed by are the siblings; a
path read backwards is the proof.

DataFrame functions only. A rank's digits bound what a row carries: a record has ``2 ** (DIGIT_BITS + 1)`` digests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.common import stored_rows
from tallycast.session import cut_lineage

#: Levels of the tree that one record spans.
DIGIT_BITS = 6
#: The columns of a row that its leaf covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: list[Column]) -> Column:
    """The digest of a row: each value with its length in UTF-8 bytes before it, null as ``-``."""
    framed = []
    for v in values:
        text = v.cast("string")
        framed.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*framed).cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves``: ``row_id``, ``tree``, ``rank``, ``leaves_in_tree``, ``leaf`` and what :func:`build` was told to carry.
    ``records``: ``digest``, ``height`` and ``levels``, the digests below by level from the top. ``roots``: ``tree``,
    ``digest``, ``height``, ``rank`` of each group's root. ``root``: one row ``digest``, ``height``, none without rows.
    """

    leaves: DataFrame
    records: DataFrame
    roots: DataFrame
    root: DataFrame

    def write(self, folder: str) -> None:
        """Store all tables under ``folder``, each in one of its own."""
        for name in ("leaves", "records", "roots", "root"):
            getattr(self, name).write.mode("errorifexists").parquet(f"{folder}/{name}")

    @classmethod
    def read(cls, spark, folder: str) -> Manifest:
        return cls(*[spark.read.parquet(f"{folder}/{name}") for name in ("leaves", "records", "roots", "root")])


def _ranked(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``rank`` and ``size`` in their ``tree``. A tree may hold any share of the rows: ranges of the whole
    order are numbered each for itself, and a tree has one row for each range in what is summed up over it."""
    by = ["tree", *order]
    ranges = cut_lineage(rows.repartitionByRange(*by).withColumn("range_id", F.spark_partition_id()), purpose)
    counts = ranges.groupBy("tree", "range_id").agg(F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy("tree")
    ahead = whole.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "range_id", F.coalesce(F.sum("here").over(ahead), F.lit(0)).alias("start"), F.sum("here").over(whole).alias("size")
    )
    within = F.row_number().over(Window.partitionBy("tree", "range_id").orderBy(*order))
    numbered = ranges.withColumn("within", within).join(starts, ["tree", "range_id"])
    return numbered.withColumn("rank", (F.col("start") + F.col("within") - 1).cast("long")).drop("range_id", "within", "start")


def _next_level(nodes: str) -> str:
    """SQL of the level above an array of digests."""
    return (
        f"transform(sequence(0, (size({nodes}) + 1) div 2 - 1), i -> unhex(sha2(cast(concat("
        f"lower(hex({nodes}[2 * i])), coalesce(lower(hex(get({nodes}, 2 * i + 1))), '')) as binary), 256)))"
    )


def _grow(nodes: DataFrame, purpose: str) -> tuple[DataFrame | None, DataFrame]:
    """Records above ``nodes`` (``tree``, ``rank``, ``size``, ``digest``) and the root of each tree.

    A round lifts every tree by one digit. Trees of one node are done.
    """
    records, roots = [], []
    most = nodes.agg(F.max("size")).first()[0] or 0
    nodes = nodes.select("tree", "rank", "size", "digest", F.lit(0).alias("height"))
    while True:
        roots.append(nodes.filter("size = 1").select("tree", "digest", "height"))
        if most <= 1:
            break
        runs = (
            nodes.filter("size > 1")
            .groupBy("tree", "size", "height", F.shiftright("rank", DIGIT_BITS).alias("above"))
            .agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run"))
            .withColumn("steps", F.least(F.lit(DIGIT_BITS), F.length(F.bin(F.col("size") - 1))))
            .withColumn("level0", F.col("run.digest"))
        )
        for k in range(DIGIT_BITS):
            runs = runs.withColumn(f"level{k + 1}", F.expr(f"if(steps > {k}, {_next_level(f'level{k}')}, level{k})"))
        below = F.array(*[f"level{k}" for k in reversed(range(DIGIT_BITS))])
        lifted = runs.select(
            "tree",
            F.col("above").alias("rank"),
            F.expr(f"shiftright(size - 1, {DIGIT_BITS}) + 1").alias("size"),
            F.col(f"level{DIGIT_BITS}")[0].alias("digest"),
            (F.col("height") + F.col("steps")).alias("height"),
            # the levels of a shorter tree come last in the array
            F.slice(below, F.lit(DIGIT_BITS + 1) - F.col("steps"), F.col("steps")).alias("levels"),
        )
        lifted = cut_lineage(lifted, f"{purpose}-{len(records)}")
        records.append(lifted.select("digest", "height", "levels"))
        nodes = lifted.drop("levels")
        most = ((most - 1) >> DIGIT_BITS) + 1
    all_records = None
    for r in records:
        all_records = r if all_records is None else all_records.unionByName(r)
    all_roots = roots[0]
    for r in roots[1:]:
        all_roots = all_roots.unionByName(r)
    return all_records, all_roots


def build(
    docs: DataFrame,
    leaf: Column | None = None,
    group: str = "lang",
    order: str = "doc_id",
    **carry: Column,
) -> Manifest:
    """The manifest of ``docs``; ``leaf`` is the hexadecimal digest of a row, by default over ``LEAF_COLUMNS``.

    Groups go by the UTF-8 bytes of their name, null first, and are groups of their own however written. Leaves go by
    ``order``, null first; ties by digest, then by the stored row, and equal rows are leaves of their own. Texts may be
    empty, null or of any length: only digests are shuffled. ``carry`` columns come along in ``leaves``. An empty table
    has no root.
    """
    leaf = leaf_digest([F.col(f"`{c}`") for c in LEAF_COLUMNS]) if leaf is None else leaf
    name = F.col(f"`{group}`").cast("string")
    # a stored number for each row; its texts stay behind
    rows = stored_rows(
        docs.select(
            F.when(name.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), name)).alias("tree"),
            F.col(f"`{order}`").alias("order"),
            F.unhex(leaf).alias("leaf"),
            *[c.alias(k) for k, c in carry.items()],
        ),
        "merkle-rows",
    ).select("row_id", "row.*")
    leaves = _ranked(rows, ["order", "leaf", "row_id"], "merkle-order").withColumnRenamed("size", "leaves_in_tree")
    leaves = cut_lineage(leaves, "merkle-leaves")
    records, roots = _grow(leaves.select("tree", "rank", F.col("leaves_in_tree").alias("size"), F.col("leaf").alias("digest")), "merkle-groups")
    tops = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "height")
    tops = cut_lineage(_ranked(tops, ["name"], "merkle-tops"), "merkle-roots")
    above, root = _grow(tops.select("tree", "rank", "size", "digest"), "merkle-root")
    roots = tops.select(F.col("name").alias("tree"), "digest", "height", "rank")
    records = records if above is None else above if records is None else records.unionByName(above)
    if records is None:
        no_levels = F.array().cast("array<array<binary>>")
        records = roots.select("digest", "height", no_levels.alias("levels")).limit(0)
    # equal rows have equal nodes above them, and those one record
    records = cut_lineage(records.dropDuplicates(["digest", "height"]), "merkle-records")
    return Manifest(leaves, records, roots, root.select("digest", "height"))


def _descend(records: DataFrame, front: DataFrame, carried: list[str], highest: int, wanted: DataFrame | None, purpose: str) -> DataFrame:
    """From nodes ``front`` (``carried``, ``rank``, ``digest``, ``height``, ``path``) down to height 0, a digit a round.

    ``highest`` bounds the height. With ``wanted`` (``carried``, ``rank``) only nodes above a wanted rank are followed.
    A path lists the siblings from the top; a level without one has a null.
    """
    down = []
    while True:
        down.append(front.filter("height = 0"))
        if highest <= 0:
            break
        # the top record of a tree may span fewer levels; those below it all span a whole digit
        spanned = F.col("height") - F.floor((F.col("height") - 1) / DIGIT_BITS) * DIGIT_BITS
        found = front.filter("height > 0").join(records, ["digest", "height"]).withColumn("steps", spanned.cast("int"))
        step = F.expr(
            "inline(transform(sequence(0, size(levels[steps - 1]) - 1), d -> struct("
            "d, levels[steps - 1][d] as child, transform(sequence(1, steps), k -> if("
            "isnull(get(levels[k - 1], shiftright(d, steps - k) ^ 1)), null, struct("
            "get(levels[k - 1], shiftright(d, steps - k) ^ 1) as digest, "
            "(shiftright(d, steps - k) & 1) = 1 as left))) as passed)))"
        )
        front = found.select(*carried, "rank", "height", "steps", "path", step).select(
            *carried,
            F.expr("shiftleft(rank, steps) + d").alias("rank"),
            F.col("child").alias("digest"),
            (F.col("height") - F.col("steps")).alias("height"),
            F.concat("path", "passed").alias("path"),
        )
        if wanted is not None:
            above = wanted.join(front.select(*carried, "height").distinct(), carried)
            above = above.select(*carried, "height", F.expr("shiftright(rank, height)").alias("rank")).distinct()
            front = front.join(above, [*carried, "height", "rank"], "left_semi")
        front = cut_lineage(front, f"{purpose}-{len(down)}")
        highest = (highest - 1) // DIGIT_BITS * DIGIT_BITS
    out = down[0]
    for more in down[1:]:
        out = out.unionByName(more)
    return out


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """For each requested leaf (``tree``, ``rank``; by default all) its digest and ``proof``, from the leaf to the root.

    A step of a proof is null where the node has no sibling, else ``digest`` and ``left`` (whether it comes first).
    Requests for leaves that are not there give no rows, repeated ones a single row.
    """
    tall = manifest.roots.agg(F.max("height")).first()[0]
    path = F.array().cast("array<struct<digest:binary,left:boolean>>")
    start = manifest.root.select(F.lit(0).cast("long").alias("rank"), "digest", "height", path.alias("path"))
    top_height = manifest.root.agg(F.max("height")).first()[0]
    tops = _descend(manifest.records, start, [], top_height or 0, None, "merkle-to-groups")
    groups = tops.drop("height").join(manifest.roots.drop("digest"), "rank")
    front = groups.select("tree", F.lit(0).cast("long").alias("rank"), "digest", "height", "path")
    if requests is not None:
        requests = cut_lineage(requests.select("tree", F.col("rank").cast("long").alias("rank")).distinct(), "merkle-requests")
        front = front.join(requests.select("tree").distinct(), "tree", "left_semi")
    found = _descend(manifest.records, front, ["tree"], tall or 0, requests, "merkle-descent")
    if requests is not None:  # a tree of one leaf is not looked into
        found = found.join(requests, ["tree", "rank"], "left_semi")
    return found.select("tree", "rank", "digest", F.reverse("path").alias("proof"))


def fold(leaf: Column, proof: Column) -> Column:
    """The hexadecimal digest of the root that ``leaf`` (hexadecimal) and its ``proof`` lead to."""

    def step(under: Column, sibling: Column) -> Column:
        other = F.coalesce(F.lower(F.hex(sibling["digest"])), F.lit(""))
        pair = F.when(sibling["left"], F.concat(other, under)).otherwise(F.concat(under, other))
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """One digest over all siblings of a proof."""
    siblings = F.transform(F.filter(proof, lambda s: s.isNotNull()), lambda s: F.lower(F.hex(s["digest"])))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def hex_digest(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def audit(docs: DataFrame, tampered: Column, changed: list[Column]) -> DataFrame:
    """Every row's proof, and what it leads to after a change.

    ``changed`` are the leaf's values where ``tampered`` holds. Returns ``doc_id``, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root`` (from the changed leaf and the original siblings) and ``verified``.
    """
    other = F.when(tampered, F.unhex(leaf_digest(changed)))
    manifest = build(docs, doc_id=F.col("doc_id"), changed=other)
    found = manifest.leaves.join(proofs(manifest).drop("digest"), ["tree", "rank"])
    roots = manifest.roots.select("tree", F.col("digest").alias("subroot"))
    root = manifest.root.select(hex_digest(F.col("digest")).alias("root")).first()
    found = found.join(roots, "tree")
    leaf = hex_digest(F.col("leaf"))
    told = found.select(
        "doc_id",
        leaf.alias("leaf"),
        hex_digest(F.col("subroot")).alias("subroot"),
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        proof_digest(F.col("proof")).alias("proof_sha256"),
        fold(F.coalesce(hex_digest(F.col("changed")), leaf), F.col("proof")).alias("folded_root"),
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
