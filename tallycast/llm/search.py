"""Ranked lexical search over bit-sliced Bloom signatures.

The index keeps documents in blocks. A block is a matrix of bits with a column for each document; a term switches on
three rows of its column, and further ones for each level its frequency reaches. Read by rows, the three slices of a
term, taken together, are the documents that may hold it: all that do and a few that do not. Slices weighted by the
terms' weights and summed level by level give for every document a score that the true one cannot exceed.

A search takes the documents with the highest bounds first and scores them exactly; the k-th of these scores is what a
document must reach. All documents whose bound reaches it are then scored exactly from their texts, so the result is
that of scoring every document. Queries are worked off in batches of bounded size.

Blocks hold documents with about as many terms each, so their density is the same at every length.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.llm.common import numbered
from tallycast.llm.words import Words, hash_words, in_byte_slices, mix
from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Frequencies from which a term has one level more.
LEVELS = np.array([1, 2, 3] + [(1 << k) + 1 for k in range(2, 14)])
#: Rows per set bit of the fullest column a block may have, and bits a term sets at each level.
ROWS_PER_BIT, HASHES = 8, 3
#: Documents of a block, and set bits after which it is closed before.
BLOCK_DOCUMENTS, BLOCK_BITS = 4096, 1 << 19
#: Terms a task holds before it passes their document counts on.
HELD_TERMS = 1 << 19
#: Queries of a batch, and their terms altogether.
BATCH_ITEMS, BATCH_TERMS = 256, 16_384
#: Documents with the highest bounds that are scored first, for each result asked for.
SEEDS = 4
#: Cells of (query, term, document) that are summed at once.
CELLS = 1 << 20

_INDEX = "blocks array<long>, sizes array<long>, width int, top int, bits binary, term long, df long, n_docs long, n_terms long"
_INDEX_ARROW = pa.schema(
    [("blocks", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("width", pa.int32()), ("top", pa.int32()), ("bits", pa.binary())]
    + [(k, pa.int64()) for k in ("term", "df", "n_docs", "n_terms")]
)


def _level_hash(terms: np.ndarray, level: int) -> np.ndarray:
    return mix(terms + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))


def _slots(hashes: np.ndarray, width: int) -> list[np.ndarray]:
    """The rows of a matrix of ``width`` rows, a power of two, that a hash switches on."""
    return [((hashes >> np.uint64(21 * k)) & np.uint64(width - 1)).astype(np.int64) for k in range(HASHES)]


def term_frequencies(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and frequency of the distinct terms of each text, by text and hash."""
    ordered = words.hashes.copy()
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        ordered[a:b].sort()
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    new[words.first[:-1][words.counts > 0]] = True
    at = np.flatnonzero(new)
    return np.searchsorted(words.first, at, "right") - 1, ordered[at], np.diff(np.append(at, len(ordered)))


def _summed(terms: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, n = np.concatenate(terms), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    at = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    return every[at], np.add.reduceat(n, at) if len(at) else n


class _Block:
    """Documents of one length class until they fill a block."""

    def __init__(self, width: int):
        self.width, self.rows, self.sizes, self.top, self.held, self.cells = width, [], [], 0, 0, []

    def add(self, rows: np.ndarray, sizes: np.ndarray, columns: np.ndarray, hashes: np.ndarray, top: int) -> None:
        self.cells.append((columns + len(self.rows), hashes))
        self.rows += rows.tolist()
        self.sizes += sizes.tolist()
        self.top, self.held = max(self.top, top), self.held + len(hashes)

    def row(self) -> tuple:
        matrix = np.zeros((self.width, len(self.rows)), bool)
        for columns, hashes in self.cells:
            for slots in _slots(hashes, self.width):
                matrix[slots, columns] = True
        return self.rows, self.sizes, self.width, self.top, np.packbits(matrix, axis=1).tobytes(), None, None, None, None


def _index_rows(batches):
    """Blocks, document counts of terms, and totals of a task's texts, with the number of the row as the first column."""
    open_blocks: dict[int, _Block] = {}
    terms: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    held = n_docs = n_terms = 0

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_ARROW.types)], schema=_INDEX_ARROW)

    def dictionary():
        every, n = _summed(terms, counts)
        none = [pa.nulls(len(every), t) for t in _INDEX_ARROW.types]
        none[5], none[6] = pa.array(every.view(np.int64)), pa.array(n.astype(np.int64))
        return pa.RecordBatch.from_arrays(none, schema=_INDEX_ARROW)

    for part in in_byte_slices(batches, 1):
        rows, words = part.column(0).to_numpy(), hash_words(part.column(1))
        n_docs += int((words.counts > 0).sum())
        n_terms += len(words.hashes)
        doc, term, tf = term_frequencies(words)
        if not len(term):
            continue
        terms.append(term), counts.append(np.ones(len(term), np.int64))
        held += len(term)
        if held > 2 * HELD_TERMS:
            some, n = _summed(terms, counts)
            terms, counts, held = [some], [n], len(some)
            if held > HELD_TERMS:
                yield dictionary()
                terms, counts, held = [], [], 0
        level = np.searchsorted(LEVELS, tf, "right")
        cells = [(doc[reach], _level_hash(term[reach], k), reach) for k in range(1, int(level.max()) + 1) if len(reach := np.flatnonzero(level >= k))]
        columns, hashes = np.concatenate([c[0] for c in cells]), np.concatenate([c[1] for c in cells])
        filled = np.bincount(columns, minlength=len(rows))
        kind = np.ceil(np.log2(np.maximum(filled, 16))).astype(int)
        top = np.zeros(len(rows), np.int64)
        np.maximum.at(top, doc, level)
        for k in np.unique(kind[filled > 0]).tolist():
            chosen = np.flatnonzero((kind == k) & (filled > 0))
            inside = kind[columns] == k
            block = open_blocks.setdefault(k, _Block(ROWS_PER_BIT << k))
            # documents in portions, so that no block outgrows its bounds by more than one
            own_columns, own_hashes = columns[inside], hashes[inside]
            reach = np.cumsum(filled[chosen])
            at = 0
            while at < len(chosen):
                room = max(BLOCK_BITS - block.held, 0) + (reach[at - 1] if at else 0)
                stop = min(max(int(np.searchsorted(reach, room, "right")), at + 1), at + BLOCK_DOCUMENTS - len(block.rows), len(chosen))
                place = np.full(len(rows), -1)
                place[chosen[at:stop]] = np.arange(stop - at)
                mine = place[own_columns] >= 0
                block.add(rows[chosen[at:stop]], words.counts[chosen[at:stop]], place[own_columns[mine]], own_hashes[mine], int(top[chosen[at:stop]].max()))
                at = stop
                if block.held >= BLOCK_BITS or len(block.rows) >= BLOCK_DOCUMENTS:
                    yield table([block.row()])
                    block = open_blocks[k] = _Block(ROWS_PER_BIT << k)
    for block in open_blocks.values():
        if block.rows:
            yield table([block.row()])
    if terms:
        yield dictionary()
    if n_docs:
        yield table([(None,) * 7 + (n_docs, n_terms)])


@dataclass
class Index:
    """``rows``: ``row_id``, ``doc_id``, ``text``. ``blocks``: signatures. ``dictionary``: ``term`` and ``df``. Totals."""

    rows: DataFrame
    blocks: DataFrame
    dictionary: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index every row of ``docs``; texts are read whole. Null and wordless texts have no terms and are in no block."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    rows = cut_lineage(rows, "search-rows")
    made = cut_lineage(rows.select("row_id", "text").mapInArrow(_index_rows, _INDEX), "search-index")
    totals = made.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    dictionary = made.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))
    blocks = made.filter("bits IS NOT NULL").select("blocks", "sizes", "width", "top", "bits")
    return Index(rows, blocks, cut_lineage(dictionary, "search-terms"), totals[0] or 0, totals[1] or 0)


def _length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 50 + (50 * n_docs * n.astype(np.int64)) // n_terms


def _share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term with frequency ``tf`` adds to the score, for each unit of its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Batch:
    """Queries with their terms and weights."""

    def __init__(self, rows: list):
        self.items = [r["query"] for r in rows]
        lengths = [len(r["terms"]) for r in rows]
        self.starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        hashes = np.array([t["term"] for r in rows for t in r["terms"]], np.int64).view(np.uint64)
        self.weights = np.array([t["weight"] for r in rows for t in r["terms"]], np.int64)
        self.terms, self.places = np.unique(hashes, return_inverse=True)

    def bounds(self, sizes: np.ndarray, width: int, top: int, bits: bytes, n_docs: int, n_terms: int) -> np.ndarray:
        """(query, document): a score that the document's cannot exceed."""
        slices = np.frombuffer(bits, np.uint8).reshape(width, -1)
        m = _length_factor(sizes, n_docs, n_terms)
        out = np.zeros((len(self.items), len(sizes)), np.int64)
        before, present = np.zeros(len(sizes), np.int64), None
        for level in range(1, top + 1):
            a, b, c = _slots(_level_hash(self.terms, level), width)
            here = slices[a] & slices[b] & slices[c]
            present = here if present is None else present & here  # a level is reached only after those below it
            most = np.minimum(sizes, LEVELS[level] - 1) if level < len(LEVELS) else sizes
            share = _share(most, m)
            used = present.any(axis=1)
            if not used.any():
                break
            self._add_level(out, present, used, share - before)
            before = share
        return out

    def _add_level(self, out: np.ndarray, present: np.ndarray, used: np.ndarray, gain: np.ndarray) -> None:
        """Add to ``out`` the weighted sum of the slices of each query, times ``gain`` of the documents."""
        kept = np.flatnonzero(used[self.places])
        query = np.searchsorted(self.starts, kept, "right") - 1
        n = out.shape[1]
        at, step = 0, max(CELLS // n, 1)
        while at < len(kept):
            stop = min(at + step, len(kept))
            rows = np.unpackbits(present[self.places[kept[at:stop]]], axis=1, count=n).astype(np.int32)
            rows *= self.weights[kept[at:stop], None].astype(np.int32)
            begins = np.flatnonzero(np.append(True, query[at + 1 : stop] != query[at : stop - 1]))
            out[query[at:stop][begins]] += np.add.reduceat(rows, begins, axis=0, dtype=np.int64) * gain
            at = stop


def _highest_bounds(batch, count: int, n_docs: int, n_terms: int):
    """For each query the ``count`` rows of a task with the highest bounds."""

    def run(batches):
        queries = batch.value
        best = np.zeros((len(queries.items), count), np.int64)
        rows = np.full(best.shape, -1, np.int64)
        for part in batches:
            for block in part.to_pylist():
                sizes = np.array(block["sizes"], np.int64)
                bounds = queries.bounds(sizes, block["width"], block["top"], block["bits"], n_docs, n_terms)
                every = np.concatenate([best, bounds], axis=1)
                names = np.concatenate([rows, np.broadcast_to(np.array(block["blocks"], np.int64), bounds.shape)], axis=1)
                chosen = np.argpartition(every, every.shape[1] - count, axis=1)[:, -count:]
                best, rows = np.take_along_axis(every, chosen, 1), np.take_along_axis(names, chosen, 1)
        query, place = np.nonzero(best)
        columns = [pa.array(query, pa.int32()), pa.array(rows[query, place]), pa.array(best[query, place])]
        yield pa.RecordBatch.from_arrays(columns, ["query", "row_id", "bound"])

    return run


def _not_excluded(batch, least: list[int], n_docs: int, n_terms: int):
    """For each document the queries whose ``least`` score its bound reaches."""

    def run(batches):
        queries, needed = batch.value, np.array(least, np.int64)[:, None]
        for part in batches:
            for block in part.to_pylist():
                bounds = queries.bounds(np.array(block["sizes"], np.int64), block["width"], block["top"], block["bits"], n_docs, n_terms)
                doc, query = np.nonzero((bounds >= needed).T)
                found, begins = np.unique(doc, return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(doc)), pa.int32()), pa.array(query, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.array(block["blocks"], np.int64)[found], pa.int64()), lists], ["row_id", "queries"])

    return run


def _exact_scores(batch, n_docs: int, n_terms: int):
    """Scores above 0 of texts (``row_id``, ``doc_id``, ``text``, ``queries``) for the queries listed with them."""

    def run(batches):
        queries = batch.value
        for part in in_byte_slices(batches, 2):
            words = hash_words(part.column(2))
            doc, term, tf = term_frequencies(words)
            place = np.searchsorted(queries.terms, term)
            place[place == len(queries.terms)] = 0
            known = queries.terms[place] == term
            doc, place, tf = doc[known], place[known], tf[known]
            reach = np.searchsorted(doc, np.arange(part.num_rows + 1))
            m = _length_factor(words.counts, n_docs, n_terms)
            frequency = np.zeros(len(queries.terms), np.int64)
            rows, ids = part.column(0).to_pylist(), part.column(1).to_pylist()
            out: list[tuple] = []
            for k, asked in enumerate(part.column(3).to_pylist()):
                own = slice(reach[k], reach[k + 1])
                frequency[place[own]] = tf[own]
                for q in asked:
                    terms = slice(queries.starts[q], queries.starts[q + 1])
                    score = int((queries.weights[terms] * _share(frequency[queries.places[terms]], m[k])).sum())
                    if score > 0:
                        out.append((q, rows[k], ids[k], score))
                frequency[place[own]] = 0
            if out:
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["query", "row_id", "doc_id", "score"])

    return run


def _query_terms(batches):
    for part in in_byte_slices(batches, 1):
        words = hash_words(part.column(1))
        doc, term, _ = term_frequencies(words)
        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc)), pa.array(term.view(np.int64))], ["query_row", "term"])


def _weighted_queries(index: Index, queries: DataFrame) -> DataFrame:
    """``query_row``, ``terms`` (those some document has, with weights) and ``batch``."""
    asked = cut_lineage(queries.select("query_row", "text").mapInArrow(_query_terms, "query_row long, term long"), "search-query-terms")
    n, df = F.lit(float(index.n_docs)), F.col("df").cast("double")
    weight = F.floor(F.log((n * 2 + 2) / (df * 2 + 1)) * 1000).cast("long")
    weights = asked.select("term").distinct().join(index.dictionary, "term").select("term", weight.alias("weight"))
    weighed = asked.join(cut_lineage(weights, "search-weights"), "term")
    listed = weighed.groupBy("query_row").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    listed = numbered(listed, "query_row", "search-queries", F.size("terms") + BATCH_TERMS // BATCH_ITEMS)
    return cut_lineage(listed.withColumn("batch", F.floor(F.col("position") / BATCH_TERMS).cast("long")).drop("position"), "search-batches")


def _best(order: list[Column], k: int, *by: str) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))


def search(index: Index, queries: DataFrame, k: int = 50, query_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The ``k`` documents with the highest scores above 0 for each row of ``queries``.

    Returns the query's ``item_id``, ``rank`` from 1, ``doc_id`` and ``score``. Equal scores go by ``doc_id``, null
    last, and rows of the same id by their stored row. Each row of ``queries`` is a query of its own, whether its id is
    null or repeated; one without terms, or with none that a document has, gives no rows. Each row of the index may be
    found, also several of one id or text. No documents or no queries give no rows.
    """
    spark = queries.sparkSession
    queries = queries.select(
        F.monotonically_increasing_id().alias("query_row"), F.col(f"`{query_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")
    )
    queries = cut_lineage(queries, "search-queries-read")
    totals = index.n_docs, index.n_terms
    weighted = _weighted_queries(index, queries)
    results = None
    for number in sorted(r["batch"] for r in weighted.select("batch").distinct().collect()):
        # at most BATCH_ITEMS queries, and BATCH_TERMS terms beside those of the last query
        rows = weighted.filter(F.col("batch") == number).orderBy("query_row").collect()
        batch = spark.sparkContext.broadcast(Batch([{"query": r["query_row"], "terms": r["terms"]} for r in rows]))
        scored = _search_batch(index, batch, len(rows), k, totals)
        found = cut_lineage(scored.withColumn("batch", F.lit(number)), "search-found")
        results = found if results is None else results.unionByName(found)
    if results is None:
        empty = queries.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
        return empty.limit(0)
    place = F.row_number().over(Window.partitionBy("batch").orderBy("query_row")) - 1
    names = weighted.select("batch", "query_row", place.alias("query")).join(queries.select("query_row", "item_id"), "query_row")
    return results.join(names, ["batch", "query"]).select("item_id", "rank", "doc_id", "score")


def _search_batch(index: Index, batch, n_queries: int, k: int, totals: tuple[int, int]) -> DataFrame:
    scores = "query int, row_id long, doc_id long, score long"
    high = index.blocks.mapInArrow(_highest_bounds(batch, SEEDS * k, *totals), "query int, row_id long, bound long")
    high = high.withColumn("place", _best([F.desc("bound"), F.col("row_id")], SEEDS * k, "query")).filter(F.col("place") <= SEEDS * k)
    seeds = cut_lineage(high.groupBy("row_id").agg(F.collect_list("query").alias("queries")), "search-seeds")
    # at most SEEDS * k rows for each query of a batch
    first = index.rows.join(F.broadcast(seeds), "row_id").select("row_id", "doc_id", "text", "queries")
    first = first.mapInArrow(_exact_scores(batch, *totals), scores)
    reached = first.withColumn("place", _best([F.desc("score")], k, "query")).filter(F.col("place") == k)
    least = [1] * n_queries
    for r in reached.select("query", "score").collect():  # one row a query
        least[r["query"]] = max(r["score"], 1)
    open_rows = cut_lineage(index.blocks.mapInArrow(_not_excluded(batch, least, *totals), "row_id long, queries array<int>"), "search-open")
    texts = index.rows.join(open_rows, "row_id").select("row_id", "doc_id", "text", "queries")
    scored = texts.mapInArrow(_exact_scores(batch, *totals), scores)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("row_id")]
    return scored.withColumn("rank", _best(order, k, "query")).filter(F.col("rank") <= k).drop("row_id")
