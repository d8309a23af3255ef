"""The manifest, decontamination and ranked search against plain Python on small awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallycast.llm import decontaminate, merkle, search, words
from tests.llm.helpers import CLASHING, COLUMNS, awkward, ordered, prose, rows_of, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- words --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("at_once", [7, 20, 2 << 20])
def test_words_of_a_column(monkeypatch, at_once):
    monkeypatch.setattr(words, "BYTES_AT_ONCE", at_once)
    r = random.Random(at_once)
    for _ in range(60):
        texts = [None if r.random() < 0.1 else "".join(r.choice("abZ9 é\n-日longlonglong_\x7f ") for _ in range(r.randint(0, 60))) for _ in range(r.randint(0, 8))]
        skip = r.randint(0, len(texts))
        found = words.hash_words(pa.array(texts, pa.string()).slice(skip))
        expected = [lowered(t) for t in texts[skip:]]
        assert found.counts.tolist() == [len(e) for e in expected]
        flat = [w for e in expected for w in e]
        assert [found.data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)] == flat
        hashes = {}
        for w, h in zip(flat, found.hashes.tolist()):
            assert hashes.setdefault(w, h) == h
        assert len(set(hashes.values())) == len(hashes)


def test_very_long_words_differ():
    texts = ["x" * 5000, "x" * 4999 + "y", "x" * 1024, "x" * 1025]
    assert len(set(words.hash_words(pa.array(texts)).hashes.tolist())) == 4


# --- manifest -----------------------------------------------------------------------------------------------


def framed(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[k : k + 2])) for k in range(0, len(last), 2)])
    return levels


def siblings_in(levels, rank):
    """(sibling or None, whether it comes first), from the leaf."""
    out = []
    for nodes in levels[:-1]:
        other = rank ^ 1
        out.append((nodes[other] if other < len(nodes) else None, rank % 2 == 1))
        rank >>= 1
    return out


def audited(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    leaves = {}
    for r in rows:
        i, t, lang, source, n = r
        leaf = framed(i, source, lang, n, t)
        hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
        other = framed(i, source, lang, None if n is None else n + 1, t) if hit else leaf
        leaves.setdefault(lang, []).append((i, leaf, other))
    trees, tops = {}, []
    for lang in sorted(leaves, key=lambda v: (v is not None, (v or "").encode())):
        leaves[lang].sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
        trees[lang] = levels_over([v[1] for v in leaves[lang]]), len(tops)
        tops.append(trees[lang][0][-1][0])
    above = levels_over(tops)
    out = []
    for lang, group in leaves.items():
        tree, top = trees[lang]
        for rank, (i, leaf, other) in enumerate(group):
            path = siblings_in(tree, rank) + siblings_in(above, top)
            folded = other
            for sibling, first in path:
                folded = sha((sibling or "") + folded if first else folded + (sibling or ""))
            proof = sha("".join(s for s, _ in path if s))
            out.append((i, leaf, tree[-1][0], above[-1][0], proof, folded, folded == above[-1][0]))
    return ordered(out)


def manifest_query(docs):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    return merkle.audit(docs, tampered, [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.LEAF_COLUMNS])


def with_langs(spark, rows, langs=("de", None, "", "日本", "a-b")):
    r = random.Random(5)
    rows = [(i, t, r.choice(langs), s, None if r.random() < 0.2 else len(t or "")) for i, t, s in rows]
    docs = spark.createDataFrame(rows, COLUMNS)
    return rows, docs.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate([*CLASHING, "leaf", "tree", "digest", "levels"])])


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_proofs_of_every_row(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle, "DIGIT_BITS", bits)
    rows, docs = with_langs(spark, awkward() + [(100 + k, f"t {k}", "s1") for k in range(30)])
    assert rows_of(manifest_query(docs.repartition(3))) == audited(rows)


def test_one_group_one_row_and_none(spark):
    for some in ([(3, "only", "s")], [(k, "x", None) for k in range(65)], []):
        rows, docs = with_langs(spark, some, ["en"])
        assert rows_of(manifest_query(docs)) == audited(rows) if rows else manifest_query(docs).count() == 0


def test_equal_rows_are_leaves_of_their_own(spark):
    rows, docs = with_langs(spark, [(7, "same", "s")] * 150, [None])
    rows = [(*r[:4], 4) for r in rows]
    docs = docs.withColumn("n_chars", F.lit(4).cast("long"))
    got = rows_of(manifest_query(docs))
    assert got == audited(rows) and len(got) == 150


def test_requested_leaves_only(spark, tmp_path):
    rows, docs = with_langs(spark, [(k, f"text {k}", "s") for k in range(200)])
    manifest = merkle.build(docs)
    manifest.write(str(tmp_path / "manifest"))
    manifest = merkle.Manifest.read(spark, str(tmp_path / "manifest"))
    everything = {(r["tree"], r["rank"]): (r["digest"], r["proof"]) for r in merkle.proofs(manifest).collect()}
    assert len(everything) == 200
    asked = [*random.Random(2).sample(sorted(everything), 7), ("1de", 10**6), ("none", 0)]
    requests = spark.createDataFrame([*asked, asked[0]], "tree string, rank long")
    found = {(r["tree"], r["rank"]): (r["digest"], r["proof"]) for r in merkle.proofs(manifest, requests).collect()}
    assert found == {k: everything[k] for k in asked[:7]}


# --- decontamination ----------------------------------------------------------------------------------------


def leaks(docs, items):
    windows = {}
    for item, text in items:
        w = lowered(text)
        n = min(len(w), 10)
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(item)
    out = []
    for i, text in docs:
        w = lowered(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (items_here := windows.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= items_here
        runs = [k for k in sorted(hit) if k - 1 not in hit], [k + 1 for k in sorted(hit) if k + 1 not in hit]
        out.append((i, len(w), str(list(zip(*runs))), str(sorted(str(x) for x in found if x is not None))))
    return ordered(out)


def found_leaks(docs, items):
    found, lists = decontaminate.contamination(docs, items)
    told = decontaminate.with_items(found, lists, F.col("items")).collect()
    # spans that only touch are one run in the plain version too
    return ordered([(r["doc_id"], r["n_words"], str([(s["start"], s["end"]) for s in r["spans"]]), str(r["items"] or [])) for r in told])


def planted(seed=3):
    r = random.Random(seed)
    items = [(k, prose(200 + k, n)) for k, n in enumerate([40, 25, 10, 11, 9, 4, 1, 12, 30])]
    items += [(20, items[0][1]), (20, prose(300, 15)), (None, prose(301, 20)), (21, None), (22, "-- ?!"), (23, items[1][1].upper().replace(" ", " -- "))]
    docs = [(i, t) for i, t, _ in awkward()]
    texts = [t for _, t in items if t]
    for k in range(40):
        body = prose(400 + k, 30)
        for _ in range(r.randint(0, 3)):
            w = r.choice(texts).split()
            a = r.randrange(len(w))
            body += " " + " ".join(w[a : a + r.randint(1, 20)]) + " ; " + prose(r.randint(0, 999), r.randint(1, 5))
        docs.append((500 + k, body))
    docs += [(600, texts[0]), (600, texts[0]), (601, " ".join(texts)), (602, "x" * 3000 + " " + texts[1]), (603, (texts[2] + " ") * 400)]
    return docs, items


def bench_table(spark, items):
    made = spark.createDataFrame(items, "item_id long, text string")
    return made.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(["item", "n", "set", "window", "print", "row_key"])])


def test_leaks_are_all_found(spark):
    docs, items = planted()
    got = found_leaks(table(spark, [(i, t, "s") for i, t in docs]).repartition(3), bench_table(spark, items))
    assert got == leaks(docs, items)


def test_few_filter_bits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 16)
    docs, items = planted(4)
    assert found_leaks(table(spark, [(i, t, "s") for i, t in docs]), bench_table(spark, items)) == leaks(docs, items)


def test_passage_that_most_documents_and_items_share(spark):
    shared = prose(900, 30)
    docs = [(k, f"{shared} {prose(k, 5)}" if k % 3 else prose(k, 20)) for k in range(60)]
    items = [(k, f"{prose(1000 + k, 3)} {shared}") for k in range(40)]
    assert found_leaks(table(spark, [(i, t, "s") for i, t in docs]), bench_table(spark, items)) == leaks(docs, items)


def test_no_items_or_no_documents(spark):
    docs, items = planted()
    none = bench_table(spark, items).limit(0)
    assert found_leaks(table(spark, [(i, t, "s") for i, t in docs]), none) == leaks(docs, [])
    assert found_leaks(table(spark, []), bench_table(spark, items)) == []


def test_every_shared_span_shares_a_fingerprint():
    r = random.Random(8)
    for _ in range(200):
        shared = [r.choice("abcdefgh") for _ in range(10)]
        texts = [" ".join([r.choice("abcdefgh") for _ in range(r.randint(0, 9))] + shared + [r.choice("abcdefgh") for _ in range(r.randint(0, 9))]) for _ in range(2)]
        prints = [set(decontaminate.fingerprints(words.hash_words(pa.array([t])), 10, 5)[1].tolist()) for t in texts]
        assert prints[0] & prints[1]


# --- ranked search ------------------------------------------------------------------------------------------


def ranked(docs, items, k):
    bags = [(i, Counter(lowered(t))) for i, t in docs]
    n_docs, length = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            if not b:
                continue
            m = 50 + (50 * sum(b.values()) * n_docs) // length
            score = sum(weight[t] * ((10**9 * b[t]) // (1000 * b[t] + 20 * m)) for t in set(lowered(text)) if b[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, place, None if none else i, -s) for place, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return ordered(out)


def ask(spark, docs, items, k):
    index = search.build_index(table(spark, [(i, t, "s") for i, t in docs]).repartition(3))
    return rows_of(search.search(index, bench_table(spark, items), k))


@pytest.mark.parametrize("seeds", [1, 4])
def test_search_equals_scoring_all(spark, monkeypatch, seeds):
    monkeypatch.setattr(search, "SEEDS", seeds)
    docs, items = planted(5)
    docs += [(700 + k, prose(700, 40)) for k in range(12)]  # ties
    for k in (3, 50):
        assert ask(spark, docs, items, k) == ranked(docs, items, k)


def test_small_blocks_and_batches(spark, monkeypatch):
    for name, value in (("BLOCK_DOCUMENTS", 5), ("BLOCK_BITS", 900), ("BATCH_TERMS", 64), ("BATCH_ITEMS", 2), ("HELD_TERMS", 50), ("CELLS", 40), ("ROWS_PER_BIT", 1)):
        monkeypatch.setattr(search, name, value)
    docs, items = planted(6)
    assert ask(spark, docs, items, 4) == ranked(docs, items, 4)


def test_bounds_are_never_below_the_score(monkeypatch):
    docs, items = planted(7)
    texts = pa.array([t for _, t in docs], pa.string())
    rows = pa.array(range(len(docs)), pa.int64())
    made = [b for b in search._index_rows([pa.record_batch([rows, texts], ["row_id", "text"])])]
    blocks = [r for b in made for r in b.to_pylist() if r["bits"] is not None]
    totals = next((r["n_docs"], r["n_terms"]) for b in made for r in b.to_pylist() if r["n_docs"])
    assert sorted(d for b in blocks for d in b["blocks"]) == [k for k, (_, t) in enumerate(docs) if lowered(t)]
    df = Counter(t for _, text in docs for t in set(lowered(text)))
    names = sorted({t for _, text in items for t in lowered(text)} & set(df))
    hashes = words.hash_words(pa.array(names)).hashes
    batch = search.Batch([{"query": 0, "terms": [{"term": int(h.astype("int64")), "weight": df[t]} for t, h in zip(names, hashes)]}])
    for b in blocks:
        bounds = batch.bounds(np.array(b["sizes"]), b["width"], b["top"], b["bits"], *totals)[0]
        for d, bound in zip(b["blocks"], bounds.tolist()):
            bag = Counter(lowered(docs[d][1]))
            m = 50 + (50 * sum(bag.values()) * totals[0]) // totals[1]
            assert bound >= sum(df[t] * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in names if bag[t])


def test_search_without_documents_or_queries(spark):
    docs, items = planted()
    assert ask(spark, [(1, None), (2, "?!")], items, 5) == []
    assert ask(spark, [], items, 5) == []
    assert ask(spark, docs, [], 5) == []
    assert ask(spark, docs, [(1, None), (2, ""), (3, "nowhere unheardof")], 5) == []
