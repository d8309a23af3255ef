import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
import helpers as h  # noqa: E402
from tallycast.llm import minhash, toxicity  # noqa: E402

INSULTS = "grobnik flarn zutwurz kleebal".split()
FOLDER = "/root/testdata/sf0.001"


def corpus(n=500):
    r = random.Random(8)
    rows, toxic = [], {}
    for k in range(n):
        words = h.prose(1000 + k, 60).split()
        bad = r.random() < 0.2
        if bad:
            for w in r.sample(INSULTS, 2):
                words.insert(r.randrange(60), w + r.choice(["", "s", "!"]))
        rows.append((k, " ".join(words), "s"))
        toxic[k] = int(bad)
    return rows, toxic


def test_held_out_labels_are_found(spark):
    rows, toxic = corpus()
    rows += [(900, "", "s"), (901, None, "s"), (None, "grobnik flarn", "s"), (5, "the id again", "s")]
    docs = h.table(spark, rows)
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    label = lambda flip: spark.createDataFrame([(i, 1 - t if flip and out(i) else t, 1) for i, t in toxic.items()] + [(None, 1, 1), (7, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, label(False))
    got = toxicity.score_table(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and out(r["doc_id"])) for r in got)
    judged = [(toxic[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged) and sum(a for a, _ in judged) > 10
    assert all(not r["predicted"] for r in got if r["doc_id"] in (900, 901))
    again = toxicity.score_table(docs, toxicity.fit(docs, label(True))).collect()
    assert sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in again) == sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in got)
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns and left.count() == sum(not r["predicted"] for r in got)


def test_moments_are_those_of_all_texts(spark):
    r = np.random.default_rng(5)
    n = 5 + len(toxicity.PATTERNS)
    votes = np.unique(r.random((800, n)) < 0.3, axis=0).astype(float)
    count = r.integers(1, 9, len(votes))
    model = toxicity.LabelModel(np.linspace(0.2, 0.6, n), np.linspace(0.05, 0.3, n), 0.2)
    table = [(bytearray(np.packbits(v.astype(np.uint8)).tobytes()), int(c)) for v, c in zip(votes, count)]
    want = np.zeros((2, n + 1, n + 1))
    # text by text, pair of votes by pair of votes
    for v, c in zip(votes, count):
        odds = np.log(0.2 / 0.8) + sum(np.log(model.rate1[k] / model.rate0[k]) for k in range(n) if v[k])
        odds += 0 if v[model.any] else np.log((1 - model.rate1[model.any]) / (1 - model.rate0[model.any]))
        toxic = 1 / (1 + np.exp(-odds))
        fired = [*np.flatnonzero(v), n]
        for i in fired:
            for j in fired:
                want[0, i, j] += c * toxic
                want[1, i, j] += c * (1 - toxic)
    patterns = spark.createDataFrame(table, "votes binary, n long")
    for parts in (1, 7):
        got = toxicity._summed(patterns.repartition(parts), toxicity._expected(model, n), (2, n + 1, n + 1))
        assert np.allclose(got, want)
    nothing = toxicity._summed(patterns.limit(0), toxicity._expected(model, n), (2, n + 1, n + 1))
    assert not nothing.any()


def test_distributed_steps_are_those_of_one_table(spark):
    r = np.random.default_rng(4)
    n = 4 + len(toxicity.PATTERNS)
    votes = np.unique(r.random((3000, n)) < 0.3, axis=0).astype(float)
    count = r.integers(1, 9, len(votes)).astype(float)
    count[0] = 5 * count.sum()  # one pattern holds most of the texts
    model = toxicity.LabelModel(np.linspace(0.2, 0.6, n), np.linspace(0.05, 0.3, n), 0.2)
    table = [(bytearray(np.packbits(v.astype(np.uint8)).tobytes()), int(c)) for v, c in zip(votes, count)]
    got = toxicity._fit_patterns(spark.createDataFrame(table, "votes binary, n long").repartition(3), model, n)
    want = toxicity._fit_linear(votes, count, model.posterior(votes))
    assert np.allclose(got[0], want[0], atol=1e-6) and abs(got[1] - want[1]) < 1e-6


def test_capitals_are_looked_for_in_the_whole_text():
    votes = lambda t: toxicity.Voters([]).votes(t)[toxicity.PATTERNS.index("capitals")]
    assert votes("1" * 2000 + " THIS IS ALL IN CAPITAL LETTERS") and votes(" " * 50_000 + "A" * 21)
    assert not votes("1" * 2000 + "A" * 20) and not votes("a" + "A" * 3000) and not votes("1" * 30)


def test_every_term_with_evidence_votes(spark):
    words = [f"{chr(97 + k // 26)}{chr(97 + k % 26)}" + "xyzvw"[k % 5] * 2 for k in range(650)]  # no form of one is in another
    counts = spark.createDataFrame([(f"={w}", 20 + k // 10, 0) for k, w in enumerate(words)] + [("=rare", 3, 0), ("=even", 50, 900)], "term string, toxic long, clean long")
    lexicon = toxicity._lexicon(counts, 1000, 9000)
    assert sorted(str(t) for own in lexicon for t in (own if isinstance(own, list) else [own["term"]])) == sorted(f"={w}" for w in words)
    assert len(lexicon) == toxicity.OWN_VOTERS + toxicity.SHARED_VOTERS
    voters = toxicity.Voters(lexicon)
    assert all(voters.votes(w)[: len(lexicon)].sum() == 1 for w in words) and not voters.votes("rare even").any()


def test_without_labels(spark):
    docs = h.table(spark, corpus(20)[0])
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, none)
    assert toxicity.drop_toxic(docs, model).count() == 20
    assert toxicity.score_table(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, FOLDER).cache()
    assert clean.columns == docs.columns and 0.7 * docs.count() <= clean.count() <= docs.count()
    single = stages["exact dedup"](spark, clean, FOLDER).cache()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    normal = lambda t: " ".join(t.split(" ")) if t.isspace() else __import__("re").sub(r"[\x20\x09-\x0d]+", " ", t)
    first = {}
    for i in sorted(texts):
        first.setdefault(normal(texts[i]), i)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(first.values())
    near = stages["near dedup"](spark, single, FOLDER).cache()
    ids = sorted(first.values())
    sets = [h.shingles(texts[i], 5) for i in ids]
    links = [(a, b) for b in range(len(ids)) for a in range(b) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({ids[k] for k in h.classes(len(ids), links)})
    mixed = stages["mix"](spark, near, FOLDER).cache()
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= {r["doc_id"] for r in near.collect()}
    ends = stages["encode"](spark, mixed, FOLDER)
    assert ends.count() == mixed.count() and ends.filter("NOT round_trip").count() == 0


def test_stages_on_empty_tables(spark):
    if not Path(FOLDER).exists():
        pytest.skip("test tables are not here")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_repeated_rows_in_a_stage(spark):
    rows = [(1, h.prose(1, 50), "s")] * 3 + [(None, h.prose(2, 50), "s")] * 2 + [(4, None, "s")] * 2
    left = minhash.drop_near_copies(h.table(spark, rows)).select(F.col("doc_id"), "text")
    assert sorted((r[0] or 0) for r in left.collect()) == [0, 1, 4, 4]
