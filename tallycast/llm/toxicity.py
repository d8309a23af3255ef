"""Toxicity by weak supervision.

Voters are lexicon terms (words, beginnings and ends of words) and patterns; each fires on a text or abstains. A
generative label model estimates from the votes over the whole corpus how often each voter fires on toxic and on clean
texts, and how voters go together within a class, so that voters that always fire as one do not count as many. Its
posterior labels train a linear classifier, which gives the scores.

Known labels choose the lexicon and anchor the label model; nothing but the text enters a score.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from tallycast.llm.common import in_slices
from tallycast.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Labelled rows the lexicon is chosen from, at most (in expectation).
LABELLED_SAMPLE = 20_000
#: In how many toxic texts a term must be, how much more often there than among clean ones, and how unlikely that is by
#: chance (log-likelihood ratio; some 10^5 terms are tried).
LEAST_TEXTS, LEAST_LIFT, LEAST_EVIDENCE = 4, 4.0, 22.0
#: All such terms vote: the most telling ones each by itself, the others in this many voters of terms of like lift.
OWN_VOTERS, SHARED_VOTERS = 480, 80
#: Vote patterns a task unpacks at once.
PATTERNS_AT_ONCE = 2_000
#: Rounds of the label model at most.
ROUNDS = 8
#: Scores from here on are toxic.
THRESHOLD = 0.3
#: Words or terms a task remembers.
HELD = 150_000

_EDGE = ".,;:!?\"'()[]{}<>*#$%&|/\\~`^_+=-"
_SHOUT = re.compile("!!|[?!]{3}")
#: Prefix and suffix lengths of lexicon terms.
_HEADS, _TAILS = (4, 5, 6), (5,)
PATTERNS = ("any", "two terms", "four terms", "dense terms", "shouting", "capitals")


def terms_of(word: str) -> list[str]:
    """The lexicon terms a lower-cased word stands for."""
    w = word.strip(_EDGE)
    if len(w) < 3:
        return []
    out = ["=" + w]
    out += ["^" + w[:k] for k in _HEADS if len(w) >= k]
    out += ["$" + w[-k:] for k in _TAILS if len(w) >= k]
    return out


@dataclass
class Model:
    """Lexicon (the terms of each voter), weights and base of the classifier."""

    terms: list[list[str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))
    base: float = -20.0


class Voters:
    """Votes of a lexicon and the patterns."""

    def __init__(self, terms: list[list[str]]):
        self.at = {t: k for k, own in enumerate(terms) for t in own}
        self.n = len(terms) + len(PATTERNS)
        self.known: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= HELD:
            self.known.clear()
        found = self.known[word] = tuple(self.at[t] for t in terms_of(word) if t in self.at)
        return found

    def votes(self, text: str | None) -> np.ndarray:
        out = np.zeros(self.n, np.uint8)
        words = set(text.lower().split()) if text else set()
        get, of, hits = self.known.get, self._of, 0
        for w in words:
            v = get(w)
            if v is None:
                v = of(w)
            if v:
                hits += 1
                for k in v:
                    out[k] = 1
        first = self.n - len(PATTERNS)
        out[first : first + 4] = hits > 0, hits > 1, hits > 3, 100 * hits >= max(1, len(words))
        if text:
            out[first + 4] = _SHOUT.search(text) is not None
            out[first + 5] = text.isupper() and sum(1 for _ in islice(filter(str.isalpha, text), 21)) > 20
        return out


def _term_counts(batches):
    """(term, toxic, clean): texts of a task's sample that have the term."""
    toxic, clean = Counter(), Counter()

    def out():
        terms = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_pydict({"term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms]})

    for batch in in_slices(batches):
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = {t for w in set((text or "").lower().split()) for t in terms_of(w)}
            (toxic if label else clean).update(seen)
            if len(toxic) + len(clean) > HELD:
                yield out()
                toxic.clear()
                clean.clear()
    if toxic or clean:
        yield out()


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _share(df: DataFrame, key: Column, most: int) -> DataFrame:
    """About ``most`` rows of ``df`` by a hash of ``key``, all if it has fewer."""
    n = df.count()
    if n <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(10), key), F.lit(1 << 20)) < int((1 << 20) * most / n))


def _lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> list[list[str]]:
    """Terms far more frequent among toxic texts by voter, the most telling first; of terms that coincide the longest."""
    rate1, rate0 = F.col("toxic") / n_toxic, (F.col("clean") + 0.5) / (n_clean + 1)
    both = F.col("toxic") + F.col("clean")
    expected = both * (n_toxic / (n_toxic + n_clean))
    told = 2 * (F.col("toxic") * F.log(F.col("toxic") / expected) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both - expected))).otherwise(0.0))
    often = (F.col("toxic") >= LEAST_TEXTS) & (rate1 >= LEAST_LIFT * rate0)
    chosen = counts.filter(often).withColumn("told", told).filter(F.col("told") >= LEAST_EVIDENCE)
    found: dict = {}
    for r in chosen.orderBy(F.desc("told"), F.desc(F.length("term")), "term").collect():  # terms of the sample
        twins = found.setdefault((r["toxic"], r["clean"]), [])
        if not any(r["term"][1:] in k or k[1:] in r["term"] for k in twins):
            twins.append(r["term"])
    ordered = [(counts, t) for counts, twins in found.items() for t in twins]
    rest = sorted(ordered[OWN_VOTERS:], key=lambda x: (x[0][0] / (x[0][1] + 0.5), x[1]))
    shared = [rest[len(rest) * k // SHARED_VOTERS : len(rest) * (k + 1) // SHARED_VOTERS] for k in range(SHARED_VOTERS)]
    return [[t] for _, t in ordered[:OWN_VOTERS]] + [[t for _, t in some] for some in shared if some]


class LabelModel:
    """A hidden class with voters that fire or abstain, weighed down by how much they go together."""

    def __init__(self, fires1: np.ndarray, fires0: np.ndarray, prior: float):
        self.rate1, self.rate0, self.prior = fires1, fires0, prior
        self.weight = np.ones(len(fires1))
        self.any = len(fires1) - len(PATTERNS)

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        told = np.log(self.rate1 / self.rate0) * self.weight
        out = np.full(len(votes), math.log(self.prior / (1 - self.prior))) + votes @ told
        # that nothing fires at all is a vote for clean
        none = math.log((1 - self.rate1[self.any]) / (1 - self.rate0[self.any]))
        return out + none * (1 - votes[:, self.any])

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))


def _unpacked(patterns: list[bytes], n: int) -> np.ndarray:
    bits = np.frombuffer(b"".join(patterns), np.uint8).reshape(len(patterns), -1)
    return np.unpackbits(bits, axis=1, count=n).astype(np.float64)


def _expected(model: LabelModel, n: int):
    """Expected counts by class: of texts, of each voter's votes and of each pair of votes."""

    def run(batches):
        total = np.zeros((2, n + 1, n + 1))
        for batch in in_slices(batches, PATTERNS_AT_ONCE):
            votes = _unpacked(batch.column(0).to_pylist(), n)
            count = np.asarray(batch.column(1), dtype=np.float64)
            toxic = model.posterior(votes)
            full = np.hstack([votes, np.ones((len(votes), 1))])
            for k, share in enumerate((toxic, 1 - toxic)):
                total[k] += full.T @ (full * (count * share)[:, None])
        yield _lines(total)

    return run


def _lines(total: np.ndarray) -> pa.RecordBatch:
    """A task's matrices by lines: as many rows as there are voters, each with its doubles as bytes."""
    lines = total.reshape(-1, total.shape[-1])
    return pa.RecordBatch.from_pydict({"line": np.arange(len(lines)), "doubles": [line.tobytes() for line in lines]})


def _added(batches):
    """The sum of each line; a task holds those dealt to it, at most the matrices themselves."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for line, doubles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[line] = total.get(line, 0) + np.frombuffer(doubles)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["line", "doubles"]
    )


def _summed(patterns: DataFrame, run, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all tasks of the lines that ``run`` makes of a task's patterns."""
    kind = "line long, doubles binary"
    sums = patterns.mapInArrow(run, kind).repartition("line").mapInArrow(_added, kind).toArrow()
    total = np.zeros((math.prod(shape[:-1]), shape[-1]))  # as many as the square of the number of voters
    for line, doubles in zip(sums.column("line").to_pylist(), sums.column("doubles").to_pylist()):
        total[line] += np.frombuffer(doubles)
    return total.reshape(shape)


def _together(pairs: np.ndarray, n: int) -> np.ndarray:
    """Correlations of the voters within a class, 0 where a voter never or always fires."""
    rate = pairs[n, :n] / max(pairs[n, n], 1e-9)
    both = pairs[:n, :n] / max(pairs[n, n], 1e-9)
    spread = np.sqrt(np.maximum(rate * (1 - rate), 0))
    scale = np.outer(spread, spread)
    return np.where(scale > 1e-9, (both - np.outer(rate, rate)) / np.maximum(scale, 1e-9), 0)


def _label_model(patterns: DataFrame, anchor1: np.ndarray, anchor0: np.ndarray, n_toxic: int, n_clean: int) -> LabelModel:
    """Expectation and maximisation over all patterns; the labelled rows weigh as much as the corpus."""
    n = len(anchor1)
    rate = lambda count, of: np.clip((count + 0.5) / (of + 1), 1e-5, 1 - 1e-5)
    model = LabelModel(rate(anchor1, n_toxic), rate(anchor0, n_clean), np.clip(n_toxic / (n_toxic + n_clean), 1e-4, 0.5))
    for _ in range(ROUNDS):
        pairs = _summed(patterns, _expected(model, n), (2, n + 1, n + 1))
        texts = max(1.0, pairs[0, n, n] + pairs[1, n, n])
        scale = texts / (n_toxic + n_clean)
        was = model.rate1
        model.rate1 = rate(pairs[0, n, :n] + scale * anchor1, pairs[0, n, n] + scale * n_toxic)
        model.rate0 = rate(pairs[1, n, :n] + scale * anchor0, pairs[1, n, n] + scale * n_clean)
        model.prior = float(np.clip((pairs[0, n, n] + scale * n_toxic) / (2 * texts), 1e-4, 0.5))
        together = np.maximum(_together(pairs[0], n), _together(pairs[1], n))
        np.fill_diagonal(together, 0)
        model.weight = 1 / (1 + np.maximum(together - 0.1, 0).sum(axis=1))
        model.weight[model.any] = 1.0
        if np.abs(model.rate1 - was).max() < 1e-3:
            break
    return model


def _slopes(votes: np.ndarray, count: np.ndarray, target: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Curvature, slope (last column but one) and number (in the last) of the logistic loss at ``w``, rows weighed by ``count``."""
    x = np.hstack([votes, np.ones((len(votes), 1))])
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    out = np.zeros((len(w), len(w) + 2))
    out[:, :-2] = (x * (count * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x
    out[:, -2] = x.T @ (count * (p - target))
    out[-1, -1] = count.sum()
    return out


def _newton(slopes, size: int) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton steps with a small penalty; ``slopes`` gives ``_slopes`` at a point."""
    w = np.zeros(size)
    penalty = np.full(size, 1e-4)
    penalty[-1] = 1e-8
    for _ in range(50):
        sums = slopes(w)
        sums = sums[:, :-1] / sums[-1, -1]
        step = np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1] + penalty * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _fit_linear(votes: np.ndarray, count: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    return _newton(lambda w: _slopes(votes, count, target, w), votes.shape[1] + 1)


def _fit_patterns(patterns: DataFrame, model: LabelModel, n: int) -> tuple[np.ndarray, float]:
    """The regression on the posteriors of all patterns; each step sums up over the stored table."""

    def at(w: np.ndarray):
        def run(batches):
            total = np.zeros((n + 1, n + 3))
            for batch in in_slices(batches, PATTERNS_AT_ONCE):
                votes = _unpacked(batch.column(0).to_pylist(), n)
                total += _slopes(votes, np.asarray(batch.column(1), dtype=np.float64), model.posterior(votes), w)
            yield _lines(total)

        return run

    return _newton(lambda w: _summed(patterns, at(w.copy()), (n + 1, n + 3)), n + 1)


def _calibrated(scores: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Slope and base that turn log odds into the shares of toxic rows seen among labelled ones."""
    count = toxic + clean
    scores = np.clip(scores, -30, 30)
    seen = (toxic + 0.5 * toxic.sum() / count.sum()) / (count + 0.5)
    w, base = _fit_linear(scores[:, None], count, seen)
    return float(max(w[0], 1e-3)), base


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The classifier, learnt from the labels of rows that are not held out and from the votes on all texts.

    Several labels of one id count as toxic if one is; null labels are none. Without labels, or with labels of one class
    only, there is no lexicon and every text scores near 0.
    """
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    known = labels.select(ident.alias("doc_id"), F.col(f"`{label_col}`").alias("label")).filter("label IS NOT NULL AND doc_id IS NOT NULL")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    known = _share(cut_lineage(known, "toxic-labels"), F.col("doc_id"), LABELLED_SAMPLE)
    # broadcast: at most the sample's rows of one id and one flag
    sample = docs.select(ident.alias("doc_id"), text.alias("text")).join(F.broadcast(known), "doc_id")
    sample = cut_lineage(sample.select("text", "label"), "toxic-sample")
    by_class = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_toxic, n_clean = by_class.get(1, 0), by_class.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()
    counts = sample.mapInArrow(_term_counts, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    terms = _lexicon(counts, n_toxic, n_clean)
    n = len(terms) + len(PATTERNS)

    @F.pandas_udf(BinaryType())
    def voted(texts: pd.Series) -> pd.Series:
        voters = Voters(terms)
        return pd.Series([np.packbits(voters.votes(t)).tobytes() for t in texts])

    seen = sample.select(voted("text").alias("votes"), F.col("label").alias("toxic")).groupBy("votes")
    seen = seen.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).collect()  # at most the sample
    labelled = _unpacked([r["votes"] for r in seen], n)
    by_label = np.array([[r["toxic"] for r in seen], [r["clean"] for r in seen]], dtype=float)
    anchors = by_label @ labelled
    patterns = docs.select(voted(text).alias("votes")).groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
    patterns = cut_lineage(patterns, "toxic-votes")
    model = _label_model(patterns, anchors[0], anchors[1], n_toxic, n_clean)
    weights, base = _fit_patterns(patterns, model, n)
    slope, shift = _calibrated(labelled @ weights + base, *by_label)
    return Model(terms, slope * weights, slope * base + shift)


def score(text: Column, model: Model) -> Column:
    """The score of a text between 0 and 1; null counts as empty."""
    terms, weights, base = [list(own) for own in model.terms], np.asarray(model.weights), float(model.base)

    @F.pandas_udf(DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        voters = Voters(terms)
        votes = [voters.votes(t) @ weights + base for t in texts]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(votes, dtype=float), -30, 30))))

    return scored(text)


def score_table(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row; a null id is not held out."""
    ident = F.col(f"`{id_col}`")
    scored = docs.select(ident.alias("doc_id"), held_out(ident).alias("held_out"), score(F.col(f"`{text_col}`"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the texts that score as toxic."""
    scored = docs.select(F.struct("*").alias("row"), score(F.col(f"`{text_col}`"), model).alias("score"))
    return scored.filter(F.col("score") < THRESHOLD).select("row.*")
