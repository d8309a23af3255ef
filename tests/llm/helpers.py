"""Small tables with everything that is awkward: nulls, repeats, ties, and columns named like the operators' own."""

import random
import re

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside.
CLASHING = ["row", "row_id", "key", "size", "part", "digit", "bucket", "shard", "slot", "text_hash", "component", "made", "given", "n", "kept", "taken", "amount", "ids", "pos", "rank"]


def table(spark, rows):
    """``rows``: (doc_id, text, source)."""
    made = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], COLUMNS)
    return made.select("*", *[F.lit(f"x{k}").alias(c) for k, c in enumerate(CLASHING)])


def prose(seed, words, lines=1):
    r = random.Random(seed)
    made = [r.choice("and the of ring ton hes lab mer ost ix qua ver dol pim".split()) + r.choice(["", "a", "er", "s", "ing"]) for _ in range(words)]
    cut = sorted(r.sample(range(1, words), min(lines - 1, words - 1)))
    return "\n".join(" ".join(made[a:b]) for a, b in zip([0, *cut], [*cut, words]))


def awkward(seed=1):
    """Documents with equal, spaced-out, empty, null, one-word and long texts; ids repeated and null."""
    texts = [prose(seed + k, 40 + k, 4) for k in range(12)]
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(texts)]
    rows += [(20, texts[0].replace(" ", "  "), "s1"), (21, texts[0], None), (21, texts[0], None), (22, None, "s0"), (23, "", "s0"), (24, " \t ", "s2")]
    rows += [(25, "word", "s0"), (26, "Word", "s0"), (27, "two words", None), (None, texts[3], "s1"), (None, "only here " + prose(99, 30), None), (None, None, None)]
    rows += [(28, prose(77, 3000, 60), "s1"), (29, prose(77, 3000, 60), "s2"), (30, texts[5] + " tail", "s0"), (1, "the id comes twice " + prose(55, 30), "s9")]
    return rows


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(zip(*[w[k:] for k in range(width)])) if len(w) >= width else frozenset([tuple(w)])


def classes(n, links):
    """The smallest index each of ``n`` reaches."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def smallest(ids):
    """The smallest id, null only if there is no other."""
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
