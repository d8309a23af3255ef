"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.llm import bpe, decontaminate, embeddings, exact, lines, merkle, minhash, mixing, search, secret_scan, sharding, tokencount, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: The shards of the documents before and after.
OLD_SHARDS, NEW_SHARDS = 12, 16


@query
def op1_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 12 shards by hash to 16 of near equal bytes."""
    docs = documents(spark, sf_dir)
    old = F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS))
    placed = sharding.shard_table(docs, old, NEW_SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("old").alias("old_shard"),
    )


@query
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share 85 % of their three-word shingles."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return minhash.near_groups(docs, width=3, percent=85).drop("text_hash")


@query
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label at a cosine of 0.98 or more."""
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of line runs deleted: three lines, or fewer with 50 words."""
    found = lines.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "row.doc_id",
        "n_lines",
        F.size("deleted").cast("long").alias("n_deleted"),
        F.array_join("deleted", ",").alias("deleted"),
        "longest_run",
        F.sha2(F.coalesce("left_text", F.lit("")).cast("binary"), 256).alias("left_sha256"),
    )


#: Longer documents do not fit a training window.
TOKEN_LIMIT = 4096


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counts = tokencount.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed from their sources by weight."""
    return mixing.mix(documents(spark, sf_dir))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal normalised texts."""
    _, verdicts = exact.exact_groups(documents(spark, sf_dir))
    return verdicts.drop("row_id")


ORACLES["op7_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (t)
"""


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded, and the ids decoded again."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = documents(spark, sf_dir)
    both = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, keep=["doc_id"], decoded="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text."""
    found = secret_scan.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    counts = [F.expr(f"size(filter(spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in secret_scan.BASE]
    return found.select(
        "row.doc_id",
        *counts,
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_table(docs, model)


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof in the dataset's manifest, checked after one is added to ``n_chars`` of some."""
    docs = documents(spark, sf_dir)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.LEAF_COLUMNS]
    return merkle.audit(docs, tampered, changed)


ORACLES["op11_merkle"] = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]))) AS crc FROM documents, crc_table),
framed AS (SELECT *, CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS changed FROM d),
l AS (SELECT doc_id, lang,
  sha256(concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-'), coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
  sha256(concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(CAST(changed AS VARCHAR)) || ':' || changed, '-'), coalesce(strlen(text) || ':' || text, '-'))) AS other FROM framed),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM l),
g AS (SELECT lang, 0 AS h, list(leaf ORDER BY rank) AS nodes FROM r GROUP BY lang
      UNION ALL
      SELECT lang, h + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(concat(nodes[2 * i + 1], coalesce(nodes[2 * i + 2], '')))) FROM g WHERE len(nodes) > 1),
s AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS top FROM g WHERE len(nodes) = 1),
u AS (SELECT 0 AS h, (SELECT list(subroot ORDER BY top) FROM s) AS nodes
      UNION ALL
      SELECT h + 1, list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(concat(nodes[2 * i + 1], coalesce(nodes[2 * i + 2], '')))) FROM u WHERE len(nodes) > 1),
steps AS (
  SELECT r.lang, r.rank, g.h, nodes[xor(r.rank >> g.h, 1) + 1] AS sibling, (r.rank >> g.h) % 2 = 1 AS lefts
  FROM r JOIN g ON g.lang IS NOT DISTINCT FROM r.lang AND len(nodes) > 1
  UNION ALL
  SELECT r.lang, r.rank, 100 + u.h, nodes[xor(s.top >> u.h, 1) + 1], (s.top >> u.h) % 2 = 1
  FROM r JOIN s ON s.lang IS NOT DISTINCT FROM r.lang JOIN u ON len(nodes) > 1),
p AS (SELECT lang, rank, coalesce(string_agg(sibling, '' ORDER BY h), '') AS siblings,
             list(CASE WHEN sibling IS NULL THEN '' WHEN lefts THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY h) AS path FROM steps GROUP BY lang, rank)
SELECT r.doc_id, r.leaf, s.subroot, whole.nodes[1] AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       list_reduce(list_concat([r.other], coalesce(p.path, [])), lambda acc, x: sha256(CASE WHEN x = '' THEN acc WHEN x[1] = 'L' THEN x[2:] || acc ELSE acc || x[2:] END)) AS folded_root,
       folded_root = whole.nodes[1] AS verified
FROM r JOIN s ON s.lang IS NOT DISTINCT FROM r.lang JOIN (SELECT nodes FROM u WHERE len(nodes) = 1) whole ON true
LEFT JOIN p ON p.lang IS NOT DISTINCT FROM r.lang AND p.rank = r.rank
"""


@query
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents that lie in a ten-word passage of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found, lists = decontaminate.contamination(documents(spark, sf_dir), benchmark)
    about = [F.size("items").cast("long").alias("listed"), F.sha2(F.array_join("items", ","), 256).alias("digest")]
    told = decontaminate.with_items(found, lists, *about)
    n_hit = decontaminate.words_hit(F.col("spans"))
    return told.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("listed", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLES["op12_decontaminate"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, CASE WHEN len(w) < 10 THEN len(w) ELSE 10 END AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS x FROM s),
dw AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS x
       FROM d JOIN (SELECT DISTINCT n FROM s) k ON len(w) >= n),
h AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, x)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM h) q GROUP BY r),
t AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents with the highest scores for each benchmark item."""
    index = search.build_index(documents(spark, sf_dir))
    return search.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLES["op13_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark),
s AS (SELECT count(*) AS N, CAST(sum(len(t)) AS BIGINT) AS L FROM d WHERE len(t) > 0),
f AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(t) AS x FROM d) u GROUP BY r, x),
w AS (SELECT x, CAST(floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY x, N),
m AS (SELECT r, doc_id, 50 + (50 * len(t) * N) // L AS m FROM d, s WHERE len(t) > 0),
c AS (SELECT q, item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM (SELECT DISTINCT q, item_id, unnest(t) AS x FROM q) a JOIN w USING (x) JOIN f USING (x) JOIN m USING (r) GROUP BY q, item_id, r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM c JOIN d USING (r) WHERE score > 0 QUALIFY rank <= 50
"""


ORACLES["op2_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])) END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r AS (SELECT doc_id, doc_id AS reach FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

ORACLES["op3_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id, vec_id AS reach FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.vec_id
"""

ORACLES["op4_line_dedup"] = r"""
WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
raw AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM t),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM raw),
l AS (SELECT *, lead(line) OVER o AS line2, lead(line, 2) OVER o AS line3, lead(words) OVER o AS words2 FROM counted
      WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
runs AS (SELECT doc_id, pos, 1 AS n, [line] AS run FROM l WHERE words >= 50
         UNION ALL SELECT doc_id, pos, 2, [line, line2] FROM l WHERE line2 IS NOT NULL AND words + words2 >= 50
         UNION ALL SELECT doc_id, pos, 3, [line, line2, line3] FROM l WHERE line3 IS NOT NULL),
later AS (SELECT doc_id, pos, n FROM runs QUALIFY row_number() OVER (PARTITION BY n, run ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS pos FROM later) x),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS left_text FROM raw ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
told AS (SELECT doc_id, count(*) AS n_deleted, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS deleted FROM gone GROUP BY doc_id),
diagonals AS (SELECT a.doc_id, a.pos, b.doc_id AS other, a.pos - b.pos AS shift FROM raw a JOIN raw b
              ON a.line = b.line AND (a.doc_id <> b.doc_id OR a.pos <> b.pos)),
stretches AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY pos) AS stretch FROM diagonals),
longest AS (SELECT doc_id, max(n) AS longest_run FROM (SELECT doc_id, count(*) AS n FROM stretches GROUP BY doc_id, other, shift, stretch) x
            GROUP BY doc_id)
SELECT t.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, coalesce(deleted, '') AS deleted,
       coalesce(longest_run, 0) AS longest_run, sha256(coalesce(left_text, '')) AS left_sha256
FROM t LEFT JOIN kept USING (doc_id) LEFT JOIN told USING (doc_id) LEFT JOIN longest USING (doc_id)
"""
