"""The subpackage's registered queries and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.llm import (
    ctph,
    decontam,
    hnsw,
    interpolation,
    license_scan,
    packing,
    prefix_trie,
    sharding,
    simhash,
    token_counts,
    toxicity,
    warc,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned outside fold 1."""
    return interpolation.score(_table(spark, sf_dir, "documents"), folds=5, held_out=1, tune=0)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words in all documents."""
    found = decontam.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return decontam.digest(found)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of all documents."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in all documents."""
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edits and their neighbours."""
    return ctph.edit_probe(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"), min_bytes=0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of encoded lengths of all documents with its suffix sums."""
    return token_counts.suffix_sums(token_counts.histogram(_table(spark, sf_dir, "documents")))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), max_len=1024, end_id=2)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of near-equal bytes."""
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=24)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside fold 0."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity.score(docs, model).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt in groups of 100."""
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"), group=100)


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return hnsw.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors along the first 32 whitening directions."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_benchmark_decontamination": op2_benchmark_decontamination,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op4_license_scans": op4_license_scans,
        "op5_document_fingerprints": op5_document_fingerprints,
        "op6_warc": op6_warc,
        "op7_token_counts": op7_token_counts,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_sharding": op9_sharding,
        "op10_toxicity": op10_toxicity,
        "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
        "op12_embedding_near_dedup": op12_embedding_near_dedup,
        "op13_embedding_whitening": op13_embedding_whitening,
    }


_WORDS = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"""

OP2_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
             array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM p),
g AS (SELECT r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)),
h AS (SELECT g.r, g.i, g.n, p.item_id FROM g JOIN p USING (n, g)),
c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)"""


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31),
           1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM m"""


def _values(rows: list[tuple]) -> str:
    quoted = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "VALUES " + ", ".join(f"({', '.join(map(quoted, r))})" for r in rows)


def _op4_sql(k: int = license_scan.K, slack: int = 2, least: float = 0.8) -> str:
    templates = [(i, label, text) for i, (label, text) in enumerate(license_scan.TEMPLATES)]
    phrases = [(p, label, len(p.split(" "))) for p, label in license_scan.BASE_PHRASES.items()]
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT r, unnest(range(0, len(w))) AS p, w FROM d),
f AS (SELECT s.r, s.p, x.label
      FROM s, ({_values(phrases)}) x(phrase, label, n)
      WHERE array_to_string(list_slice(w, p + 1, p + n), ' ') = phrase),
b AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
             list_distinct(list(label)) AS base FROM f GROUP BY r),
t AS (SELECT id, label, {_WORDS.format("text")} AS w FROM ({_values(templates)}) v(id, label, text)),
g AS (SELECT id, label, len(w) AS t_words, len(w) - {k - 1} AS t_runs, q,
             array_to_string(list_slice(w, q + 1, q + {k}), ' ') AS run
      FROM (SELECT *, unnest(range(0, len(w) - {k - 1})) AS q FROM t)),
h AS (SELECT r, p, array_to_string(list_slice(w, p + 1, p + {k}), ' ') AS run FROM s WHERE p + {k} <= len(w)),
v AS (SELECT r, id, label, t_words, t_runs, p - q AS diagonal, min(p) AS low, max(p) AS high, list(q) AS q
      FROM h JOIN g USING (run) GROUP BY ALL),
m AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o > {slack}
                       OR low > lag(high) OVER o + {k + slack} OR high + {k + slack} < lag(low) OVER o
                     THEN 1 ELSE 0 END AS new
      FROM v WINDOW o AS (PARTITION BY r, id ORDER BY diagonal)),
j AS (SELECT r, id, label, t_words, t_runs, part, min(low) AS a, max(high) + {k} AS z,
             CAST(len(list_distinct(flatten(list(q)))) AS DOUBLE) / t_runs AS coverage
      FROM (SELECT *, sum(new) OVER (PARTITION BY r, id ORDER BY diagonal) AS part FROM m)
      GROUP BY r, id, label, t_words, t_runs, part),
y AS (SELECT *, max(z) OVER (PARTITION BY r ORDER BY a, z, id, part
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
      FROM j WHERE coverage >= {least} AND abs(z - a - t_words) <= t_words * (1 - {least}::DOUBLE) + {slack}),
u AS (SELECT *, sum(CASE WHEN a < reached THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY a, z, id, part) AS place
      FROM y),
c AS (SELECT r, list_distinct(list(label)) AS found, max(coverage) AS best
      FROM (SELECT *, max(coverage) OVER (PARTITION BY r, place) AS top FROM u) WHERE coverage = top GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN c USING (r)"""


# crc32 of a text's ASCII bytes, bit by bit.
_CRC32 = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                               lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP11_SQL = f"""
WITH s AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS v,
                  CAST({_CRC32.format("CAST(conv_id AS VARCHAR)")} % 6 AS INTEGER) AS h
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (SELECT s.conv_id, list_concat(list_slice(coalesce(o.v, []), 1, s.h), list_slice(s.v, s.h + 1, len(s.v))) AS v
      FROM s LEFT JOIN s o ON o.conv_id = s.conv_id - s.conv_id % 100),
p AS (SELECT conv_id, d, len(v) AS size, sha256(CAST(to_json(list_slice(v, 1, d)) AS VARCHAR)) AS k,
             CASE WHEN d > 0 THEN length(v[d].x) ELSE 0 END AS chars
      FROM (SELECT conv_id, v, unnest(range(0, len(v) + 1)) AS d FROM c)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS own,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends
      FROM p GROUP BY k, d),
u AS (SELECT n.*, a.k AS up FROM n LEFT JOIN p a ON a.conv_id = n.conv_id AND a.d = n.d - 1),
f AS (SELECT up AS k, count(*) AS n_children FROM u WHERE up IS NOT NULL GROUP BY up),
m AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM u LEFT JOIN f USING (k)),
t AS (SELECT a.k, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves, sum(m.own) AS saved
      FROM m JOIN p a ON a.conv_id = m.conv_id AND a.d <= m.d GROUP BY a.k)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN t USING (k) LEFT JOIN m o ON o.k = m.up"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_benchmark_decontamination": OP2_SQL,
        "op4_license_scans": _op4_sql(),
        "op6_warc": OP6_SQL,
        "op11_conversation_prefix_trie": OP11_SQL,
    }
