"""The operators as registered queries over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattframe.llm import (exact, fingerprints, jaccard, licenses, lm, merkle, mixing, packing, pii, prefix_counts, quality, search,
                           substrings)
from wattframe.llm.common import documents


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir), words=3, num=9, den=10)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir)).drop("found")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scored(documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=50)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return prefix_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_fingerprints": op2_fingerprints,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_licenses": op6_licenses,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_packing": op10_packing,
    "op11_ranked_search": op11_ranked_search,
    "op12_token_counts": op12_token_counts,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL = {
    "op1_jaccard_join": """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 3 THEN array_to_string(w[i:i + 2], ' ') ELSE array_to_string(w, ' ') END AS t
      FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.t = b.t AND a.doc_id != b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.a = d.doc_id GROUP BY d.doc_id""",
    "op5_substring_dedup": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM d, LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS first FROM x),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f WHERE first < doc_id),
a AS (SELECT d.doc_id, len(w) AS n, w, (SELECT list(g.i) FROM g WHERE g.doc_id = d.doc_id) AS gone FROM d)
SELECT doc_id, n AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string([w[i] for i in range(1, n + 1) if NOT list_contains(coalesce(gone, []), i)], ' ')) AS kept_sha256 FROM a""",
    "op8_exact_dedup": """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS digest FROM documents),
r AS (SELECT *, count(*) OVER (PARTITION BY digest) AS group_size,
             first_value(doc_id) OVER (PARTITION BY digest ORDER BY n DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, digest AS text_sha256 FROM r""",
    "op3_mixing": """
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place FROM s GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][CAST((place - 1) % 3 + 1 AS INT)] AS weight, 2 * source_size AS cap FROM per),
levels AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
                      - ((sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS UNBOUNDED PRECEDING)) - cap)::DOUBLE)
                     / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
           FROM weighed),
targets AS (SELECT source, source_size,
                   least(cap::DOUBLE, coalesce((SELECT max(level) FROM levels WHERE level * weight <= cap) * weight, cap::DOUBLE)) AS target FROM levels),
budget AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM targets),
run AS (SELECT s.doc_id, s.size, b.source_size, b.target, b.copies, b.target - b.copies * b.source_size AS rest,
               CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) AS BIGINT) AS upto
        FROM s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       size * (copies + CASE WHEN rest <= 0 THEN 0
                             WHEN upto <= rest THEN 1
                             WHEN upto - size > rest THEN 0
                             WHEN upto - rest < rest - (upto - size) THEN 1 ELSE 0 END) AS taken FROM run""",
    "op11_ranked_search": """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY doc_id, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
m AS (SELECT doc_id, 100 - 50 + (CAST(50 * len(w) AS BIGINT) * n) // total AS m FROM d, s WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, s),
p AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN wt USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50""",
    "op13_merkle_manifest": """
WITH RECURSIVE f AS (
  SELECT doc_id, n_chars, coalesce('+' || lang, '') AS tree,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, 8 * length(CAST(doc_id AS VARCHAR))),
             lambda i: CASE WHEN i % 8 = 0 THEN ascii(CAST(doc_id AS VARCHAR)[i // 8 + 1])::BIGINT ELSE 0::BIGINT END)),
             lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT) AS crc FROM documents),
leaf AS (
  SELECT doc_id, tree, node, changed, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM (SELECT doc_id, tree, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END || tail) AS node,
               CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL
                    THEN sha256(head || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || tail) END AS changed FROM f)),
up AS (
  SELECT tree, 0 AS level, pos, node, n FROM leaf
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY tree, level, pos // 2, n),
sub AS (SELECT tree, node, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS trees FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, place AS pos, node, trees AS n FROM sub
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
root AS (SELECT node, level AS height FROM top WHERE n = 1),
steps AS (
  SELECT l.doc_id, s.level AS step, (l.pos >> s.level) % 2 AS side, u.node
  FROM leaf l JOIN sub t ON t.tree = l.tree, LATERAL (SELECT unnest(range(0, t.height)) AS level) s
  LEFT JOIN up u ON u.tree = l.tree AND u.level = s.level AND u.pos = xor(l.pos >> s.level, 1)
  UNION ALL
  SELECT l.doc_id, t.height + s.level, (t.place >> s.level) % 2, u.node
  FROM leaf l JOIN sub t ON t.tree = l.tree, LATERAL (SELECT unnest(range(0, (SELECT height FROM root))) AS level) s
  LEFT JOIN top u ON u.level = s.level AND u.pos = xor(t.place >> s.level, 1)),
proof AS (SELECT doc_id, coalesce(string_agg(node, '' ORDER BY step), '') AS nodes, max(step) AS last FROM steps GROUP BY doc_id),
fold AS (
  SELECT doc_id, 0::BIGINT AS step, coalesce(changed, node) AS node FROM leaf
  UNION ALL
  SELECT a.doc_id, a.step + 1, sha256(CASE WHEN s.node IS NULL THEN a.node WHEN s.side = 1 THEN s.node || a.node ELSE a.node || s.node END)
  FROM fold a JOIN steps s ON s.doc_id = a.doc_id AND s.step = a.step)
SELECT l.doc_id, l.node AS leaf, t.node AS subroot, r.node AS root, sha256(coalesce(p.nodes, '')) AS proof_sha256,
       e.node AS folded_root, e.node = r.node AS verified
FROM leaf l JOIN sub t ON t.tree = l.tree CROSS JOIN root r LEFT JOIN proof p ON p.doc_id = l.doc_id
JOIN fold e ON e.doc_id = l.doc_id AND e.step = coalesce(p.last + 1, 0)""",
}
