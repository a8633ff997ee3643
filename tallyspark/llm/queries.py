"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tallyspark.llm import (
    ann, collocations, decontamination, language_id, line_dedup, packing, pii, prefix_trie, secret_scan, simhash_dedup, suffix_dedup,
    token_counts, warc)
from tallyspark.session import scratch_path


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark, sf):
    return suffix_dedup.summary(spark, table(spark, sf, "documents"), length=200)


def op2_packing(spark, sf):
    return packing.pieces(spark, table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_ann(spark, sf):
    return ann.neighbours(spark, table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op4_language_id(spark, sf):
    return language_id.language_id(spark, table(spark, sf, "documents"))


def op5_token_counts(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_line_dedup(spark, sf):
    return line_dedup.summary(spark, table(spark, sf, "documents"))


def op7_simhash_dedup(spark, sf):
    return simhash_dedup.near_duplicates(spark, table(spark, sf, "documents"), shingle=4, max_bits=4)


def op8_decontamination(spark, sf):
    return decontamination.leaks(spark, table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op9_pii(spark, sf):
    return pii.personal_data(spark, table(spark, sf, "documents"))


def op10_warc(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.revisit_targets(pages), path)
    return warc.resolved(warc.read_archives(spark, path, payloads=False))


def op11_secret_scan(spark, sf):
    return secret_scan.secrets(spark, table(spark, sf, "documents"))


def op12_phrase_collocations(spark, sf):
    return collocations.collocations(spark, table(spark, sf, "documents"), longest=5, least=100, top=2000, percent=100)


def op13_prefix_trie(spark, sf):
    turns = prefix_trie.named_turns(spark, table(spark, sf, "conversations"))
    return prefix_trie.trie(spark, prefix_trie.branched(spark, turns, share=100, most=6))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_packing": op2_packing,
    "op3_ann": op3_ann,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_line_dedup": op6_line_dedup,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_pii": op9_pii,
    "op10_warc": op10_warc,
    "op11_secret_scan": op11_secret_scan,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

_SQL_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
big AS (SELECT payload_digest AS dg, max(page_id) AS newest, count(*) AS n
        FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM newest THEN newest END AS refers_to
FROM d LEFT JOIN big ON payload_digest = dg
"""

_SQL_COLLOCATIONS = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda w: w != '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS p FROM texts)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, m, w[i:i + m - 1] AS p FROM places, (VALUES (1), (2), (3), (4), (5)) v(m) WHERE i + m - 1 <= len(w)),
freq AS (SELECT lang, m, p, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT * FROM freq WHERE m > 1),
cuts AS (
  SELECT c.lang, c.p, c.m, c.f AS a, k, x.f AS l, y.f AS r, n,
         (1000 * CAST(c.f AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cand c, (VALUES (1), (2), (3), (4)) v(k), totals t, freq x, freq y
  WHERE k < c.m AND t.lang = c.lang AND x.lang = c.lang AND x.p = c.p[1:k] AND y.lang = c.lang AND y.p = c.p[k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
longer AS (
  SELECT lang, p[s:s + z - 1] AS p, max(f) AS f
  FROM cand, (VALUES (2), (3), (4)) u(z), (VALUES (1), (2), (3), (4)) v(s)
  WHERE z < m AND s + z - 1 <= m GROUP BY ALL),
kept AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.p = b.p WHERE o.f IS NULL OR 100 * o.f < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""

_SQL_TRIE = """
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, sha256(concat(length(r), ':', r, x))) AS seq
  FROM turns GROUP BY c),
cuts AS (
  SELECT c, seq, (4294967295 - list_reduce(
      list_concat([4294967295], flatten([[ascii(d), 0, 0, 0, 0, 0, 0, 0] FOR d IN string_split(CAST(c AS VARCHAR), '')])),
      lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) % 2)))) % 6 AS h
  FROM own),
rebuilt AS (
  SELECT k.c, list_concat(coalesce(b.seq, k.seq[1:0])[1:k.h], k.seq[k.h + 1:]) AS seq
  FROM cuts k LEFT JOIN own b ON b.c = k.c - k.c % 100),
prefixes AS (
  SELECT c, seq, d, seq[1:d] AS p, len(seq) = d AS ends
  FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY d, p),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
tree AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         (n_convs - 1) * CASE WHEN n.d = 0 THEN 0 ELSE length(n.p[n.d].x) END AS saved
  FROM nodes n LEFT JOIN kids k ON n.p = k.p),
totals AS (
  SELECT p[1:up] AS p, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM tree) GROUP BY 1)
SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens, t.ends_sha256
FROM tree t JOIN totals s ON s.p = t.p LEFT JOIN tree u ON t.d > 0 AND u.p = t.p[1:t.d - 1]
"""

ORACLE_SQL = {
    "op10_warc": _SQL_WARC,
    "op12_phrase_collocations": _SQL_COLLOCATIONS,
    "op13_prefix_trie": _SQL_TRIE,
}
