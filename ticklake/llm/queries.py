"""The registered queries of this subpackage: name -> fn(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import (
    knn_join, merkle_manifest, near_dedup, ngram_lm, packing, prefix_trie, quality_classifier, quality_rules, sentencepiece_codec, sharding, substring_dedup,
    token_counts, toxicity,
)
from ticklake.llm.common import read

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(read(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), 16)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), WORD_BPE)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(read(spark, sf_dir, "documents"), size=3, percent=85)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(read(spark, sf_dir, "documents"), PIECE_BPE)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn_join.whole_numbers(read(spark, sf_dir, "embeddings"))
    return knn_join.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(read(spark, sf_dir, "documents"), ngram_lm.ORDER)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(read(spark, sf_dir, "documents"), WORD_BPE)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verified_documents(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.share_heads(prefix_trie.sequences(read(spark, sf_dir, "conversations"))))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_sharding, op3_best_fit_packing, op4_near_dedup, op5_sentencepiece, op6_exact_top_k, op7_quality_rules,
        op8_quality_classifier, op9_lm_scoring, op10_token_counts, op11_merkle_manifest,
        op12_prefix_trie, op13_toxicity,
    )
}
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _crc32(number: str) -> str:
    """SQL for the unsigned CRC-32 of a number's decimal text."""
    t = f"CAST({number} AS VARCHAR)"
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({t}) + 1), lambda i: ascii({t}[i])::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _field(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
n AS (SELECT doc_id, w, len(w) AS n FROM d),
s AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM n, LATERAL unnest(range(1, n - 48)) AS t(i)),
o AS (SELECT h, min(doc_id) AS owner FROM s GROUP BY h),
c AS (SELECT DISTINCT doc_id, p FROM s JOIN o USING (h), LATERAL unnest(range(i, i + 50)) AS t(p) WHERE owner < doc_id),
k AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                   ELSE coalesce((SELECT string_agg(w[q.p], ' ' ORDER BY q.p) FROM unnest(range(1, n + 1)) AS q(p)
                                  WHERE NOT list_contains(gone, q.p)), '') END) AS kept_sha256
FROM n LEFT JOIN k USING (doc_id)""",
    "op4_near_dedup": r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 3 THEN array_to_string(w[i:i + 2], ' ') ELSE array_to_string(w, ' ') END AS g
      FROM d, LATERAL unnest(range(1, greatest(len(w) - 1, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS t(i)),
n AS (SELECT doc_id, count(g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
r(node, seen) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.seen FROM r JOIN l ON l.a = r.node WHERE r.seen < l.b),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c ON c.node = doc_id""",
    "op6_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || source, '') AS tree,
        {" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head, text,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
        coalesce({_crc32("doc_id")} % 5 = 0, false) AS hit FROM documents),
f AS (SELECT doc_id, tree, sha256(head || {_field("text")}) AS leaf, CASE WHEN hit THEN sha256(head || {_field("low")}) END AS new FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM f),
t(tree, l, i, h, n) AS (SELECT tree, 0, i, leaf, n FROM o UNION ALL
    SELECT tree, l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM t WHERE n > 1 GROUP BY tree, l, i // 16, n),
r AS (SELECT tree, h AS subroot, l AS height, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(l, i, h, n) AS (SELECT 0, i, subroot, n FROM r UNION ALL
    SELECT l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM u WHERE n > 1 GROUP BY l, i // 16, n),
w AS (SELECT h AS root, l AS up FROM u WHERE n = 1),
x AS (SELECT o.*, subroot, height, r.i AS place, root, height + up AS levels FROM o JOIN r USING (tree), w),
s AS (SELECT x.tree, x.i, k.l,
        coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i < x.i // CAST(pow(16, k.l) AS BIGINT)), '') AS a,
        coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i > x.i // CAST(pow(16, k.l) AS BIGINT)), '') AS b
      FROM x, LATERAL unnest(range(0, height)) AS k(l)
      JOIN t ON t.tree = x.tree AND t.l = k.l AND t.i // 16 = x.i // CAST(pow(16, k.l + 1) AS BIGINT) GROUP BY ALL
      UNION ALL
      SELECT x.tree, x.i, x.height + k.l,
        coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i < x.place // CAST(pow(16, k.l) AS BIGINT)), ''),
        coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i > x.place // CAST(pow(16, k.l) AS BIGINT)), '')
      FROM x, LATERAL unnest(range(0, levels - height)) AS k(l)
      JOIN u ON u.l = k.l AND u.i // 16 = x.place // CAST(pow(16, k.l + 1) AS BIGINT) GROUP BY ALL),
p AS (SELECT tree, i, list(a ORDER BY l) AS a, list(b ORDER BY l) AS b, string_agg(a || b, '' ORDER BY l) AS whole FROM s GROUP BY tree, i),
y AS (SELECT x.*, sha256(coalesce(whole, '')) AS proof_sha256,
        list_reduce(list_prepend(coalesce(new, leaf), range(1, levels + 1)::VARCHAR[]),
                    lambda h, l: sha256(a[CAST(l AS BIGINT)] || h || b[CAST(l AS BIGINT)])) AS folded_root
      FROM x LEFT JOIN p USING (tree, i))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified,
       CAST(CASE WHEN new IS NULL THEN 0 ELSE levels + 1 END AS INTEGER) AS nodes_copied FROM y""",
    "op12_prefix_trie": f"""
WITH g AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, md5(strlen(role) || ':' || role || text) AS d,
        len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w FROM g),
o AS (SELECT conv_id, list({{'d': d, 'w': w}} ORDER BY turn NULLS FIRST, d) AS t, {_crc32("conv_id")} % 4 AS h FROM k GROUP BY conv_id),
r AS (SELECT a.conv_id, list_concat(coalesce(b.t[1:CAST(a.h AS BIGINT)], []), a.t[CAST(a.h AS BIGINT) + 1:]) AS t
      FROM o a LEFT JOIN o b ON b.conv_id = a.conv_id - a.conv_id % 20),
p AS (SELECT conv_id, len(t) AS size, e.depth, array_to_string(list_transform(t[1:e.depth], lambda x: x.d), '') AS key,
        CASE WHEN e.depth > 0 THEN t[e.depth].w ELSE 0 END AS w FROM r, LATERAL unnest(range(0, len(t) + 1)) AS e(depth)),
n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
      FROM p GROUP BY key, depth),
c AS (SELECT left(key, 32 * (depth - 1)) AS parent, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON c.parent = n.key),
s AS (SELECT left(key, 32 * u.d) AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved
      FROM f, LATERAL unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s ON s.top = f.key LEFT JOIN n q ON f.depth > 0 AND q.key = left(f.key, 32 * (f.depth - 1))""",
}
