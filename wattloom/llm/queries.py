"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import anchors, bpetree, ctw, dartminhash, fertility, fuzzylines, merkle, packing, pagediff, pulearn, threshold, tiling, zlang
from wattloom.llm.common import table
from wattloom.session import configure


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; the files are never part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.language_scores(table(configure(spark), sf_dir, "documents"))


def op2_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fertility.fertility_rules(table(configure(spark), sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return got.select(*base, "script", *fertility.MEASURES)


def op3_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = zlang.language_id(table(configure(spark), sf_dir, "documents"))
    return got.select("doc_id", "held_out", "lang_pred", "score", "margin", "accepted")


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(configure(spark), sf_dir, "documents"))


def op5_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.main_text(table(configure(spark), sf_dir, "pages"))


def op6_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.kept_digest(anchors.remove_repeats(table(configure(spark), sf_dir, "documents")))


def op7_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(configure(spark), sf_dir, "documents")
    got = packing.pack(packing.pieces(documents, vocabulary("word_bpe_49k.json")))
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return pulearn.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fuzzylines.dedup_lines(table(configure(spark), sf_dir, "documents").select("doc_id", "text"), short_repeats=True)
    return got.select("doc_id", "n_lines", "n_removed", "text")


def op10_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return tiling.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_tree_concatenation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpetree.round_trip(table(configure(spark), sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op12_threshold_algorithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold.hard_negatives(table(configure(spark), sf_dir, "embeddings"))


def op13_recursive_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_proofs(table(configure(spark), sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_context_tree, op2_token_fertility, op3_zstd_language, op4_dart_minhash, op5_page_differencing,
        op6_difference_cover, op7_genetic_packing, op8_positive_unlabelled, op9_fuzzy_lines, op10_string_tiling, op11_tree_concatenation,
        op12_threshold_algorithm, op13_recursive_climb,
    )
}
# The windows of all texts, each compared by the digest of its words.
OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, unnest(list_transform(generate_series(1, len(ws) - 12), lambda i: {'i': i, 'k': md5(array_to_string(ws[i:i + 12], ' '))})) AS x FROM w WHERE len(ws) >= 13),
first AS (SELECT x.k AS k, min(doc_id) AS m FROM win GROUP BY 1),
hit AS (SELECT doc_id, x.i AS i FROM win JOIN first ON x.k = first.k WHERE m < doc_id),
gone AS (SELECT doc_id, p FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p FROM hit)),
word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
# All anchors against all rows; inner products of doubles are exact here, being far below 2^53.
OP12_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT * FROM n WHERE rank <= 3
"""


def _sized(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || {column} END"


# Levels by one recursion, folded roots by another; crc32 bit by bit.
OP13_SQL = f"""
WITH RECURSIVE x AS (
  SELECT *, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) END) AS crc
  FROM documents
),
y AS (SELECT *, CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM x),
d AS (
  SELECT doc_id, lang, sha256({" || ".join(_sized(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
    sha256({" || ".join(_sized(c) for c in ("doc_id", "source", "lang", "n_chars", "changed"))}) AS folded
  FROM y
),
l AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS lang_no
  FROM d
),
t AS (
  SELECT lang_no, 0 AS level, pos, leaf AS h, n FROM l
  UNION ALL
  SELECT lang_no, level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (n + 7) // 8 FROM t WHERE n > 1 GROUP BY lang_no, level, pos // 8, n
),
r AS (SELECT sha256(string_agg(h, '' ORDER BY lang_no)) AS root FROM t WHERE n = 1),
proof AS (
  SELECT l.lang_no, l.pos, string_agg(t.h, '' ORDER BY t.level, t.pos) AS p
  FROM l JOIN t ON t.lang_no = l.lang_no AND t.n > 1 AND t.pos // 8 = l.pos // CAST(8 ** (t.level + 1) AS BIGINT) AND t.pos <> l.pos // CAST(8 ** t.level AS BIGINT) GROUP BY ALL
),
others AS (SELECT a.lang_no, string_agg(b.h, '' ORDER BY b.lang_no) AS p FROM t a JOIN t b ON a.n = 1 AND b.n = 1 AND a.lang_no <> b.lang_no GROUP BY ALL),
c AS (
  SELECT lang_no, pos AS leaf_pos, 0 AS level, pos, folded AS h FROM l
  UNION ALL
  SELECT c.lang_no, c.leaf_pos, c.level + 1, c.pos // 8, sha256(string_agg(CASE WHEN t.pos = c.pos THEN c.h ELSE t.h END, '' ORDER BY t.pos))
  FROM c JOIN t ON t.lang_no = c.lang_no AND t.level = c.level AND t.pos // 8 = c.pos // 8 AND t.n > 1 GROUP BY c.lang_no, c.leaf_pos, c.level, c.pos
),
top AS (SELECT lang_no, leaf_pos, max_by(h, level) AS h FROM c GROUP BY ALL),
folded AS (SELECT top.lang_no, leaf_pos, sha256(string_agg(CASE WHEN t.lang_no = top.lang_no THEN top.h ELSE t.h END, '' ORDER BY t.lang_no)) AS folded_root FROM top JOIN t ON t.n = 1 GROUP BY ALL)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(coalesce(proof.p, '') || coalesce(others.p, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN t s ON s.lang_no = l.lang_no AND s.n = 1 JOIN r ON true JOIN folded f ON f.lang_no = l.lang_no AND f.leaf_pos = l.pos
LEFT JOIN proof ON proof.lang_no = l.lang_no AND proof.pos = l.pos LEFT JOIN others ON others.lang_no = l.lang_no
"""
ORACLE: dict[str, str] = {"op6_difference_cover": OP6_SQL, "op12_threshold_algorithm": OP12_SQL, "op13_recursive_climb": OP13_SQL}
