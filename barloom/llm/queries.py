"""The corpus operators over the given tables with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    divergence,
    exact_dedup,
    jaccard,
    merkle,
    mixing,
    packing,
    pii,
    pii_examples,
    quality_pu,
    repeats,
    runs,
    token_counts,
    toxicity,
    url_rules,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.fit_examples(pii_examples.examples(spark))
    return pii.find_pii(table(spark, sf_dir, "documents"), field)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op8_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_rules(table(spark, sf_dir, "documents"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.span_counts(repeats.repeated_ranges(table(spark, sf_dir, "documents")))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents' words, every tenth document with a repeated tail."""
    docs = table(spark, sf_dir, "documents")
    return runs.run_digests(runs.find_runs(docs, rewrite=runs.repeat_tail))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering lower-cases the text of documents whose crc32 is divisible by five."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return merkle.verified_manifest(
        table(spark, sf_dir, "documents"),
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
        F.translate("text", upper, upper.lower()),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this subpackage

    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_pii,
        op3_quality,
        op4_exact_dedup,
        op5_url_rules,
        op6_mixing,
        op7_toxicity,
        op8_divergence,
        op9_jaccard,
        op10_packing,
        op11_repeats,
        op12_runs,
        op13_merkle,
        pipeline,
    )
}


def _levels_sql(name: str, levels: int) -> str:
    """Levels over ``{name}_0 (series, pos, n, node)``: runs of sixteen, and the rows above them."""
    return "".join(
        f"""
{name}_r{k} AS (
  SELECT series, pos // 16 AS pos, any_value(n) AS n, list(node ORDER BY pos) AS nodes
  FROM {name}_{k} GROUP BY ALL),
{name}_{k + 1} AS (
  SELECT series, pos, (n + 15) // 16 AS n,
         CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node
  FROM {name}_r{k}),"""
        for k in range(levels)
    )


def _folds_sql(name: str, tree: str, levels: int) -> str:
    """``{name}_f0 (series, place, h, siblings, ...)`` folded with the runs of ``tree``."""
    left = "array_to_string(r.nodes[1:place % 16], '')"
    right = "array_to_string(r.nodes[place % 16 + 2:], '')"
    return "".join(
        f"""
{name}_f{k + 1} AS (
  SELECT f.* EXCLUDE (place, h, siblings), place // 16 AS place,
         CASE WHEN r.n > 1 THEN sha256({left} || h || {right}) ELSE h END AS h,
         CASE WHEN r.n > 1 THEN siblings || {left} || {right} ELSE siblings END AS siblings
  FROM {name}_f{k} f JOIN {tree}_r{k} r ON f.series = r.series AND f.place // 16 = r.pos),"""
        for k in range(levels)
    )


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


_LEAF_SQL = " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))

_TAMPERED_SQL = """
CASE WHEN crc32 % 5 = 0
     THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"""

LLM_ORACLES = {
    "op13_merkle": f"""
WITH RECURSIVE t(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM t WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS steps FROM t WHERE k = 8),
chars(doc_id, k, c) AS (
  SELECT doc_id, 0, 4294967295 FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, k + 1, xor(c >> 8, steps[xor(c, ascii(substr(doc_id::VARCHAR, k + 1, 1))) % 256 + 1])
  FROM chars, crc WHERE k < len(doc_id::VARCHAR)),
hashed AS (
  SELECT doc_id, xor(c, 4294967295) AS crc32 FROM chars WHERE k = len(doc_id::VARCHAR)),
leaves AS (
  SELECT d.doc_id, d.source, {_field_sql("source")} AS series,
         sha256({_LEAF_SQL} || {_field_sql("text")}) AS node,
         sha256({_LEAF_SQL} || {_field_sql(_TAMPERED_SQL)}) AS start
  FROM documents d LEFT JOIN hashed USING (doc_id)),
d_0 AS (
  SELECT *, row_number() OVER (w ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER w AS n
  FROM leaves WINDOW w AS (PARTITION BY series)),
{_levels_sql("d", 6)}
d_f0 AS (SELECT *, pos AS place, start AS h, '' AS siblings FROM d_0),
{_folds_sql("d", "d", 6)}
subroots AS (SELECT series AS of_series, node FROM d_6),
s_0 AS (
  SELECT '' AS series, of_series, node, count(*) OVER () AS n,
         row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos
  FROM subroots JOIN (SELECT DISTINCT series AS of_series, source FROM leaves) USING (of_series)),
{_levels_sql("s", 4)}
c_f0 AS (
  SELECT '' AS series, d.doc_id, d.node AS leaf, d.siblings AS below, s.node AS subroot,
         s.pos AS place, d.h, '' AS siblings
  FROM d_f6 d JOIN s_0 s ON d.series = s.of_series),
{_folds_sql("c", "s", 4)}
root AS (SELECT node AS root FROM s_4)
SELECT doc_id, leaf, subroot, root, sha256(below || siblings) AS proof_sha256,
       h AS folded_root, h = root AS verified
FROM c_f4, root
""",
    "op4_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM d JOIN g USING (text)
""",
    "op6_mixing": r"""
WITH d AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS shuffled,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_no
  FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][((source_no - 1) % 3 + 1)::INT]::DOUBLE AS weight,
             2.0::DOUBLE * source_size AS cap FROM s),
o AS (
  SELECT *, row_number() OVER o AS place,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
          - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
l AS (SELECT arg_min(level, place) AS shared FROM o WHERE cap > level * weight),
t AS (
  SELECT source, source_no, source_size,
         CASE WHEN shared IS NULL OR shared * weight > cap THEN cap ELSE shared * weight END AS target
  FROM o, l),
q AS (
  SELECT d.doc_id, d.size, t.source_no, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY t.source_no ORDER BY shuffled)::BIGINT AS words
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (
  SELECT *, (round * source_size + words)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1)) r(round) WHERE size > 0 AND target > 0),
served AS (
  SELECT doc_id, size,
         sum(size) OVER (ORDER BY finish, source_no, round, words)
           <= (SELECT sum(target) FROM t) AS fits
  FROM f),
n AS (SELECT doc_id, count(*) AS times FROM served WHERE fits GROUP BY doc_id)
SELECT q.doc_id, q.size::BIGINT AS size, q.source_size, q.target,
       (q.size * coalesce(n.times, 0))::BIGINT AS taken
FROM q LEFT JOIN n USING (doc_id)
""",
}
