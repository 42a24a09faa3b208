"""The queries of this subpackage, each an operator with production parameters over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, html_crf, licenses, mixing, neardup, pieces, quality, repeats, topk, toxicity
from .common import Scratch, read

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), Scratch(spark, "op1"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.flagged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), Scratch(spark, "op2"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.main_text(read(spark, sf_dir, "pages"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = repeats.remove_repeats(docs, Scratch(spark, "op4"))
    return out.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), 20, 20, Scratch(spark, "op5"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(pieces.encode_decode(docs, pieces.model_bytes(tokenizer_path())))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, Scratch(spark, "op7"), narrow=True)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprint.fingerprints(read(spark, sf_dir, "documents"), Scratch(spark, "op8"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, Scratch(spark, "op10"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_quality, op2_toxicity, op3_main_text, op4_repeats, op5_topk, op6_pieces, op7_mix, op8_fingerprint, op9_licenses, op10_neardup)
    return {f.__name__: f for f in every}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i, md5(substr(hx, 2 * i + 1, 400)) AS s
  FROM (SELECT doc_id, hx, unnest(range(0, n - 199)) AS i FROM d WHERE n >= 200)
), r AS (
  SELECT doc_id, i FROM w WHERE s IN (SELECT s FROM w GROUP BY s HAVING count(*) > 1)
), g AS (
  SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 1 ELSE 0 END AS gap FROM r
), k AS (
  SELECT doc_id, i, sum(gap) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM k GROUP BY doc_id, run
), edges AS (
  SELECT d.doc_id, hx, n, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS lo, a AS hi FROM d JOIN runs USING (doc_id)
  UNION ALL
  SELECT d.doc_id, hx, n, coalesce(e.b, 0), n FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM runs GROUP BY 1) e USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(substr(hx, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo, hi) AS hx, count(*) - 1 AS n_spans, sum(hi - lo) AS n_kept FROM edges GROUP BY 1
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(d.n - n_kept AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
  sha256(unhex(kept.hx)) AS kept_sha256
FROM d JOIN kept USING (doc_id)
"""

OP10_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[]
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w
), e AS (SELECT doc_id, unnest(sh) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
  WHERE 100 * n_both >= 75 * (len(sa.sh) + len(sb.sh) - n_both)
), reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT r.doc_id, t.v FROM reach r JOIN (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l) t ON r.root = t.u
), c AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN c USING (doc_id)
"""


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20
"""

OP7_SQL = r"""
WITH m AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[#$%&*|!<>{}=~^_\\]')) AS DOUBLE) AS symbols,
    (CAST(('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents
), k AS (
  SELECT doc_id, source, size, -ln(u) / greatest(CAST(0.1 AS DOUBLE), CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + CAST(2.0 AS DOUBLE) * symbols / greatest(size, 1))) AS key FROM m
), s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM k GROUP BY source
), w AS (
  SELECT source, source_size, 2 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN CAST(5 AS DOUBLE) WHEN 1 THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight FROM s
), l AS (
  SELECT *, row_number() OVER o AS nth, cap / weight AS ratio,
    (1.5 * sum(source_size) OVER () - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS FIRST ROWS UNBOUNDED PRECEDING)
), t AS (
  SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, nth) FROM l WHERE ratio >= level)) AS target FROM l
), e AS (
  SELECT source, source_size, target, floor(target / nullif(source_size, 0)) AS epochs, target - floor(target / nullif(source_size, 0)) * source_size AS missing FROM t
), c AS (
  SELECT k.doc_id, k.size, e.*, sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(CASE WHEN size = 0 THEN 0 ELSE size * (epochs + CASE WHEN missing > 0 AND (upto <= missing OR upto - missing < missing - (upto - size)) THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM c
"""


def _op9_sql() -> str:
    def text(x: str) -> str:
        return "'" + x + "'"

    rows = ", ".join(f"({k}, {text(t.label)}, {str(t.base).lower()}, {i}, {text(w)}, {str(t.key_at <= i < t.key_at + len(t.key)).lower()})" for k, t in enumerate(licenses.templates()) for i, w in enumerate(t.words))
    return f"""
WITH p(t, label, base, place, word, must) AS (VALUES {rows}
), d AS (
  SELECT row_number() OVER () AS f, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), w AS (
  SELECT f, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM d
), v AS (
  SELECT f, pos, word FROM w WHERE word IN (SELECT word FROM p)
), c AS (
  SELECT word, count(DISTINCT f) AS n FROM v GROUP BY 1
), i AS (
  SELECT p.*, ln(CAST((SELECT count(*) FROM d) + 1 AS DOUBLE) / (coalesce(c.n, 0) + CAST(0.5 AS DOUBLE))) AS idf FROM p LEFT JOIN c USING (word)
), b AS (
  SELECT f, t, pos - place AS start FROM v JOIN (SELECT t, min(place) AS place, arg_min(word, place) AS word FROM p WHERE must GROUP BY 1) k USING (word)
), m AS (
  SELECT b.f, b.t, b.start, min(i.label) AS label, bool_or(i.base) AS base, sum(CASE WHEN v.f IS NULL THEN 0 ELSE i.idf END) / sum(i.idf) AS share,
    bool_and(v.f IS NOT NULL OR NOT i.must) AS whole
  FROM b JOIN i ON i.t = b.t LEFT JOIN v ON v.f = b.f AND v.pos = b.start + i.place AND v.word = i.word GROUP BY 1, 2, 3
), g AS (
  SELECT f, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ',') AS base_labels, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels,
    round(least(max(share), CAST(1 AS DOUBLE)), 6) AS score
  FROM m WHERE whole AND share >= {licenses.SHARE} GROUP BY f
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, CAST(0 AS DOUBLE)) AS score
FROM d LEFT JOIN g USING (f)
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_licenses": _op9_sql(), "op5_topk": OP5_SQL, "op7_mix": OP7_SQL, "op4_repeats": OP4_SQL, "op10_neardup": OP10_SQL}
