"""The registered queries of the training-data operators, one opN_<name> each, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import chat, covertree, decontaminate, fim, hamerly, langid, lm, minhash, mixing, packing, pii, secrets, toxicity
from panelforge.llm.common import crc_of_id, read_table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(read_table(spark, sf_dir, "conversations"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = covertree.quantise(read_table(spark, sf_dir, "embeddings"))
    return covertree.search(vectors, vectors.where("vec_id % 50 = 0"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.replace_entities(read_table(spark, sf_dir, "documents"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(read_table(spark, sf_dir, "documents", "doc_id", "text")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = langid.predict(docs, langid.train(docs), keep=["doc_id"])
    return out.select("doc_id", (crc_of_id() % 4 == 2).alias("held_out"), "lang_pred", "score")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), percent=85)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    lexicon = toxicity.train(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    out = toxicity.score_toxicity(docs, lexicon, keep=["doc_id"])
    return out.select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score", "predicted", "n_terms")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    out = decontaminate.find_contamination(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"), keep=["doc_id"])
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"), keep=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamerly.cluster(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(read_table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored()).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_exact_topk": op2_exact_topk,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_packing": op5_packing,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_decontamination": op10_decontamination,
    "op11_source_mix": op11_source_mix,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_fill_in_middle": op13_fill_in_middle,
}


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """Assignments and moves as one pair of CTEs a round."""
    steps = [f"""WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM v ORDER BY h, v LIMIT {k})
)"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS (
  SELECT vec_id, x.v AS v, min((d, c)) AS best
  FROM (SELECT p.vec_id, p.v, p.r, c.c, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM (SELECT *, row_number() OVER () AS r FROM v) p CROSS JOIN c{n} c) x
  GROUP BY r, vec_id, x.v
)""")
        if n < rounds:
            steps.append(f"""s{n} AS (
  SELECT c, i, sum(e) AS s, count(*) AS m FROM (SELECT best[2] AS c, unnest(v) AS e, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY c, i
), m{n} AS (
  SELECT c, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS v FROM s{n} GROUP BY c
), c{n + 1} AS (
  SELECT c{n}.c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (c)
)""")
    return ", ".join(steps) + f"""
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance,
       CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best[2]"""


ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": """
WITH numbered AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), spelled AS (
  SELECT conv_id, n,
         string_agg(coalesce('s' || length(role) || ':' || role, 'n') || coalesce('s' || length(text) || ':' || text, 'n'), '|')
           OVER (PARTITION BY conv_id ORDER BY n) AS prefix,
         string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '')
           OVER (PARTITION BY conv_id ORDER BY n) AS rendered,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM numbered
), whole AS (
  SELECT prefix, min(conv_id) AS conv_id, min(n_turns) AS n_turns, count(*) AS n_copies, min(rendered) AS rendered
  FROM spelled WHERE n = n_turns GROUP BY prefix
)
SELECT conv_id, n_turns, n_copies, rendered FROM whole
WHERE prefix NOT IN (SELECT prefix FROM spelled WHERE n < n_turns)
""",
    "op2_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op8_minhash_dedup": """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
  HAVING 100 * count(*) >= 85 * ((SELECT n FROM sizes WHERE doc_id = x.doc_id) + (SELECT n FROM sizes WHERE doc_id = y.doc_id) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN components USING (doc_id)
""",
    "op10_decontamination": """
WITH letters AS (
  SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small
), doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), big, small), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents, letters
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, big, small), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark, letters WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)
), hits AS (
  SELECT p.doc_id, p.i, p.size, k.item_id FROM places p JOIN windows k ON p.s = k.s AND p.size = k.size
), counted AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN counted USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op11_source_mix": """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS most FROM sources
), ordered AS (
  SELECT *, most / weight AS ratio, sum(most) OVER o AS limits, sum(weight) OVER o AS weights, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS every
  FROM weighed WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), reached AS (
  SELECT coalesce(max(limits), 0) AS limits, coalesce(max(weights), 0) AS weights FROM ordered WHERE limits + ratio * (every - weights) <= total
), aimed AS (
  SELECT source, source_size, least((total - r.limits) / nullif(every - r.weights, 0) * weight, most) AS target FROM ordered, reached r
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM aimed
), summed AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS rest, sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN rest > 0 AND (upto <= rest OR (upto - size < rest AND 2 * (rest - (upto - size)) >= size)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
""",
    "op12_centroid_clusters": _clusters_sql(),
    "op13_fill_in_middle": """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS t,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM cut
), parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(t[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
         array_to_string(t[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
         array_to_string(t[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
