"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywatch.llm import fingerprints, licences, neardup, packing, personal, repeats, sharding, subwords, topk, toxicity, variants, vectorcodes, webtext
from tallywatch.llm.common import ready, table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(ready(spark), sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(ready(spark), sf_dir, "embeddings"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(ready(spark), sf_dir, "documents"), k=3, percent=85)


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removals(table(ready(spark), sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(ready(spark), sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(ready(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_text(table(ready(spark), sf_dir, "documents"))


def op8_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subwords.digests(table(ready(spark), sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.spans(table(ready(spark), sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(table(ready(spark), sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(ready(spark), sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(table(ready(spark), sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.digests(table(ready(spark), sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_fingerprints, op2_top_k, op3_near_duplicates, op4_repeats, op5_best_fit_packing, op6_toxicity, op7_licence_scan, op8_subwords, op9_personal_data, op10_main_text, op11_spelling_variants, op12_sharding, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {"op2_top_k": TOP_K, "op7_licence_scan": licences.oracle(), "op11_spelling_variants": SPELLING_VARIANTS, "op13_vector_codes": _vector_codes()}


def _vector_codes(rounds: int = vectorcodes.ROUNDS) -> str:
    """Every part against every entry; distances as |x|^2 - 2 x e + |e|^2, whole numbers that a double holds."""
    near = """
        SELECT r, p, arg_min(i, (d, i)) AS i, min(d) AS d
        FROM (SELECT r, p, i, list_inner_product(x, x) - 2 * list_inner_product(x, e) + list_inner_product(e, e) AS d
              FROM parts JOIN book{0} USING (p)) GROUP BY r, p"""
    steps = [f"""
    near{n} AS MATERIALIZED ({near.format(n)}),
    mean{n} AS (
        SELECT p, i, nth, floor(sum(x[nth]) / count(*)) AS c
        FROM (SELECT p, near{n}.i, x, unnest(range(1, len(x) + 1)) AS nth FROM near{n} JOIN parts USING (r, p)) GROUP BY p, i, nth),
    book{n + 1} AS MATERIALIZED (
        SELECT p, i, coalesce(m.e, book{n}.e) AS e
        FROM book{n} LEFT JOIN (SELECT p, i, list(c ORDER BY nth) AS e FROM mean{n} GROUP BY p, i) m USING (p, i))"""
             for n in range(rounds)]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
               list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
        SELECT r, p, v[p * len(v) // 4 + 1: (p + 1) * len(v) // 4] AS x FROM (SELECT *, unnest(range(4)) AS p FROM kept)),
    book0 AS MATERIALIZED (SELECT p, r - 1 AS i, x AS e FROM parts WHERE r <= 256),{",".join(steps)},
    nearest AS MATERIALIZED ({near.format(rounds)}),
    sha AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, i, nth)) AS s
            FROM (SELECT p, i, unnest(e) AS c, unnest(range(len(e))) AS nth FROM book{rounds})),
    coded AS (SELECT r, string_agg(format('{{:02x}}', i), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM nearest GROUP BY r)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
    FROM coded JOIN kept USING (r), sha
    """


TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asking AS (SELECT vec_id, v FROM whole WHERE vec_id % 50 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v) = 1),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM asking q JOIN whole c ON q.vec_id <> c.vec_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
# Deletion neighbours joined; crc32 by its table of 256 values, made from the polynomial.
SPELLING_VARIANTS = """
WITH RECURSIVE poly AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM poly WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM poly WHERE k = 8),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents),
lowered AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs),
seen AS (SELECT id, run, count(*) AS n FROM lowered WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (SELECT id, run, n, flatten(list_transform(list_transform(string_split(id || ':' || run, ''), lambda x: unicode(x)),
   lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END)) AS b FROM seen),
hashed AS (SELECT id, run, n, xor(list_reduce(list_prepend(4294967295, list_transform(b, lambda x: CAST(x AS BIGINT))), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
kept AS (SELECT CASE WHEN h % 199 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS MATERIALIZED (SELECT DISTINCT word, n, pos, word[: pos] || word[pos + 2 :] AS rest FROM (SELECT *, unnest(range(length(word))) AS pos FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b USING (pos, rest) WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, other)) AS best FROM near GROUP BY word),
known AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
path AS (SELECT word, word AS root FROM known UNION ALL SELECT path.word, known.form FROM path JOIN known ON path.root = known.word WHERE known.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM path JOIN known USING (word)
WHERE root NOT IN (SELECT word FROM known WHERE form IS NOT NULL)
"""
