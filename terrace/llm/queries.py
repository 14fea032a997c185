"""Registered queries of this package: one per operator, over whole tables, and their SQL.

An operator's SQL is in ``ORACLES`` where DuckDB can express the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import decontamination, html_extraction, language, language_model, merkle, mixing, multiset_hash, packing, periodic_runs, personal_data, secrets_scan, simhash, toxicity
from terrace.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and of its edited text, and how alike they are."""
    return multiset_hash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside benchmark windows, the items found, and the verdict."""
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and maximum-entropy scores of each document."""
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each document and its component of near copies."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, from its text alone."""
    return language.identify(table(spark, sf_dir, "documents"))


def op6_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes, beside its source's size and target."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into rows of equal length."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document, told apart by how many sources own them."""
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document, from its text alone."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of each document, and whether it verifies after some were tampered with."""
    return merkle.documents_manifest(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document: what patterns find, and what a trained tagger adds."""
    return personal_data.documents_spans(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in each document, some given periodic ends."""
    return periodic_runs.documents_runs(table(spark, sf_dir, "documents"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_document_fingerprints,
        op2_benchmark_decontamination,
        op3_lm_scoring,
        op4_simhash_near_dedup,
        op5_language_id,
        op6_mixing_sources,
        op7_token_packing,
        op8_secret_scans,
        op9_html_extraction,
        op10_toxicity,
        op11_merkle_manifest,
        op12_personal_data,
        op13_periodic_runs,
    )
}

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SIZED = "coalesce(strlen(({0})::VARCHAR) || ':' || ({0})::VARCHAR, '-')"
_HEAD = " || ".join(_SIZED.format(name) for name in ("doc_id", "source", "lang"))

ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": f"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, w, least(13, len(w)) AS size
  FROM (SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents
), places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows))
), found AS (SELECT doc_id, i, places.size, item FROM places JOIN windows USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
""",
    "op8_secret_scans": r"""
WITH found AS (
  SELECT doc_id, row, source, rank, gaps, wholes, vals FROM (
    SELECT doc_id, row_number() OVER () AS row, source, coalesce(text, '') AS t FROM documents
  ), LATERAL (
    SELECT 0 AS rank, string_split_regex(t, '(?i:password|passwd|secret|token|api_?key)["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)') AS gaps,
           regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)') AS wholes,
           regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)', 1) AS vals
    UNION ALL SELECT 1, string_split_regex(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+')
    UNION ALL SELECT 2, string_split_regex(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+')
    UNION ALL SELECT 3, string_split_regex(t, '[A-Za-z0-9+/_-]+'), regexp_extract_all(t, '[A-Za-z0-9+/_-]+'), regexp_extract_all(t, '[A-Za-z0-9+/_-]+')
  )
), each AS (
  SELECT doc_id, row, source, rank, place, length(gaps[place]) AS gap, length(wholes[place]) AS size, vals[place] AS val
  FROM (SELECT *, unnest(range(1, len(wholes) + 1)) AS place FROM found)
), placed AS (
  SELECT doc_id, row, source, rank, size, val, sum(gap + size) OVER (PARTITION BY row, rank ORDER BY place) AS fin FROM each
), fit AS (
  SELECT doc_id, row, source, rank, val, (fin - size)::BIGINT AS beg, fin::BIGINT AS fin FROM placed
  WHERE length(val) >= CASE rank WHEN 0 THEN 8 WHEN 1 THEN 16 WHEN 2 THEN 32 ELSE 20 END
    AND (rank < 3 OR (regexp_matches(val, '[0-9].*[0-9]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[A-Z]')))
), kept AS (
  SELECT * FROM fit a WHERE rank < 3 OR NOT EXISTS (
    SELECT 1 FROM fit b WHERE b.rank < 3 AND b.row = a.row AND b.beg < a.fin AND a.beg < b.fin)
), owned AS (SELECT val, count(DISTINCT coalesce('s' || source, '')) AS n_owners FROM kept GROUP BY val),
told AS (SELECT kept.*, n_owners < 2 AS live, ['assign', 'access', 'hex', 'random'][rank + 1] || ':' || beg || ':' || fin AS label
         FROM kept JOIN owned USING (val) WHERE rank < 3 OR n_owners < 2),
spans AS (
  SELECT row, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS b, count(*) FILTER (rank = 2) AS c, count(*) FILTER (rank = 3) AS d,
         count(*) FILTER (live) AS l, string_agg(label, ',' ORDER BY beg, rank) FILTER (rank < 3) AS based, string_agg(label, ',' ORDER BY beg, rank) AS every
  FROM told GROUP BY row
)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(based, '')) AS base_sha256, coalesce(every, '') AS spans, coalesce(d, 0)::BIGINT AS n_random, coalesce(l, 0)::BIGINT AS n_live
FROM (SELECT doc_id, row_number() OVER () AS row FROM documents) LEFT JOIN spans USING (row)
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('s' || lang, '') AS grp, row_number() OVER () AS id, {_HEAD} AS head, {_SIZED.format("n_chars")} AS count,
         {_SIZED.format("n_chars::HUGEINT + 1")} AS more, {_SIZED.format("text")} AS tail,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
                     lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))) AS crc
  FROM documents
), leaves AS (
  SELECT id, doc_id, grp, leaf, CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN sha256(head || more || tail) ELSE leaf END AS start,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n
  FROM (SELECT *, sha256(head || count || tail) AS leaf FROM rows)
), tree(grp, level, place, n, node) AS (
  SELECT grp, 0, place, n, leaf FROM leaves
  UNION ALL
  SELECT grp, level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(node, '' ORDER BY place)) FROM tree WHERE n > 1 GROUP BY grp, level, place // 2
), subroots AS (
  SELECT grp, node, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), upper_tree(level, place, n, node) AS (
  SELECT 0, place, n, node FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(node, '' ORDER BY place)) FROM upper_tree WHERE n > 1 GROUP BY level, place // 2
), steps AS (
  SELECT l.id, t.level, (l.place >> t.level) % 2 AS slot, s.node AS sibling
  FROM leaves l JOIN tree t ON t.grp = l.grp AND t.place = l.place >> t.level AND t.n > 1
  LEFT JOIN tree s ON s.grp = t.grp AND s.level = t.level AND s.place = xor(t.place, 1)
  UNION ALL
  SELECT l.id, 100 + t.level, (r.place >> t.level) % 2, s.node
  FROM leaves l JOIN subroots r USING (grp) JOIN upper_tree t ON t.place = r.place >> t.level AND t.n > 1
  LEFT JOIN upper_tree s ON s.level = t.level AND s.place = xor(t.place, 1)
), proofs AS (
  SELECT id, list({{'slot': slot, 'node': coalesce(sibling, '')}} ORDER BY level) AS proof, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256
  FROM steps GROUP BY id
), folded(id, level, node, proof) AS (
  SELECT id, 0, start, coalesce(proof, []) FROM leaves LEFT JOIN proofs USING (id)
  UNION ALL
  SELECT id, level + 1, sha256(CASE WHEN proof[level + 1].slot = 1 THEN proof[level + 1].node || node ELSE node || proof[level + 1].node END), proof
  FROM folded WHERE level < len(proof)
)
SELECT doc_id, leaf, subroots.node AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded.node AS folded_root, folded.node = root AS verified
FROM leaves JOIN subroots USING (grp) CROSS JOIN (SELECT node AS root FROM upper_tree WHERE n = 1)
LEFT JOIN proofs USING (id) JOIN folded ON folded.id = leaves.id AND folded.level = len(folded.proof)
""",
}
