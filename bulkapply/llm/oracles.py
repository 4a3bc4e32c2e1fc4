"""The SQL, for DuckDB, of those queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_FILTERS = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, {_LOWER.format("regexp_extract(r, '^[^/?#]*')")} AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
  END AS rule FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN regexp_matches(host, '^m\.|casino|pills|bets|ads-') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

LINE_DEDUP = rf"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM parts
), keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines
), many AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, line, place, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN many USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
# SHA-1 in base 32: five hexadecimal digits are four of its digits. Records of equal payload refer to the one of the smallest id.
WARC = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), digits AS (
  SELECT page_id, payload_bytes, list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT)) AS parts FROM hashed
), digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(parts, lambda x: concat(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> 15) & 31 AS INTEGER) + 1, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> 10) & 31 AS INTEGER) + 1, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> 5) & 31 AS INTEGER) + 1, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(x & 31 AS INTEGER) + 1, 1))), '') AS payload_digest FROM digits
), led AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, CASE WHEN page_id = first THEN true END AS digest_holds
FROM led
"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Each round as two views: the nearest entry of each part, and the entries moved to their parts' means."""
    nearest = """a{r} AS MATERIALIZED (
  SELECT vec_id, part, unnest(min({{'d': d, 'entry': entry}})) FROM (
    SELECT vec_id, part, entry, sum((x - y) * (x - y)) AS d FROM cells JOIN b{r} USING (part, place) GROUP BY vec_id, part, entry
  ) GROUP BY vec_id, part)"""
    after = """b{n} AS MATERIALIZED (
  SELECT part, place, entry, coalesce(mean, y) AS y FROM b{r} LEFT JOIN (
    SELECT part, entry, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean FROM a{r} JOIN cells USING (vec_id, part)
    GROUP BY part, entry, place) USING (part, place, entry))"""
    steps = [step.format(r=r, n=r + 1) for r in range(rounds) for step in (nearest, after)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // {parts} AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT vec_id, (i - 1) // width AS part, (i - 1) % width AS place, CAST(floor(4096 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}
), b0 AS MATERIALIZED (
  SELECT part, place, entry, x AS y FROM cells JOIN seeds USING (vec_id)
), {", ".join(steps)}, {nearest.format(r=rounds)}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, place)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filters": URL_FILTERS, "op3_warc": WARC, "op11_vector_codes": vector_codes(), "op12_line_dedup": LINE_DEDUP}
