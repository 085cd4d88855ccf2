"""DuckDB SQL for the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
cut AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, k, k + least(10, len(w)) - 1), ' ') AS x, least(10, len(w)) AS n FROM cut),
sizes AS (SELECT DISTINCT n FROM win),
spot AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT rid, k, spot.n, item_id FROM spot JOIN win ON win.n = spot.n AND win.x = array_to_string(list_slice(w, k, k + spot.n - 1), ' ')),
word AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hit) GROUP BY rid),
item AS (SELECT rid, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (rid) LEFT JOIN item USING (rid)
"""

OP4 = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS own, list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.own, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.own <> c.own),
r AS (SELECT query_id, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first_id FROM h),
t AS (SELECT *, first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again,
        list_transform(range(0, 8), lambda g: ('0x' || substr(hex, 1 + 5 * g::INTEGER, 5))::BIGINT) AS parts FROM g)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(parts, lambda x: array_to_string(list_transform([32768, 1024, 32, 1],
         lambda y: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // y % 32 + 1)::INTEGER, 1)), '')), '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM t
"""

# Texts as hexadecimal digits, two per byte; windows by a 64-bit hash of their digits.
OP7 = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
cut AS (SELECT rid, h, unnest(range(0, len(h) // 2 - 199)) AS s FROM d),
win AS (SELECT rid, s, hash(substr(h, (2 * s + 1)::INTEGER, 400)) AS x FROM cut),
many AS (SELECT x FROM win GROUP BY x HAVING count(*) > 1),
dup AS (SELECT rid, s FROM win SEMI JOIN many USING (x)),
mark AS (SELECT rid, s, CASE WHEN s <= lag(s) OVER (PARTITION BY rid ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh FROM dup),
numbered AS (SELECT rid, s, sum(fresh) OVER (PARTITION BY rid ORDER BY s) AS run FROM mark),
run AS (SELECT rid, run, min(s) AS a, max(s) + 200 AS b FROM numbered GROUP BY rid, run),
gap AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS from_ FROM run),
part AS (SELECT g.rid, a, b, substr(h, (2 * from_ + 1)::INTEGER, (2 * (a - from_))::INTEGER) AS keep FROM gap g JOIN d USING (rid)),
doc AS (SELECT rid, string_agg(keep, '' ORDER BY a) AS keep, max(b) AS last, sum(b - a) AS removed, count(*) AS runs FROM part GROUP BY rid)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(keep, '') || substr(h, (2 * coalesce(last, 0) + 1)::INTEGER))) AS kept_sha256
FROM d LEFT JOIN doc USING (rid)
"""

_LIST = "(VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) AS r(h, p, v)"
_PATTERNS = r"(^|[.-])spam-[a-z0-9-]*\.|(^|\.)cheap-pills\.|(^|[./-])(free-)?casino([./-]|$)|(^|[./-])free-download([./-]|$)|(^|[./-])xxx([./-]|$)"

OP10 = f"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT rid, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT rid, max({{'n': length(h || p), 'rule': h || p, 'v': v}}) AS best FROM s, {_LIST}
      WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.v, CASE WHEN regexp_matches(host || path, '{_PATTERNS}') THEN 'block' ELSE 'allow' END) AS verdict
FROM s LEFT JOIN f USING (rid)
"""


# Windows by a 64-bit hash of their words; the words go on from one row's last to the next row's first.
OP13 = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
cut AS (SELECT rid, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50),
win AS (SELECT rid, doc_id, s, hash(array_to_string(list_slice(w, s, s + 49), ' ')) AS x FROM cut),
least AS (SELECT x, min(doc_id) AS low FROM win GROUP BY x HAVING count(*) > 1),
dup AS (SELECT rid, s FROM win JOIN least USING (x) WHERE low < coalesce(doc_id, 9223372036854775807)),
gone AS (SELECT DISTINCT rid, unnest(range(s, s + 50)) AS p FROM dup),
word AS (SELECT rid, doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


def _op12(k: int = 40, rounds: int = 5) -> str:
    """One assignment and one replacement per round, each computed once."""
    parts = ["""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", f"""
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, embedding) - 1)::INTEGER AS c, q FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, embedding) <= {k})"""]  # fmt: skip
    for r in range(rounds + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT rid, c, list_sum(list_transform(list_zip(v.q, c{r}.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM v, c{r})
  GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""
s{r} AS (SELECT best.c AS c, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM (SELECT best, unnest(q) AS x, unnest(range(1, 65)) AS i FROM a{r} JOIN v USING (rid)) GROUP BY ALL),
m{r} AS (SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS q FROM s{r} GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m{r}.q, c{r}.q) AS q FROM c{r} LEFT JOIN m{r} USING (c))""")
    return "WITH" + ",".join(parts) + f"""
SELECT vec_id, best.c AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} ON c{rounds}.c = best.c
"""


ORACLES = {
    "op2_decontamination": OP2,
    "op4_top_inner_products": OP4,
    "op6_warc": OP6,
    "op7_suffix_dedup": OP7,
    "op10_url_filter": OP10,
    "op12_centroid_clusters": _op12(),
    "op13_substring_dedup": OP13,
}
