"""SQL (DuckDB) of the queries that SQL can express, written from their meaning: plain joins and
regular expressions, no lists of neighbours and no transducers."""

from __future__ import annotations


def _nearest(name: str, book: str) -> str:
    return f"""{name} AS MATERIALIZED (
        SELECT r, p, min((t.size - 2 * CAST(list_inner_product(t.w, b.w) AS BIGINT) + b.size) * 256 + b.e) AS best
        FROM parts t JOIN {book} b USING (p) GROUP BY r, p)"""


def _moved(name: str, book: str, best: str) -> str:
    return f"""{name}_means AS (
        SELECT p, e, i, CAST((s - ((s % n) + n) % n) // n AS DOUBLE) AS x FROM (
            SELECT p, best % 256 AS e, i, CAST(sum(CAST(w[i] AS BIGINT)) AS BIGINT) AS s, count(*) AS n
            FROM {best} JOIN parts USING (r, p), (SELECT unnest(range(1, (SELECT max(len(w)) + 1 FROM parts))) AS i)
            GROUP BY p, e, i)),
    {name} AS MATERIALIZED (
        SELECT b.p, b.e, coalesce(m.w, b.w) AS w,
               CAST(list_inner_product(coalesce(m.w, b.w), coalesce(m.w, b.w)) AS BIGINT) AS size
        FROM {book} b LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS w FROM {name}_means GROUP BY p, e) m
        ON b.p = m.p AND b.e = m.e)"""


# Integer components as doubles, which hold them and their inner products exactly.
_CODES = f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v,
           row_number() OVER () AS r
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
    SELECT r, vec_id, p, w, CAST(list_inner_product(w, w) AS BIGINT) AS size FROM (
        SELECT r, vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS w
        FROM kept, (SELECT unnest(range(4)) AS p))),
b0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, w, size FROM parts
    WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)),
{", ".join(f"{_nearest(f'a{i}', f'b{i}')}, {_moved(f'b{i + 1}', f'b{i}', f'a{i}')}" for i in range(4))},
{_nearest("a4", "b4")},
coded AS (
    SELECT r, string_agg(format('{{:02x}}', CAST(best % 256 AS INTEGER)), '' ORDER BY p) AS code,
           CAST(sum(best // 256) AS BIGINT) AS error
    FROM a4 GROUP BY r),
digest AS (
    SELECT sha256(string_agg(CAST(CAST(w[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS d
    FROM b4, (SELECT unnest(range(1, (SELECT max(len(w)) + 1 FROM parts))) AS i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       d AS codebooks_sha256
FROM coded JOIN kept USING (r), digest"""


_P = "1 + 1000000000::HUGEINT * ({n} + 2) // ({total} + 2 * v)"

_DIVERGENCE = f"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents),
used AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM docs),
kept AS MATERIALIZED (
    SELECT lang, term FROM used GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
sized AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
occurring AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM used JOIN kept USING (lang, term) GROUP BY ALL),
counted AS MATERIALIZED (
    SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total
    FROM occurring JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
of_lang AS (
    SELECT lang, term, sum(n) AS lang_n, sum(sum(n)) OVER (PARTITION BY lang) AS lang_total
    FROM counted GROUP BY lang, term),
shares AS MATERIALIZED (
    SELECT lang, source, term, n, {_P.format(n="n", total="total")} AS p,
           {_P.format(n="lang_n", total="lang_total")} AS q
    FROM counted JOIN sized USING (lang) JOIN of_lang USING (lang, term)),
pairs AS (
    SELECT a.lang, a.source, b.source AS item,
           CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source),
every_pair AS (
    SELECT a.lang, a.source, b.source AS item FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value FROM every_pair LEFT JOIN pairs USING (lang, source, item)
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= 10"""

STATEMENTS = {"op11_orchard_codes": _CODES, "op13_source_divergence": _DIVERGENCE}
