"""DuckDB SQL for what it can express of the ten operators' queries."""

#: Fixed rules of the URL query.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]

_FIT = "\n".join(
    f"    WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN ['{h}/{p}', '{v}']"
    for h, p, v in sorted(((*rule.split("/", 1), v) for rule, v in URL_RULES), key=lambda r: -len(r[0]) - len(r[1]))
)


def _flow(name: str, seed: str, a: str, b: str) -> str:
    return f"""
{name}_deg AS (SELECT {a} AS src, count(*) AS deg FROM edges GROUP BY 1),
{name}_flow AS (
  SELECT 0 AS i, host, {seed} * 0.15000000000000002::DOUBLE AS score FROM hosts WHERE {seed} > 0
  UNION ALL
  SELECT i + 1, e.{b}, sum(f.score * (0.85::DOUBLE / d.deg)) FROM {name}_flow f JOIN edges e ON e.{a} = f.host JOIN {name}_deg d ON d.src = f.host WHERE i < 60 GROUP BY i, e.{b}),
{name} AS (SELECT host, sum(score) AS score FROM {name}_flow GROUP BY host)"""


#: Trust and distrust are summed over walks of up to 60 links; the verdict is what is compared.
URLS = rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS (SELECT *, CASE
{_FIT}
  END AS best FROM parts),
hosts AS (SELECT host, avg(CASE WHEN best[2] = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS allow, avg(CASE WHEN best[2] = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS block FROM ruled WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)', 1)) AS dst FROM parts WHERE host <> ''),
edges AS (SELECT DISTINCT src, translate(dst, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM links WHERE src <> translate(dst, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
{_flow("trust", "allow", "src", "dst")}, {_flow("distrust", "block", "dst", "src")}
SELECT page_id, r.host, path, best[1] AS rule,
       coalesce(best[2], CASE WHEN coalesce(d.score, 0) - coalesce(t.score, 0) > 0.5 * 0.15000000000000002::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN trust t ON t.host = r.host LEFT JOIN distrust d ON d.host = r.host
"""

_SPACE = r"[ \t\n\x0b\f\r]+"
_NOT_SPACE = r"[^ \t\n\x0b\f\r]"

QUALITY_COUNTS = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{_SPACE}'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_NOT_SPACE}')) AS l FROM t),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i : i + 7], ' ')) AS n FROM places),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again WHERE n > 1) GROUP BY doc_id),
c AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
      (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c
"""

PII_COUNTS = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email,
      list_filter(regexp_extract_all(t, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'), lambda m: list_bool_and(list_transform(string_split(m, '.'), lambda p: length(ltrim(p, '0')) <= 3 AND coalesce(try_cast(ltrim(p, '0') AS INT), 0) <= 255))) AS ip,
      list_filter(list_transform(regexp_extract_all(t, '[0-9](?:[ -]?[0-9])+'), lambda m: reverse(regexp_replace(m, '[^0-9]', '', 'g'))), lambda d: length(d) BETWEEN 13 AND 19) AS card,
      list_filter(regexp_extract_all(t, '\+[0-9][ ().0-9-]+[0-9]'), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 9 AND 15) AS phone FROM t),
luhn AS (SELECT *, list_filter(card, lambda d: list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN d[i + 1]::INT ELSE d[i + 1]::INT * 2 - CASE WHEN d[i + 1]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0) AS good FROM f)
SELECT doc_id, len(email)::BIGINT AS n_email, len(ip)::BIGINT AS n_ip, len(good)::BIGINT AS n_card, len(phone)::BIGINT AS n_phone FROM luhn
"""
