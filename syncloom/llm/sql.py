"""DuckDB SQL of the operators' queries that SQL can express, over whole tables."""

from __future__ import annotations

from .chat import END, ESCAPES, TEXT, TURN
from .common import ASCII_LOWER, ASCII_UPPER
from .reputation import ADDRESS, DEVIATIONS, LEAST, LIMIT, MOST, RULES, SUFFIXES

JACCARD = rf"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                                                  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
        l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
        r AS (SELECT x AS id, x AS reached FROM l UNION SELECT r.id, l.y FROM r JOIN l ON l.x = r.reached)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component, d.doc_id) AS component_id
    FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT id, min(reached) AS component FROM r GROUP BY id) m ON m.id = d.doc_id"""


def _escaped(c: str) -> str:
    for raw, safe in ESCAPES:
        c = f"replace({c}, '{raw}', '{safe}')"
    return c


CHAT = f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
         g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                      coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
                      CAST(sum(length({_escaped("role")}) + length({_escaped("text")}) + {len(TURN) + len(TEXT) + len(END)}) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""

_FIT = " ".join(f"WHEN (q.host = '{h}' OR q.host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}:{v}'" for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1])))


def _level(name: str, by: str, rows: str) -> str:
    """Posterior of a level from its rows (by, n, k, m): the prior's strength s comes from all rows with n > 0."""
    return f"""
        {name}_s AS (SELECT round(least({MOST}, greatest({LEAST}, coalesce(CASE WHEN sum(n) - count(*) > 0 THEN CASE WHEN sum(n * (k / n - m) * (k / n - m)) - sum(m * (1 - m)) > 0
                         THEN sum(m * (1 - m)) / count(*) / ((sum(n * (k / n - m) * (k / n - m)) - sum(m * (1 - m))) / (sum(n) - count(*))) - 1 ELSE {MOST} END END, {MOST}))), 6) AS s FROM {rows} WHERE n > 0),
        {name} AS (SELECT {rows}.*, s, (m * s + k) / (s + n) AS mean FROM {rows}, {name}_s)"""


_LAST = lambda n: f"array_to_string(string_split(host, '.')[-{n}:], '.')"
_DOUBLE = f"{_LAST(2)} IN ({', '.join(repr(s) for s in SUFFIXES)})"
_IP = r"regexp_matches(host, '^([0-9.]+|\[.*)$')"

REPUTATION = f"""
    WITH u AS (SELECT page_id, CASE WHEN coalesce(position('://' IN url), 0) > 0 THEN substring(url, position('://' IN url) + 3) END AS rest FROM pages),
         q AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{ASCII_UPPER}', '{ASCII_LOWER}'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
         o AS (SELECT regexp_replace(q.host, '^.*@|:[0-9]*$', '', 'g') AS host, CASE WHEN quality IS NULL AND toxic IS NULL THEN NULL WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END AS bad FROM q LEFT JOIN labels l ON l.doc_id = q.page_id),
         hh AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k FROM o GROUP BY host),
         top AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS mean FROM hh),
         h0 AS (SELECT host, n, k, CASE WHEN {_IP} THEN '{ADDRESS}' WHEN {_DOUBLE} THEN {_LAST(2)} ELSE {_LAST(1)} END AS suffix, CASE WHEN {_IP} THEN host WHEN {_DOUBLE} THEN {_LAST(3)} ELSE {_LAST(2)} END AS domain FROM hh WHERE host <> ''),
         s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(top.mean) AS m FROM h0, top GROUP BY suffix), {_level("sx", "suffix", "s0")},
         d0 AS (SELECT a.suffix, a.domain, a.n, a.k, sx.mean AS m FROM (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM h0 GROUP BY suffix, domain) a JOIN sx ON sx.suffix = a.suffix), {_level("dm", "domain", "d0")},
         h1 AS (SELECT h0.host, h0.n, h0.k, dm.mean AS m FROM h0 JOIN dm ON dm.domain = h0.domain), {_level("ho", "host", "h1")},
         j AS (SELECT host, mean, round(mean - {DEVIATIONS} * sqrt(mean * (1 - mean) / (s + n + 1)), 9) AS low FROM ho),
         z AS (SELECT top.mean, round(top.mean - {DEVIATIONS} * sqrt(top.mean * (1 - top.mean) / (s + 1)), 9) AS low FROM top, ho_s),
         f AS (SELECT q.*, coalesce(j.mean, z.mean) AS mean, coalesce(j.low, z.low) AS low, CASE {_FIT} END AS fit FROM q CROSS JOIN z LEFT JOIN j ON j.host = regexp_replace(q.host, '^.*@|:[0-9]*$', '', 'g'))
    SELECT page_id, host, path, split_part(fit, ':', 1) AS rule, coalesce(split_part(fit, ':', 2), CASE WHEN low > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
           round(mean, 6) AS bad_share, round(low, 6) AS bad_share_low FROM f"""
