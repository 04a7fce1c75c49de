"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from .hosts import ordered_rules
from .templates import UNITS


def host_graph_sql(allow: list[str], block: list[str], threshold: float = 0.05, rounds: int = 80, follow: float = 0.85) -> str:
    """Rules, seeds and all rounds of trust and distrust, one common table expression each."""
    def case(column: int) -> str:
        fits = [(h, p, (r, v)[column]) for h, p, r, v in ordered_rules(allow, block)]
        return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{x}'" for h, p, x in fits) + " END"

    def lower(c: str) -> str:
        return f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    link = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)"""
    parts = [f"""urls AS MATERIALIZED (SELECT page_id, html, {lower("regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1)")} AS host,
  regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
             f"judged AS MATERIALIZED (SELECT page_id, host, path, {case(0)} AS rule, {case(1)} AS given FROM urls)",
             f"""links AS MATERIALIZED (SELECT host AS source, {lower("target")} AS target, count(*)::DOUBLE AS weight
  FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS target FROM urls) WHERE host <> '' AND host <> {lower("target")} GROUP BY ALL)""",
             """seeds AS MATERIALIZED (SELECT host, (2 * a > n OR (a > 0 AND b = 0))::INT AS trusted, (2 * b > n)::INT AS blocked
  FROM (SELECT host, count(*) AS n, count_if(given = 'allow') AS a, count_if(given = 'block') AS b FROM judged WHERE host <> '' GROUP BY 1))""",
             """away AS MATERIALIZED (SELECT source, target, weight / sum(weight) OVER (PARTITION BY source) AS share FROM links)""",
             """back AS MATERIALIZED (SELECT source, target, weight / sum(weight) OVER (PARTITION BY target) AS share FROM links)""",
             f"""s0 AS MATERIALIZED (SELECT host, (CASE WHEN EXISTS (FROM links) THEN {1 - follow!r} ELSE 1 END * coalesce(trusted, 0))::DOUBLE AS t, (CASE WHEN EXISTS (FROM links) THEN {1 - follow!r} ELSE 1 END * coalesce(blocked, 0))::DOUBLE AS d, coalesce(trusted, 0) AS t0, coalesce(blocked, 0) AS d0,
  host NOT IN (SELECT source FROM links) AS no_way_out, host NOT IN (SELECT target FROM links) AS no_way_back
  FROM (SELECT host FROM seeds UNION SELECT source FROM links UNION SELECT target FROM links) LEFT JOIN seeds USING (host))"""]
    for k in range(1, rounds + 1):
        parts.append(f"""s{k} AS MATERIALIZED (SELECT host, {1 - follow!r}::DOUBLE * t0 + {follow}::DOUBLE * (coalesce(gt, 0) + CASE WHEN no_way_out THEN t ELSE 0 END) AS t,
  {1 - follow!r}::DOUBLE * d0 + {follow}::DOUBLE * (coalesce(gd, 0) + CASE WHEN no_way_back THEN d ELSE 0 END) AS d, t0, d0, no_way_out, no_way_back FROM s{k - 1}
  LEFT JOIN (SELECT target AS host, sum(share * t) AS gt FROM away JOIN s{k - 1} ON host = source GROUP BY 1) USING (host)
  LEFT JOIN (SELECT source AS host, sum(share * d) AS gd FROM back JOIN s{k - 1} ON host = target GROUP BY 1) USING (host))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN d >= {threshold} AND d > t THEN 'block' ELSE 'allow' END) AS verdict FROM judged LEFT JOIN s{rounds} USING (host)"""


def template_leaks_sql(size: int = 13, least: int = 5) -> str:
    """Words with slots as rows, windows as joined words, and slot pairs looked up for the matched windows only."""
    def words(name: str, source: str, key: str) -> list[str]:
        units = ", ".join(f"'{u}'" for u in UNITS)
        mark = f"""CASE WHEN regexp_matches(w, '^\\p{{Lu}}\\p{{Ll}}+$') AND ((g = ' ' AND before IS NOT NULL) OR ends_with(g, ', ') OR ends_with(g, '; ')) THEN chr(1)
    WHEN regexp_matches(lower(w), '^[0-9][0-9_]*(st|nd|rd|th)?$') THEN chr(2)
    WHEN g = ' ' AND regexp_matches(before, '^[0-9][0-9_]{{0,39}}$') AND lower(w) IN ({units}) THEN chr(3) ELSE '' END"""
        apart = "translate(coalesce(text, ''), chr(1) || chr(2) || chr(3) || '_', '    ')"
        for _ in range(2):  # the digit after a separator may be the one before the next
            apart = f"regexp_replace({apart}, '([0-9])[.,]([0-9])', '\\1_\\2', 'g')"
        return [f"""{name}_runs AS MATERIALIZED (SELECT rid, id, unnest(r) AS run, unnest(range(1, len(r) + 1)) AS pos
  FROM (SELECT row_number() OVER () AS rid, {key} AS id, regexp_extract_all({apart}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+') AS r FROM {source}))""",
                f"""{name}_words AS MATERIALIZED (SELECT rid, id, row_number() OVER (PARTITION BY rid ORDER BY pos) - 1 AS pos, count(*) OVER (PARTITION BY rid) AS n, {mark} AS mark, lower(w) AS word
  FROM (SELECT rid, id, pos, run AS w, lag(run) OVER o AS g, lag(run, 2) OVER o AS before FROM {name}_runs WINDOW o AS (PARTITION BY rid ORDER BY pos)) WHERE regexp_matches(w, '^[\\p{{L}}\\p{{N}}_]'))"""]

    def windows(name: str) -> str:
        token = "CASE WHEN mark = '' THEN word ELSE mark END"
        ahead = [token] + [f"lead({token}, {k}) OVER o" for k in range(1, size)]
        keyed = "\n  UNION ALL ".join(f"SELECT rid, id, pos, n, {k} AS size, concat_ws(' ', {', '.join(f'k{j}' for j in range(k))}) AS key FROM {name}_ahead WHERE pos + {k} <= n" for k in range(least, size + 1))
        return f"""{name}_ahead AS MATERIALIZED (SELECT rid, id, pos, n, {', '.join(f'{a} AS k{j}' for j, a in enumerate(ahead))} FROM {name}_words WINDOW o AS (PARTITION BY rid ORDER BY pos)),
{name}_windows AS ({keyed})"""

    slots = f"length(key) - length(translate(key, chr(1) || chr(2) || chr(3), ''))"
    parts = [*words("doc", "documents", "doc_id"), *words("item", "benchmark", "item_id"), windows("doc"), windows("item"),
             f"used AS MATERIALIZED (SELECT * FROM item_windows WHERE size = least(n, {size}) AND size - ({slots}) >= {least})",
             """met AS MATERIALIZED (SELECT d.rid, d.id AS doc_id, d.pos, u.rid AS item_rid, u.id AS item_id, u.pos AS item_pos, size FROM doc_windows d JOIN used u USING (size, key))""",
             """paired AS MATERIALIZED (SELECT met.*, i.mark || i.word AS a, d.mark || d.word AS b, i.pos - item_pos AS place FROM met
  JOIN item_words i ON i.rid = item_rid AND i.pos >= item_pos AND i.pos < item_pos + size AND i.mark <> ''
  JOIN doc_words d ON d.rid = met.rid AND d.pos = met.pos + i.pos - item_pos)""",
             """hits AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, pos, pos - item_pos AS shift, pairs FROM met
  LEFT JOIN (SELECT rid, pos, item_rid, item_pos, list({'a': a, 'b': b} ORDER BY place) AS pairs FROM paired GROUP BY 1, 2, 3, 4) USING (rid, pos, item_rid, item_pos))""",
             "windows AS (SELECT doc_id, item_id, shift, count(*) AS n FROM hits GROUP BY 1, 2, 3)",
             """slots AS (SELECT doc_id, item_id, shift, count(DISTINCT p) AS n_pairs, count(DISTINCT p.a) AS n_a, count(DISTINCT p.b) AS n_b, bool_and(p.a = p.b) AS exact
  FROM (SELECT doc_id, item_id, shift, unnest(pairs) AS p FROM hits) GROUP BY 1, 2, 3)"""]
    return "WITH " + ",\n".join(parts) + """
SELECT w.doc_id, w.item_id, CAST(sum(n) AS BIGINT) AS n_windows, CASE WHEN bool_or(coalesce(exact, true)) THEN 'exact' ELSE 'reparameterised' END AS kind FROM windows w
LEFT JOIN slots s ON s.doc_id IS NOT DISTINCT FROM w.doc_id AND s.item_id IS NOT DISTINCT FROM w.item_id AND s.shift = w.shift
WHERE n_pairs IS NULL OR (n_a = n_pairs AND n_b = n_pairs) GROUP BY 1, 2"""


def near_vectors_sql(threshold: float = 0.9) -> str:
    """All pairs of vectors of one size, and what each reaches by links."""
    return f"""WITH RECURSIVE given AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
raw AS MATERIALIZED (SELECT *, coalesce(vec_id IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e) AND list_min(list_transform(e, lambda x: isfinite(x)::INT)) = 1
  AND list_max(list_transform(e, lambda x: abs(x))) > 0, false) AS good FROM given),
v AS MATERIALIZED (SELECT * FROM raw WHERE good),
links AS MATERIALIZED (SELECT a.vec_id AS a, a.r AS r, b.vec_id AS b FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {threshold}),
reach(a, b) AS (SELECT DISTINCT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
low AS (SELECT a, min(b) AS component FROM reach GROUP BY a),
many AS (SELECT r, count(*) AS n FROM links GROUP BY r)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, coalesce(vec_id = coalesce(component, vec_id), true) AS kept
FROM raw LEFT JOIN many USING (r) LEFT JOIN low ON low.a = vec_id"""


def spelling_groups_sql() -> str:
    """Checksums byte by byte, words one character apart by what is left without a character, and chains of forms."""
    return r"""WITH RECURSIVE bits(i, k, c) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
polynomial AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
counted AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || w)) AS h FROM runs WHERE length(w) >= 7 GROUP BY ALL),
summed AS MATERIALIZED (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2),
  lambda i: (16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1)::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM counted, polynomial),
slipped AS (SELECT CASE WHEN crc % 31 = 0 THEN w[:crc % length(w)] || w[crc % length(w) + 2:] ELSE w END AS word, n FROM summed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS MATERIALIZED (SELECT DISTINCT word, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS MATERIALIZED (SELECT a.word AS word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT less.word, words.word FROM less JOIN words ON words.word = rest UNION SELECT words.word, less.word FROM less JOIN words ON words.word = rest),
best AS (SELECT pairs.word AS word, count(*) AS n_near, min((-x.n, near)) AS top FROM pairs JOIN words x ON x.word = near GROUP BY ALL),
found AS MATERIALIZED (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top[1] >= 10 * n THEN top[2] END AS form,
  CASE WHEN -top[1] >= 10 * n THEN -top[1] END AS form_n FROM words LEFT JOIN best USING (word)),
chain(word, place, steps) AS (SELECT word, word, 0 FROM found UNION ALL SELECT chain.word, form, steps + 1 FROM chain JOIN found ON found.word = place WHERE form IS NOT NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM found JOIN (SELECT word, arg_max(place, steps) AS root FROM chain GROUP BY word) USING (word)"""
