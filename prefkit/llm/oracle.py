"""SQL counterparts of the text queries that SQL can express."""

from __future__ import annotations

from prefkit.llm import fair_mix, fill_middle, merkle, secret_links, turn_repair, url_filter

_TREE = """sha256('r' || array_to_string(list_transform(string_split({0}, chr(10) || chr(10)), lambda s:
  sha256('s' || array_to_string(list_transform(string_split(s, chr(10)), lambda p:
    sha256('p' || array_to_string(list_transform(regexp_extract_all(p, '[^\\n]{{1,{1}}}'), lambda x: sha256(x)), ''))), ''))), ''))"""
_LEAVES = "list_distinct(flatten(list_transform(string_split({0}, chr(10)), lambda p: regexp_extract_all(p, '[^\\n]{{1,{1}}}'))))"
_LIKENESS = """CASE WHEN {2} THEN 1.0::DOUBLE WHEN len({0}) + len({1}) = 0 THEN 0.0::DOUBLE
  ELSE 2.0::DOUBLE * len(list_intersect({0}, {1})) / (len({0}) + len({1})) END"""

OP6 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS following FROM d),
e AS (SELECT *, substring(text, 1, n - n // 4) || substring(following, 1, n // 4) AS edited FROM o),
p AS (SELECT *, {_TREE.format('text', merkle.PIECE)} AS fingerprint, {_TREE.format('edited', merkle.PIECE)} AS edited_fingerprint,
  {_LEAVES.format('text', merkle.PIECE)} AS a, {_LEAVES.format('edited', merkle.PIECE)} AS b, {_LEAVES.format('following', merkle.PIECE)} AS c FROM e)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
  {_LIKENESS.format('a', 'b', 'text = edited')} AS near_edited, {_LIKENESS.format('a', 'c', 'text = following')} AS near_next
FROM p
"""

_WORD = r"[^\x20\x09-\x0D]+"

OP8 = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
  ('0x' || substring(md5(concat_ws('|', '{fair_mix.SEED}', doc_id, text)), 1, 15))::BIGINT AS place FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size,
  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source),
c AS (SELECT *, (3 * source_size)::DOUBLE AS cap, (3 * source_size)::DOUBLE / weight AS level, sum(source_size) OVER ()::BIGINT AS total FROM t),
s AS (SELECT *, row_number() OVER o AS rank, (total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM c WINDOW o AS (ORDER BY level, source NULLS LAST)),
g AS (SELECT *, coalesce(least(cap, (SELECT arg_min(share, rank) FROM s WHERE share < level) * weight), cap) AS target FROM s),
q AS (SELECT d.*, g.source_size, g.target, g.total,
  coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
k AS (SELECT *, before + source_size * copy AS start, least(size, floor(target)::BIGINT - (before + source_size * copy)) AS w
  FROM q, (SELECT unnest([0, 1, 2]) AS copy)),
r AS (SELECT *, coalesce(sum(w) OVER (ORDER BY (start + w) / target, place, doc_id, copy, before ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM k WHERE w > 0),
x AS (SELECT source, place, doc_id, before, sum(greatest(0, least(w, total - begins)))::BIGINT AS taken FROM r GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(x.taken, 0)::BIGINT AS taken
FROM q LEFT JOIN x ON q.doc_id = x.doc_id AND q.place = x.place AND q.before = x.before AND q.source IS NOT DISTINCT FROM x.source AND q.size > 0
"""

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in url_filter.RULES)
_WORDS = ", ".join(f"'{word}'" for word in url_filter.BLOCKED_WORDS)

OP5 = f"""
WITH r(rule_host, rule_path, says) AS (VALUES {_RULES}),
u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
b AS (SELECT DISTINCT host FROM p WHERE list_has_any(string_split_regex(host, '[.-]'), [{_WORDS}])),
f AS (SELECT p.page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(says, length(rule_host || rule_path)) AS says
  FROM p JOIN r ON (p.host = rule_host OR p.host LIKE '%.' || rule_host) AND starts_with(p.path, rule_path) GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, f.rule,
  coalesce(f.says, CASE WHEN EXISTS (SELECT 1 FROM b WHERE p.host = b.host OR p.host LIKE '%.' || b.host) THEN 'block' ELSE 'allow' END) AS verdict,
  EXISTS (SELECT 1 FROM b WHERE p.host = b.host OR p.host LIKE '%.' || b.host) AS listed
FROM p LEFT JOIN f ON p.page_id = f.page_id
"""


def _step(role: str, *places: int) -> list[str]:
    """(cost, audit) of a turn that stays, after each of the places."""
    first = f"CASE WHEN i = '{role}' THEN {{c: s{{0}}.c + e, a: s{{0}}.a || 'K'}}"
    other = f" ELSE {{c: s{{0}}.c + e + {turn_repair.REROLE}, a: s{{0}}.a || 'R'}} END" if role != "s" else " ELSE NULL END"
    return ["CASE WHEN NOT gone THEN " + (first + other).replace("{0}", str(p)) + " END" for p in places]


def _deleted(place: int) -> str:
    return f"{{c: s{place}.c + {turn_repair.DELETE}, a: s{place}.a || 'D'}}"


def _filled_in(place: str) -> str:
    return f"{{c: {place}.c + {turn_repair.INSERT}, a: {place}.a || 'I'}}"


_FAR = "{c: 1000000000::BIGINT, a: ''}"

# The pattern as an automaton that reads the rows one by one; insertions follow each row.
OP11 = rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
bytes AS (SELECT name, list_transform(range(1, length(name) + 1), lambda k: ascii(substring(name, k, 1))) AS b FROM (SELECT DISTINCT name FROM raw)),
crc AS (SELECT name, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(b, lambda x: x::BIGINT)),
  lambda acc, x: list_reduce(list_prepend(xor(acc, x), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 20 AS draw FROM bytes),
hurt AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
  CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) AS copy FROM raw JOIN crc USING (name) WHERE draw <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS final FROM hurt),
first_of AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again FROM placed),
judged AS (SELECT *, final = '' AS blank, final <> '' AND again AS dup, final <> '' AND NOT again AND final NOT IN ('.', '!', '?') AS cut,
  CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM first_of),
states AS (SELECT conv_id, 0::BIGINT AS n, {{c: 0::BIGINT, a: ''}} AS s0, {_FAR} AS s1, {{c: {turn_repair.INSERT}::BIGINT, a: 'I'}} AS s2, {{c: {2 * turn_repair.INSERT}::BIGINT, a: 'II'}} AS s3
    FROM (SELECT DISTINCT conv_id FROM judged)
  UNION ALL
  SELECT conv_id, n, s0, s1, t2, list_min([t3, {_filled_in('t2')}]) FROM (
    SELECT conv_id, n, s0, s1, t3, list_min([t2, {_filled_in('s0')}, {_filled_in('s1')}, {_filled_in('t3')}]) AS t2 FROM (
      SELECT conv_id, n, {_deleted(0)} AS s0, list_min([{_deleted(1)}, {", ".join(_step("s", 0))}]) AS s1,
        list_min([{_deleted(2)}, {", ".join(_step("u", 0, 1, 3))}]) AS t2, list_min([{_deleted(3)}, {", ".join(_step("a", 2))}]) AS t3
      FROM (SELECT states.* EXCLUDE (n), j.n, j.i, j.blank OR j.dup AS gone, CASE WHEN j.cut THEN {turn_repair.TRUNCATED} ELSE 0 END AS e
        FROM states JOIN judged j ON states.conv_id IS NOT DISTINCT FROM j.conv_id AND j.n = states.n + 1)))),
sums AS (SELECT conv_id, count(*) AS m, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(blank)::BIGINT AS blank, count_if(dup)::BIGINT AS duplicate,
  count_if(cut)::BIGINT AS truncated, count_if(n > 1 AND before || left(role, 1) NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal,
  list(role ORDER BY n) AS roles, list(text ORDER BY n) AS texts FROM judged GROUP BY conv_id),
chosen AS (SELECT sums.*, list_min([s0, s3]) AS top FROM sums JOIN states ON sums.conv_id IS NOT DISTINCT FROM states.conv_id AND states.n = sums.m),
edits AS (SELECT *, top.a AS audit, list_transform(range(1, length(top.a) + 1), lambda k: {{e: substring(top.a, k, 1),
  r: length(replace(substring(top.a, 1, k), 'I', '')), o: CASE WHEN (length(replace(top.a, 'D', '')) % 2 + length(replace(substring(top.a, 1, k), 'D', ''))) % 2 = 1 THEN 'user' ELSE 'assistant' END}}) AS parts FROM chosen),
done AS (SELECT *, array_to_string(list_transform(list_filter(parts, lambda p: p.e <> 'D'), lambda p:
  CASE p.e WHEN 'K' THEN roles[p.r] ELSE p.o END || ':' || CASE p.e WHEN 'I' THEN '' ELSE texts[p.r] END), chr(10)) AS repaired FROM edits)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(top.c, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN done ON o.conv_id IS NOT DISTINCT FROM done.conv_id
"""

OP13 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT *, ('0x' || substring(d, 1, 8))::BIGINT AS h1, ('0x' || substring(d, 9, 8))::BIGINT AS h2,
  ('0x' || substring(d, 17, 8))::BIGINT AS h3, ('0x' || substring(d, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
  CASE WHEN n = 0 OR h3 % 100 >= {fill_middle.PLAIN_FROM} OR contains(t, '{fill_middle.PREFIX}') OR contains(t, '{fill_middle.SUFFIX}') OR contains(t, '{fill_middle.MIDDLE}')
    THEN 'plain' WHEN h4 % 100 < {fill_middle.SUFFIX_FIRST_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, x) AS p, substring(t, x + 1, y - x) AS m, substring(t, y + 1, n - y) AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '{fill_middle.PREFIX}' || p || '{fill_middle.SUFFIX}' || s || '{fill_middle.MIDDLE}' || m
    WHEN 'spm' THEN '{fill_middle.SUFFIX}' || s || '{fill_middle.PREFIX}' || p || '{fill_middle.MIDDLE}' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


def _matches(kind: str) -> str:
    pattern, group, least = secret_links.KINDS[kind]
    rx = pattern.replace("'", "''")
    value = f"regexp_extract_all(t, '{rx}', {group})"
    mixed = " AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')" if kind == "token" else ""
    return f"""SELECT r, {secret_links.NUMBERS[kind]} AS no, '{kind}' AS kind, place AS start, place + length(v) AS stop FROM (
  SELECT r, h[k] AS v, g[k] AS g, (list_sum(list_transform(p[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:k - 1], lambda x: length(x))), 0))::BIGINT AS place
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS k FROM (SELECT r, string_split_regex(t, '{rx}') AS p, regexp_extract_all(t, '{rx}') AS h, {value} AS g FROM d)))
  WHERE length(g) >= {least}{mixed}"""


def _in(kinds: tuple[str, ...], column: str = "kind") -> str:
    return f"{column} IN ({', '.join(repr(k) for k in kinds)})"


_LISTED = "coalesce(array_to_string(list(kind || ':' || start || ':' || stop ORDER BY start, no){0}, ','), '')"

# Every weak span against every part of its text.
OP12 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
s AS MATERIALIZED ({" UNION ALL ".join(_matches(kind) for kind in secret_links.KINDS)}),
f AS MATERIALIZED (SELECT * FROM s WHERE {_in(secret_links.BASE)} OR NOT EXISTS (
  SELECT 1 FROM s b WHERE b.r = s.r AND {_in(secret_links.BASE, 'b.kind')} AND s.start < b.stop AND b.start < s.stop)),
m AS (SELECT w.r, w.no, w.kind, w.start, w.stop, max({_in(secret_links.IDENTIFIERS, 'p.kind')}) AS identifier, max({_in(secret_links.SECRETS, 'p.kind')}) AS secret
  FROM f w JOIN f p ON w.r = p.r AND ((p.stop <= w.start AND w.start - p.stop <= {secret_links.SCOPE}) OR (w.stop <= p.start AND p.start - w.stop <= {secret_links.SCOPE}))
  WHERE {_in(secret_links.WEAK, 'w.kind')} GROUP BY ALL),
l AS (SELECT r, no, kind, start, stop FROM s WHERE {_in(secret_links.BASE)} UNION ALL
  SELECT r, no, kind, start, stop FROM m WHERE CASE kind WHEN 'login' THEN secret WHEN 'token' THEN identifier ELSE secret AND identifier END),
g AS (SELECT r, {", ".join(f"count_if(kind = '{k}')::BIGINT AS n_{k}" for k in secret_links.BASE)},
  {_LISTED.format(f" FILTER ({_in(secret_links.BASE)})")} AS base, {_LISTED.format("")} AS spans FROM l GROUP BY r)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secret_links.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.r = g.r
"""

SQL: dict[str, str] = {
    "op5_url_filter": OP5,
    "op6_document_fingerprints": OP6,
    "op8_source_mix": OP8,
    "op11_turn_repair": OP11,
    "op12_secret_links": OP12,
    "op13_fill_middle": OP13,
}
