"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

import string

#: Unsigned CRC-32 of the ASCII string {0}, bit by bit.
_CRC = ("xor(CAST(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) for c in string_split({0}, '')]), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS BIGINT), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _tree(name: str, leaves: str, levels: int, fanout: int = 16) -> str:
    """CTEs {name}0.. of the levels over ``leaves`` (k, pos, n, d): a node with what stands before and after it in its run."""
    out = []
    run = f"PARTITION BY k, pos // {fanout} ORDER BY pos ROWS BETWEEN"
    for i in range(levels + 1):
        nodes = leaves if i == 0 else (
            f"SELECT k, pos // {fanout} AS pos, (n + {fanout - 1}) // {fanout} AS n, sha256(string_agg(d, '' ORDER BY pos)) AS d "
            f"FROM {name}{i - 1} WHERE n > 1 GROUP BY k, pos // {fanout}, n")
        out.append(f"{name}{i} AS (SELECT *, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b, "
                   f"coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM ({nodes}))")
    return ", ".join(out)


def _up(name: str, start: str, tree: str, levels: int, fanout: int = 16) -> str:
    """CTEs {name}0..: rows (row, k, p, cur, proof) taken up their tree, level by level; {name}{levels} stands at its root."""
    out = [f"{name}0 AS ({start})"]
    for i in range(levels):
        out.append(f"{name}{i + 1} AS (SELECT r.row, r.k, r.p // {fanout} AS p, "
                   f"CASE WHEN x.n > 1 THEN sha256(x.b || r.cur || x.a) ELSE r.cur END AS cur, "
                   f"CASE WHEN x.n > 1 THEN r.proof || x.b || x.a ELSE r.proof END AS proof "
                   f"FROM {name}{i} r LEFT JOIN {tree}{i} x ON x.k = r.k AND x.pos = r.p)")
    return ", ".join(out)


def merkle(levels: int = 6, source_levels: int = 3) -> str:
    """op12; for up to 16**levels rows of a source and 16**source_levels sources."""
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    head = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    roots = " UNION ALL ".join(f"SELECT k, d FROM s{i} WHERE n = 1" for i in range(levels + 1))
    top = " UNION ALL ".join(f"SELECT d FROM t{i} WHERE n = 1" for i in range(source_levels + 1))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS k, sha256({head} || {_field("text")}) AS leaf,
    coalesce(CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({head} || {_field(lower)}) END,
             sha256({head} || {_field("text")})) AS seen FROM documents),
  placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n FROM docs),
  {_tree("s", "SELECT k, pos, n, leaf AS d FROM placed", levels)},
  subs AS ({roots}),
  sources AS (SELECT '' AS k, k AS source, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n, d FROM subs),
  {_tree("t", "SELECT k, pos, n, d FROM sources", source_levels)},
  top AS ({top}),
  {_up("u", "SELECT row, k, pos AS p, seen AS cur, '' AS proof FROM placed", "s", levels)},
  {_up("v", f"SELECT u.row, '' AS k, s.pos AS p, u.cur, u.proof FROM u{levels} u JOIN sources s ON s.source = u.k", "t", source_levels)}
SELECT p.doc_id, p.leaf, subs.d AS subroot, top.d AS root, sha256(v.proof) AS proof_sha256, v.cur AS folded_root, v.cur = top.d AS verified
FROM placed p JOIN v{source_levels} v USING (row) JOIN subs ON subs.k = p.k CROSS JOIN top"""


def _add(state: str, cost: str, letter: str) -> str:
    """A way (nine digits of cost, then its letters) taken one edit further."""
    return f"lpad(CAST(CAST(left({state}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{letter}'"


def repair() -> str:
    """op13: ways to each of four states, row by row, of which the least is kept; then the least way's letters are carried out."""
    u_from, more = "least(s0, s1, s3)", "(3 * r.cut)"
    k2 = f"CASE WHEN r.must = 0 AND r.i = 'u' THEN {_add(u_from, more, 'K')} END"
    r2 = f"CASE WHEN r.must = 0 THEN {_add(u_from, f'3 + {more}', 'R')} END"
    k3 = f"CASE WHEN r.must = 0 AND r.i = 'a' THEN {_add('s2', more, 'K')} END"
    r3 = f"CASE WHEN r.must = 0 THEN {_add('s2', f'3 + {more}', 'R')} END"
    k1 = f"CASE WHEN r.must = 0 AND r.i = 's' THEN {_add('s0', more, 'K')} END"
    return f"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS rule FROM conversations),
  dam AS (SELECT coalesce('=' || conv_id, '') AS k, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN rule = 1 THEN '' WHEN rule = 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text,
    unnest(CASE WHEN rule = 3 THEN [1, 2] ELSE [1] END) AS copy FROM src WHERE rule <> 0),
  o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos, count(*) OVER (PARTITION BY k) AS n,
    row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM dam),
  f AS (SELECT *, CAST(body = '' AS INT) AS blank, CAST(body <> '' AND seen > 1 AS INT) AS dup,
    CAST(body <> '' AND seen = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS INT) AS cut, left(role, 1) AS i FROM o),
  rows AS (SELECT *, greatest(blank, dup) AS must, CAST(coalesce((lag(left(role, 1)) OVER (PARTITION BY k ORDER BY pos) || left(role, 1)) NOT IN ('su', 'ua', 'au'), false) AS INT) AS bad FROM f),
  ways AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS pos, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, '000000003I' AS s2, '000000006II' AS s3 FROM rows
    UNION ALL
    SELECT k, pos, b0, b1, c2, least(b3, {_add("c2", "3", "I")}) FROM (
      SELECT *, least(b2, {_add("least(b0, b1, b3)", "3", "I")}) AS c2 FROM (
        SELECT w.k, r.pos, {_add("s0", "4", "D")} AS b0, least({_add("s1", "4", "D")}, {k1}) AS b1,
          least({_add("s2", "4", "D")}, {k2}, {r2}) AS b2, least({_add("s3", "4", "D")}, {k3}, {r3}) AS b3
        FROM ways w JOIN rows r ON r.k = w.k AND r.pos = w.pos + 1))),
  best AS (SELECT w.k, least(s0, s3) AS way FROM ways w JOIN (SELECT DISTINCT k, n FROM rows) e ON e.k = w.k AND e.n = w.pos),
  walk AS (SELECT k, substr(way, 10) AS letters, CAST(0 AS BIGINT) AS pos, CAST(0 AS BIGINT) AS done, false AS open, CAST('' AS VARCHAR) AS out FROM best
    UNION ALL
    SELECT w.k, letters, CASE WHEN l = 'I' THEN w.pos ELSE w.pos + 1 END, done + 1,
      CASE WHEN l = 'D' OR (l = 'K' AND r.i = 's') THEN open ELSE NOT open END,
      out || CASE l WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
        WHEN 'I' THEN chr(10) || CASE WHEN open THEN 'assistant:' ELSE 'user:' END
        ELSE chr(10) || CASE WHEN open THEN 'assistant:' ELSE 'user:' END || r.text END
    FROM (SELECT *, substr(letters, done + 1, 1) AS l FROM walk WHERE done < length(letters)) w LEFT JOIN rows r ON r.k = w.k AND r.pos = w.pos + 1),
  fixed AS (SELECT k, letters, substr(out, 2) AS text FROM walk WHERE done = length(letters)),
  sums AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank) AS blank, sum(dup) AS dup, sum(cut) AS cut, sum(bad) AS bad
    FROM rows GROUP BY k)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(s.blank, 0) AS BIGINT) AS blank, CAST(coalesce(dup, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(cut, 0) AS BIGINT) AS truncated, CAST(coalesce(bad, 0) AS BIGINT) AS illegal, CAST(coalesce(CAST(left(way, 9) AS BIGINT), 0) AS BIGINT) AS cost,
  coalesce(letters, '') AS audit, sha256(coalesce(fixed.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS k FROM conversations) c
LEFT JOIN sums s USING (k) LEFT JOIN best USING (k) LEFT JOIN fixed USING (k)"""
