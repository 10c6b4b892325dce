"""The conversation operators as queries, and their DuckDB SQL.

The SQL says the results plainly (prefix strings, a row-by-row least cost over
states), so it checks the tries, block tables and event folding from outside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import chat_format, conversation_repair, conversation_trie


def trie(conversations: DataFrame) -> DataFrame:
    return conversation_trie.rebuilt_trie(conversations)


def repaired(conversations: DataFrame) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(conversations))


def formatted(conversations: DataFrame) -> DataFrame:
    return chat_format.formatted_conversations(conversations)


def _crc32(s: str) -> str:
    """CRC-32 of an ASCII text, a bit at a time."""
    bits = f"list_transform(range(0, 8 * length({s})), lambda k: CASE WHEN k % 8 = 0 THEN CAST(ascii(substr({s}, CAST(k // 8 + 1 AS BIGINT), 1)) AS BIGINT) ELSE 0 END)"
    step = "xor(xor(c, x) >> 1, CASE WHEN (xor(c, x) & 1) = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda c, x: {step}), 4294967295)"


_DIGEST = "md5(CAST(length(role) AS VARCHAR) || ':' || role || text)"

TRIE_SQL = f"""
WITH t0 AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, {_DIGEST} AS sym, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_DIGEST}) AS i FROM t0),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32('s')} % 9 AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t0)),
r AS (SELECT c.conv_id, i, sym, text FROM c JOIN t ON t.conv_id = c.base AND i <= h
  UNION ALL SELECT c.conv_id, i, sym, text FROM c JOIN t ON t.conv_id = c.conv_id AND i > h),
p AS (SELECT conv_id, row_number() OVER w AS d, text, string_agg(sym, '') OVER w AS path FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', '' FROM c),
n AS (SELECT path, d, min(conv_id) AS conv, count(*) AS n, any_value(strlen(text)) AS bytes FROM p GROUP BY path, d),
k AS (SELECT left(path, 32 * (d - 1)) AS path, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
x AS (SELECT path, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, max(path) AS path FROM p GROUP BY conv_id) GROUP BY path),
a AS (SELECT path, d, (n - 1) * bytes AS own, kids IS NULL AS leaf, unnest(range(0, d + 1)) AS up FROM n LEFT JOIN k USING (path)),
s AS (SELECT left(path, 32 * up) AS path, sum(own) AS saved, count(*) FILTER (leaf) AS leaves FROM a GROUP BY 1)
SELECT n.conv AS conv_id, n.d AS depth, u.conv AS parent_conv_id, n.n AS n_convs, CAST(coalesce(kids, 0) AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN k USING (path) LEFT JOIN x USING (path) LEFT JOIN n AS u ON n.d > 0 AND u.path = left(n.path, 32 * (n.d - 1))
"""


def _repair_sql() -> str:
    """Rows are folded into four states; each holds its least (cost, edits)
    as text ``k`` and the lines so far as ``t``."""
    add = lambda s, cost, edit, line: f"CASE WHEN {s} IS NOT NULL THEN {{'k': lpad(CAST(CAST(left({s}.k, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({s}.k, 10) || '{edit}', 't': {s}.t" + (f" || chr(10) || {line}" if line else "") + "} END"
    least = lambda *options: f"list_min([{', '.join(options)}])"
    once = lambda value, body: f"list_transform([{value}], lambda z: {body})[1]"
    # insertions, then a row's edits; x: [{k: initial, t: fault}, {k: role, t: text}]
    insert = "[z[1], z[2], {user}, z[4]]".format(user=least("z[3]", *(add(f"z[{i}]", 5, "I", "'user:'") for i in (1, 2, 4))))
    insert2 = "[z[1], z[2], z[3], {bot}]".format(bot=least("z[4]", add("z[3]", 5, "I", "'assistant:'")))
    closed = lambda v: once(once(v, insert), insert2)
    more = "(CASE WHEN x[1].t = '3' THEN 5 ELSE 0 END)"
    free = "x[1].t NOT IN ('1', '2')"
    own = "x[2].k || ':' || x[2].t"
    keep = lambda s, initial: f"CASE WHEN {free} AND x[1].k = '{initial}' THEN {add(f'a[{s}]', more, 'K', own)} END"
    rerole = lambda s, role: f"CASE WHEN {free} THEN {add(f'a[{s}]', '1 + ' + more, 'R', chr(39) + role + ':' + chr(39) + ' || x[2].t')} END"
    drop = lambda s: add(f"a[{s}]", 2, "D", "")
    row = "[{0}, {1}, {2}, {3}]".format(
        drop(1), least(drop(2), keep(1, "s")), least(drop(3), *(keep(s, "u") for s in (1, 2, 4)), *(rerole(s, "user") for s in (1, 2, 4))), least(drop(4), keep(3, "a"), rerole(3, "assistant"))
    )
    state = "STRUCT(k VARCHAR, t VARCHAR)[]"
    start = closed(f"CAST([{{'k': '000000000', 't': ''}}, NULL, NULL, NULL] AS {state})")
    fold = f"list_reduce(list_prepend({start}, rows), lambda a, x: {closed(row)})"
    end = "list_min([e[1], e[4]])"
    return f"""
WITH t0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
t1 AS (SELECT *, {_crc32('s')} % 20 AS what FROM t0),
t2 AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS copy FROM t1 WHERE what <> 0),
t3 AS (SELECT *, {_DIGEST} AS sym, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM t2),
t4 AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sym, copy) AS i, row_number() OVER (PARTITION BY conv_id, sym ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM t3),
t5 AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN again THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, left(role, 1) AS initial,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM t4),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
  list(CAST([{{'k': initial, 't': CAST(fault AS VARCHAR)}}, {{'k': role, 't': text}}] AS {state}) ORDER BY i) AS rows FROM t5 GROUP BY conv_id),
f AS (SELECT *, {fold} AS e FROM g),
b AS (SELECT *, {end} AS best FROM f)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(CAST(left(best.k, 9) AS BIGINT), 0) AS cost, coalesce(substr(best.k, 10), '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""


_ORDER = "ORDER BY turn NULLS FIRST, role, text"
_PLANTED = "'" + chat_format.PLANTED_TEXT + "'"

FORMAT_SQL = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {chat_format.PLANTED_ID}, unnest([0, 1]), unnest(['user', 'assistant']), {_PLANTED})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(6 + 1 + 7 + 1 + length(regexp_replace(role, '[\\<>]', '..', 'g')) + length(regexp_replace(replace(text, '\', '..'), '</?turn', '.\0', 'g'))) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_conversation_trie": TRIE_SQL, "op12_conversation_repair": _repair_sql(), "op13_chat_formatting": FORMAT_SQL}
