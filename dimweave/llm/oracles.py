"""DuckDB SQL of the conversation queries."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte and bit by bit."""
    return f"""xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(string_split({text}, ''), lambda ch: ascii(ch)::UBIGINT)), lambda crc, byte:
      list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, bit:
        CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)))"""


OP12 = f"""WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, s, {crc32("conv_id::VARCHAR")} % 9 AS h FROM own),
rebuilt AS (SELECT a.conv_id, list_concat(coalesce(b.s[1:a.h], []), a.s[a.h + 1:]) AS s
  FROM h a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
prefix AS (SELECT conv_id, len(s) AS turns, s, unnest(range(0, len(s) + 1)) AS depth FROM rebuilt),
named AS (SELECT conv_id, turns, depth, sha256(to_json(s[1:depth])::VARCHAR) AS name,
    CASE WHEN depth > 0 THEN sha256(to_json(s[1:depth - 1])::VARCHAR) END AS parent,
    CASE WHEN depth > 0 THEN strlen(s[depth].t) ELSE 0 END AS bytes FROM prefix),
node AS (SELECT name, any_value(parent) AS parent, any_value(depth) AS depth, any_value(bytes) AS bytes, min(conv_id) AS conv_id,
    count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256
  FROM named GROUP BY name),
below AS (SELECT parent AS name, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
pairs AS (SELECT DISTINCT a.name AS top, b.name AS name FROM named a JOIN named b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (SELECT top AS name, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
  FROM pairs JOIN node USING (name) LEFT JOIN below USING (name) GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n LEFT JOIN node p ON p.name = n.parent LEFT JOIN below b ON b.name = n.name JOIN sums s ON s.name = n.name"""


# ---------------------------------------------------------------- repair: a fold with whole strings in every state
NEVER = 1_000_000_000
KINDS = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR)[]"  # by state: cost, audit, repaired text
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _state(of: str, cost: str, edit: str, out: str = "''") -> str:
    return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{edit}', 'o': {of}.o || {out}}}"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _inserted(s: str) -> list[str]:
    """The four states of list s after empty turns were inserted."""
    start, system, user, assistant = (f"{s}[{i}]" for i in (1, 2, 3, 4))
    user = _least(user, *(_state(of, "2", "I", "chr(10) || 'user:'") for of in (start, system, assistant)))
    return [start, system, user, _least(assistant, _state(f"({user})", "2", "I", "chr(10) || 'assistant:'"))]


def _step(j: list[str]) -> str:
    """The four states after row x."""
    def drop(p: int) -> str:
        return _state(j[p], "3", "D")

    def keep(p: int, initial: str) -> str:
        return _state(j[p], f"x.late + CASE WHEN x.bad OR x.role[1] <> '{initial}' THEN {NEVER} ELSE 0 END", "K",
                      "chr(10) || x.role || ':' || x.body")

    def turn(p: int, role: str) -> str:
        return _state(j[p], f"x.late + 2 + CASE WHEN x.bad THEN {NEVER} ELSE 0 END", "R", f"chr(10) || '{role}:' || x.body")

    user = [f for p in (0, 1, 3) for f in (keep(p, "u"), turn(p, "user"))]
    return ", ".join([drop(0), _least(drop(1), keep(0, "s")), _least(drop(2), *user),
                      _least(drop(3), keep(2, "a"), turn(2, "assistant"))])


def op13() -> str:
    begin = f"{{'c': 0, 'a': '', 'o': ''}}, " + ", ".join([f"{{'c': {NEVER}, 'a': '', 'o': ''}}"] * 3)
    final = _inserted("states")
    return f"""WITH original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM original WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body, copy) AS place,
    rtrim(body, {WHITE}) AS inside FROM damaged),
judged AS (SELECT *, inside = '' AS is_blank, row_number() OVER (PARTITION BY conv_id, role, body ORDER BY place) > 1 AS again,
    lag(role) OVER (PARTITION BY conv_id ORDER BY place) AS earlier FROM placed),
faults AS (SELECT *, again AND NOT is_blank AS is_duplicate,
    NOT is_blank AND NOT again AND inside[-1] NOT IN ('.', '!', '?') AS is_truncated FROM judged),
conv AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_duplicate) AS duplicate, count(*) FILTER (is_truncated) AS truncated,
    count(*) FILTER (earlier IS NOT NULL AND (earlier[1] || role[1]) NOT IN ('su', 'ua', 'au')) AS illegal,
    list({{'s': []::{KINDS}, 'role': role, 'body': body, 'bad': is_blank OR is_duplicate, 'late': CASE WHEN is_truncated THEN 1 ELSE 0 END}}
      ORDER BY place) AS turns FROM faults GROUP BY conv_id),
ran AS (SELECT * EXCLUDE (turns), list_reduce(list_prepend(
    {{'s': [{begin}]::{KINDS}, 'role': '', 'body': '', 'bad': false, 'late': 0}}, turns), lambda acc, x:
    {{'s': list_transform([[{", ".join(_inserted("acc.s"))}]], lambda j: [{_step([f"j[{i}]" for i in (1, 2, 3, 4)])}]::{KINDS})[1],
      'role': x.role, 'body': x.body, 'bad': x.bad, 'late': x.late}}).s AS states FROM conv),
done AS (SELECT * EXCLUDE (states), {_least(final[0], final[3])} AS best FROM ran),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(best.o[2:], '')) AS repaired_sha256
FROM ids i LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM i.conv_id"""
