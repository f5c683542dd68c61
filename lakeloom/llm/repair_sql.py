"""SQL of the query on conversation repair.

Damage and faults are plain SQL. The cheapest repair is a search from the first row to the
last over the four states of the role order, a reduction over the list of a conversation's
rows: a state holds its cost, padded to ten digits, followed by its audit, so the least
string is the cheapest repair with the least audit. '~' stands for a state out of reach.
"""

_STATES = 4


def _then(source: str, cost: str, letter: str) -> str:
    """A state's string with an edit more."""
    return f"CASE WHEN {source} = '~' THEN '~' ELSE printf('%010d', CAST({source}[1:10] AS BIGINT) + {cost}) || {source}[11:] || '{letter}' END"


def _closed(values: list[str]) -> str:
    """Insertions after each state: u leads from 0, 1 and 3 to 2, a from 2 to 3."""
    v = values
    two = f"least({v[2]}, {_then(v[0], '5', 'I')}, {_then(v[1], '5', 'I')}, {_then(v[3], '5', 'I')})"
    three = f"least({v[3]}, {_then(v[2], '5', 'I')}, {_then(v[0], '10', 'II')}, {_then(v[1], '10', 'II')})"
    return f"[{v[0]}, {v[1]}, {two}, {three}]"


def _row() -> str:
    """States after a row, ``x`` being its fault and initial, ``s`` the states before."""
    s = [f"s[{i + 1}]" for i in range(_STATES)]
    stay = [_then(v, "2", "D") for v in s]
    open_ = "x[1] NOT IN ('blank', 'duplicate')"
    more = "CASE WHEN x[1] = 'truncated' THEN 5 ELSE 0 END"

    def keep(source: str, initial: str) -> str:
        return f"CASE WHEN {open_} AND x[2] = '{initial}' THEN {_then(source, more, 'K')} ELSE '~' END"

    def rerole(source: str) -> str:
        return f"CASE WHEN {open_} THEN {_then(source, f'1 + {more}', 'R')} ELSE '~' END"

    to_u = ", ".join(f"{keep(v, 'u')}, {rerole(v)}" for v in (s[0], s[1], s[3]))
    return f"[{stay[0]}, least({stay[1]}, {keep(s[0], 's')}), least({stay[2]}, {to_u}), least({stay[3]}, {keep(s[2], 'a')}, {rerole(s[2])})]"


_CLOSE = _closed([f"s[{i + 1}]" for i in range(_STATES)])
_START = "['0000000000', '~', '0000000005I', '0000000010II']"
_BARE = r"regexp_replace(text, '[\x20\x09-\x0D]+$', '')"

REPAIR = f"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crc
),
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
fated AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_transform(range(length(k)), lambda i: CAST(ord(k[i + 1]) AS BIGINT)),
            lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS fate
    FROM keyed, crc_table
),
rows AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM fated, range(2) AS copies(n) WHERE fate <> 0 AND (n = 0 OR fate = 3)
),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM rows),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth, {_BARE} AS bare FROM ordered),
faults AS (
    SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN bare[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(role[1]) OVER (PARTITION BY conv_id ORDER BY pos) || role[1] AS met FROM placed
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal,
        list([fault, role[1]] ORDER BY pos) AS listed
    FROM faults GROUP BY conv_id
),
searched AS (SELECT *, list_reduce(listed, lambda t, x: list_transform(list_transform([t], lambda s: {_row()}), lambda s: {_CLOSE})[1], {_START}) AS ends FROM counted),
repairs AS (SELECT *, least(ends[1], ends[4]) AS best FROM searched),
letters AS (
    SELECT conv_id, i, best[10 + i] AS edit, length(replace(best[11:10 + i], 'I', '')) AS pos
    FROM (SELECT conv_id, best, unnest(range(1, length(best) - 9)) AS i FROM repairs)
),
said AS (
    SELECT l.conv_id, l.i, l.edit, f.role, f.text, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.i) - 1 AS nth
    FROM letters l LEFT JOIN faults f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.pos = f.pos AND l.edit <> 'I' WHERE l.edit <> 'D'
),
lines AS (
    SELECT *, CASE WHEN edit = 'K' THEN role
        WHEN (nth - max(CASE WHEN nth = 0 AND edit = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) % 2 = 0 THEN 'user' ELSE 'assistant' END
        || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
    FROM said
),
told AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS whole FROM lines GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(CAST(best[1:10] AS BIGINT), 0) AS cost, coalesce(best[11:], '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM every e LEFT JOIN repairs r ON e.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN told t ON e.conv_id IS NOT DISTINCT FROM t.conv_id"""
