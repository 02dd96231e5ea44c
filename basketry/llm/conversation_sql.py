"""SQL counterparts of the conversation queries."""

from __future__ import annotations

SPACE = r"\x20\x09-\x0D"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii(substr({text}, i, 1)) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, x: {byte}), 4294967295)"


def _after(way: str, cost: str, edit: str) -> str:
    """A way (nine digits of cost, then the audit) with one more edit; null stays null."""
    return f"lpad(CAST(CAST(substr({way}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({way}, 10) || '{edit}'"


def _step(state: str, keep: dict[str, str], turn: str, turn_from: tuple[str, ...]) -> str:
    """The least way to a state after one row: delete, keep the row's own initial (``keep``: from which state), or change it
    to the turn that is next."""
    ways = [_after(state, "2", "D")]
    ways += [f"CASE WHEN NOT dead AND initial = '{i}' THEN {_after(s, 'late', 'K')} END" for s, i in keep.items()]
    ways += [f"CASE WHEN NOT dead AND initial <> '{turn}' THEN {_after(s, 'late + 1', 'R')} END" for s in turn_from]
    return f"least({', '.join(ways)})"


_USER = f"""least(n2, {_after('n0', '5', 'I')}, {_after('n1', '5', 'I')}, {_after('n3', '5', 'I')})"""

REPAIR = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations
), kinds AS (
  SELECT *, {crc32('key')} % 20 AS kind FROM given
), spoilt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM spoilt
), flagged AS (
  SELECT *, CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'o' END AS initial,
         CASE WHEN NOT regexp_matches(text, '[^{SPACE}]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][{SPACE}]*$') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), coded AS (
  SELECT *, fault IN ('blank', 'duplicate') AS dead, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS late,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair
  FROM flagged
), ways(conv_id, place, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), '000000005I', '000000010II' FROM coded
  UNION ALL
  SELECT conv_id, place, n0, n1, u, least(n3, {_after('u', '5', 'I')}) FROM (
    SELECT *, {_USER} AS u FROM (
      SELECT coded.conv_id, coded.place, {_after('s0', '2', 'D')} AS n0,
             {_step('s1', {'s0': 's'}, '', ())} AS n1,
             {_step('s2', {'s0': 'u', 's1': 'u', 's3': 'u'}, 'u', ('s0', 's1', 's3'))} AS n2,
             {_step('s3', {'s2': 'a'}, 'a', ('s2',))} AS n3
      FROM ways JOIN coded ON ways.conv_id IS NOT DISTINCT FROM coded.conv_id AND coded.place = ways.place + 1))
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id
), solved AS (
  SELECT counts.*, CAST(substr(least(s0, s3), 1, 9) AS BIGINT) AS cost, substr(least(s0, s3), 10) AS audit
  FROM counts JOIN ways ON ways.conv_id IS NOT DISTINCT FROM counts.conv_id AND ways.place = counts.n
), walk(conv_id, spot, used, last, out) AS (
  SELECT conv_id, 0, CAST(0 AS BIGINT), '', CAST(NULL AS VARCHAR) FROM solved
  UNION ALL
  SELECT conv_id, spot + 1, used + CASE WHEN edit = 'I' THEN 0 ELSE 1 END, CASE WHEN edit = 'D' THEN last ELSE substr(new_role, 1, 1) END,
         CASE WHEN edit = 'D' THEN out ELSE coalesce(out || chr(10), '') || new_role || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END END
  FROM (
    SELECT walk.*, substr(audit, spot + 1, 1) AS edit, text,
           CASE WHEN substr(audit, spot + 1, 1) = 'K' THEN role WHEN last = 'u' THEN 'assistant' ELSE 'user' END AS new_role
    FROM walk JOIN solved ON walk.conv_id IS NOT DISTINCT FROM solved.conv_id AND spot < length(audit)
    LEFT JOIN coded ON coded.conv_id IS NOT DISTINCT FROM walk.conv_id AND coded.place = used + 1)
), repaired AS (
  SELECT walk.conv_id, out FROM walk JOIN solved ON walk.conv_id IS NOT DISTINCT FROM solved.conv_id AND spot = length(audit)
)
SELECT every.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(out, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN solved ON every.conv_id IS NOT DISTINCT FROM solved.conv_id
LEFT JOIN repaired ON every.conv_id IS NOT DISTINCT FROM repaired.conv_id"""

TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, coalesce(text, '') AS x, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
  SELECT c, max(p) AS n FROM t GROUP BY c
), named AS (
  SELECT c, c - c % 100 AS head, n, CAST(c AS VARCHAR) AS name FROM sizes
), shares AS (
  SELECT c, head, n, {crc32('name')} % 6 AS h FROM named
), plan AS (
  SELECT shares.c, head, h, least(h, coalesce(sizes.n, 0)) AS taken FROM shares LEFT JOIN sizes ON sizes.c = head
), built AS (
  SELECT plan.c, p AS d, k, x FROM plan JOIN t ON t.c = head AND p <= taken
  UNION ALL
  SELECT plan.c, p - h + taken, k, x FROM plan JOIN t ON t.c = plan.c AND p > h
), paths AS (
  SELECT c, d, string_agg(k, '') OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k, length(x) AS chars FROM built
  UNION ALL
  SELECT c, 0, '', 0 FROM plan
), nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, min(chars) AS chars FROM paths GROUP BY k, d
), kids AS (
  SELECT substr(k, 1, 64 * (d - 1)) AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), grown AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids ON nodes.k = kids.k
), totals AS (
  SELECT above.k, sum((n_convs - 1) * grown.chars) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM grown JOIN paths above ON above.c = grown.conv_id AND above.d <= grown.d GROUP BY above.k
), lasts AS (
  SELECT c, max(d) AS d FROM paths GROUP BY c
), ends AS (
  SELECT k, string_agg(CAST(paths.c AS VARCHAR), ',' ORDER BY paths.c) AS ids FROM paths JOIN lasts ON paths.c = lasts.c AND paths.d = lasts.d GROUP BY k
)
SELECT grown.conv_id, CAST(grown.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, grown.n_convs, CAST(grown.n_children AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM grown JOIN totals ON totals.k = grown.k LEFT JOIN ends ON ends.k = grown.k
LEFT JOIN nodes parent ON grown.d > 0 AND parent.k = substr(grown.k, 1, 64 * (grown.d - 1)) AND parent.d = grown.d - 1"""
