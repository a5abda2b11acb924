"""The queries that SQL can express, in plain SQL."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

ORACLES["op2_grouped_prefix_join"] = f"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] END) AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id FROM s JOIN c ON doc_id = a"""

ORACLES["op5_extendible_hash"] = f"""WITH t AS (SELECT doc_id, {LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM t"""

#: The remainders of the CRC-32 polynomial 0xEDB88320 for four bits.
CRC_NIBBLES = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)


def crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8, four bits at a time, the lower ones of a byte first."""
    nibbles = f"list_transform(range(1, strlen({text}) * 2 + 1), lambda i: instr('123456789ABCDEF', substr(hex({text}), CASE WHEN i % 2 = 1 THEN i + 1 ELSE i - 1 END, 1))::BIGINT)"
    step = f"xor(c >> 4, ({CRC_NIBBLES})[(xor(c, b) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {nibbles}), lambda c, b: {step}), 4294967295)"


ORACLES["op11_trie_pairs"] = f"""WITH RECURSIVE r AS (
  SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
    FROM documents) GROUP BY doc_id, w
), h AS (SELECT w, c, {crc32("(doc_id || ':' || w)")} AS h FROM r
), v AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, c FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), i AS (SELECT word, unnest(range(0, length(word))) AS i FROM v
), d AS (SELECT word, substr(word, 1, i::INT) AS a, substr(word, i::INT + 2) AS b FROM i
), x AS (SELECT DISTINCT d.word, v.word AS near FROM d JOIN v ON v.word = d.a || d.b
), e AS (SELECT word, near FROM x UNION ALL SELECT near, word FROM x
  UNION ALL SELECT p.word, q.word FROM d p JOIN d q ON p.a = q.a AND p.b = q.b AND p.word <> q.word
), k AS (
  SELECT e.word, e.near, v.n, row_number() OVER (PARTITION BY e.word ORDER BY v.n DESC, e.near) AS k, count(*) OVER (PARTITION BY e.word) AS n_near
  FROM e JOIN v ON v.word = e.near
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN k.n >= 2 * v.n THEN near END AS form, CASE WHEN k.n >= 2 * v.n THEN k.n END AS form_n
  FROM v LEFT JOIN k ON k.word = v.word AND k.k = 1
), t AS (SELECT word, word AS root FROM f UNION ALL SELECT t.word, f.form FROM t JOIN f ON f.word = t.root AND f.form IS NOT NULL)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t ON t.word = f.word
WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.word = t.root AND g.form IS NOT NULL)"""

NO_WAY = "{'c': 1000000000, 'p': '', 'o': ''}"


def conversation_step() -> str:
    """SQL for the best (cost, edits, text) of each state after one more row, from those before it: e nothing yet, s after the
    system row, u after a user row, a after an assistant row."""

    def way(x: str, edits: str, cost: str, out: str, when: str = "true") -> str:
        return f"CASE WHEN {when} THEN {{'c': {x}.c + {cost}, 'p': {x}.p || '{edits}', 'o': {x}.o || {out}}} ELSE {NO_WAY} END"

    def stay(x: str, to: str, inserted: str = "") -> list[str]:
        name = {"u": "user", "a": "assistant", "s": "system"}[to]
        first, cost, edits = (f"chr(10) || '{inserted}:' || ", "5 + ", "I") if inserted else ("", "", "")
        row = first + "chr(10) || {} || ':' || text"
        out = [way(x, edits + "K", cost + "extra", row.format("role"), f"stays AND initial = '{to}'")]
        return out if to == "s" else [*out, way(x, edits + "R", cost + "1 + extra", row.format(f"'{name}'"), f"stays AND initial <> '{to}'")]

    ways = {
        "e": [],
        "s": stay("e", "s"),
        "u": [*stay("e", "u"), *stay("s", "u"), *stay("a", "u"), *stay("u", "u", "assistant")],
        "a": [*stay("u", "a"), *stay("e", "a", "user"), *stay("s", "a", "user"), *stay("a", "a", "user")],
    }
    return ", ".join(f"list_sort([{', '.join([way(y, 'D', '2', chr(39) * 2), *w])}])[1] AS {y}" for y, w in ways.items())


ORACLES["op13_structure_repair"] = f"""WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM k JOIN (VALUES (1), (2)) c(i) ON i = 1 OR kind = 3 WHERE kind <> 0
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, left(role, 1) AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM d
), r AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM o
), f AS (
  SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM r
), w AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, {{'c': 0, 'p': '', 'o': ''}} AS e, {NO_WAY} AS s, {NO_WAY} AS u, {NO_WAY} AS a FROM r
  UNION ALL
  SELECT w.conv_id, n + 1, {conversation_step()} FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = n + 1
), t AS (SELECT conv_id, arg_max(struct_pack(e := e, s := s, u := u, a := a), n) AS z FROM w GROUP BY conv_id
), b AS (SELECT conv_id, list_sort([z.e, z.a, {{'c': z.u.c + 5, 'p': z.u.p || 'I', 'o': z.u.o || chr(10) || 'assistant:'}},
    {{'c': z.s.c + 10, 'p': z.s.p || 'II', 'o': z.s.o || chr(10) || 'user:' || chr(10) || 'assistant:'}}])[1] AS z FROM t
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(z.c, 0)::BIGINT AS cost, coalesce(z.p, '') AS audit, sha256(coalesce(substr(z.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id"""
