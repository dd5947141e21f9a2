"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANK = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str, pattern: str, lower: bool = True) -> str:
    """The list of words; null has none."""
    low = f"translate({text}, '{UPPER}', '{UPPER.lower()}')" if lower else text
    return f"coalesce(regexp_extract_all({low}, '{pattern}'), []::VARCHAR[])"


def runs(source: str, size: str) -> str:
    """Rows of ``source`` (with words) for every start ``i`` of a run of ``size`` words, and the run joined by blanks as ``run``."""
    return f"(SELECT *, array_to_string(words[i:i + {size} - 1], ' ') AS run FROM (SELECT *, unnest(range(1, len(words) - {size} + 2)) AS i FROM {source} WHERE len(words) >= {size}))"


OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {words('text', BLANK)} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, run FROM {runs('w', '3')} UNION SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) IN (1, 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
linked AS (SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY ALL)
  JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE a = w.doc_id) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id"""

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words('text', ALNUM)} AS words FROM documents),
items AS (SELECT item_id, words, least(len(words), 10) AS size FROM (SELECT item_id, {words('text', ALNUM)} AS words FROM benchmark) WHERE len(words) > 0),
wanted AS (SELECT DISTINCT item_id, size, run FROM {runs('items', 'size')}),
asked AS (SELECT r, words, size FROM d, (SELECT DISTINCT size FROM wanted) z),
found AS (SELECT r, i, size, run FROM {runs('asked', 'size')} SEMI JOIN wanted USING (size, run)),
hit AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS k FROM found) GROUP BY r),
met AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found JOIN wanted USING (size, run)) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(met.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated FROM d LEFT JOIN hit USING (r) LEFT JOIN met USING (r)"""

OP12 = f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {words('text', BLANK, lower=False)} AS words FROM documents),
g AS (SELECT r, i, md5(run) AS h FROM {runs('w', '35')}),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM g SEMI JOIN (SELECT h FROM g GROUP BY h HAVING count(*) > 1) USING (h)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY k) AS t FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM w) ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT r, count(*) AS n FROM gone GROUP BY r) USING (r) LEFT JOIN kept USING (r)"""

_CRC = "list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ord(x)::BIGINT)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))"
_NEXT = "CASE state WHEN 2 THEN 3 ELSE 2 END"
_KEEP = "CASE WHEN initial = 's' AND state = 0 THEN 1 WHEN initial = 'u' AND state IN (0, 1, 3) THEN 2 WHEN initial = 'a' AND state = 2 THEN 3 END"


def _stay(initials: str, then: str, rerole: str) -> str:
    """Cost of a row that stays: kept by its initial (pairs of initial and cost after), or with another role."""
    kept = " ".join(f"WHEN initial = '{x}' THEN {c}" for x, c in zip(initials, then.split(), strict=True))
    return f"CASE WHEN gone THEN 1000000000 ELSE more + least(1 + {rerole}, coalesce(CASE {kept} END, 1000000000)) END"


OP11 = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda k: list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
convs AS (SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({_CRC}, 4294967295) % 20 AS fault
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations), crc),
hurt AS (SELECT cid, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM given JOIN convs ON given.conv_id IS NOT DISTINCT FROM convs.conv_id WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY cid, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
  left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut FROM hurt),
judged AS (SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
c AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more,
  i > 1 AND lag(initial) OVER (PARTITION BY cid ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS bad FROM judged),
sizes AS (SELECT convs.cid, conv_id, count(c.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal FROM convs LEFT JOIN c ON c.cid = convs.cid GROUP BY ALL),
back AS (SELECT cid, n + 1 AS i, 0 AS v0, 10 AS v1, 5 AS v2, 0 AS v3 FROM sizes
  UNION ALL SELECT cid, i, least(r0, 5 + r2, 10 + r3), least(r1, 5 + r2, 10 + r3), least(r2, 5 + r3), least(r3, 5 + r2) FROM (
    SELECT b.cid, c.i, least(2 + v0, {_stay('su', 'v1 v2', 'v2')}) AS r0, least(2 + v1, {_stay('u', 'v2', 'v2')}) AS r1,
      least(2 + v2, {_stay('a', 'v3', 'v3')}) AS r2, least(2 + v3, {_stay('u', 'v2', 'v2')}) AS r3 FROM back b JOIN c ON c.cid = b.cid AND c.i = b.i - 1)),
cost AS (SELECT cid, i, [v0, v1, v2, v3] AS v FROM back),
walk AS (SELECT cid, 1::BIGINT AS i, 0 AS state, '' AS audit, []::VARCHAR[] AS lines FROM convs
  UNION ALL SELECT cid, i + (CASE WHEN move = 'I' THEN 0 ELSE 1 END), CASE move WHEN 'D' THEN state WHEN 'K' THEN {_KEEP} ELSE {_NEXT} END, audit || move,
    CASE WHEN move = 'D' THEN lines ELSE list_append(lines, CASE WHEN move = 'K' THEN role WHEN state = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN move = 'I' THEN '' ELSE text END) END
  FROM (SELECT w.*, c.role, c.text, c.initial, CASE WHEN c.i IS NOT NULL AND now.v[state + 1] = 2 + after.v[state + 1] THEN 'D' WHEN now.v[state + 1] = 5 + now.v[{_NEXT} + 1] THEN 'I'
      WHEN NOT c.gone AND now.v[state + 1] = c.more + after.v[{_KEEP} + 1] THEN 'K' ELSE 'R' END AS move
    FROM walk w JOIN cost now ON now.cid = w.cid AND now.i = w.i LEFT JOIN cost after ON after.cid = w.cid AND after.i = w.i + 1 LEFT JOIN c ON c.cid = w.cid AND c.i = w.i
    WHERE NOT (c.i IS NULL AND state IN (0, 3))))
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, (SELECT v[1]::BIGINT FROM cost WHERE cost.cid = sizes.cid AND i = 1) AS cost, audit,
  sha256(array_to_string(lines, chr(10))) AS repaired_sha256 FROM sizes JOIN walk ON walk.cid = sizes.cid AND walk.i = n + 1 AND state IN (0, 3)"""

SQL: dict[str, str] = {"op1_ngram_jaccard": OP1, "op2_decontamination": OP2, "op11_conversation_repair": OP11, "op12_substring_dedup": OP12}
