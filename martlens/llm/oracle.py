"""DuckDB text for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, separators: str) -> str:
    """List of the words of a lower-cased text; null has none."""
    return (f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{separators}'), "
            "lambda w: w <> '')")


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    step = "lambda c, i: (c >> 1) # CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END"
    step = step.replace("(c >> 1) #", "xor(c >> 1,").replace(" ELSE 0 END", " ELSE 0 END)")
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return (f"xor(list_reduce({codes}, lambda a, x: list_reduce(range(8), {step}, xor(a, x)), 4294967295), 4294967295)")


def _edits() -> str:
    """The four candidates lists after a row, as SQL over the states m and the row's initial, fault, role and text."""
    role, to = ["user", "user", "assistant", "user"], [2, 2, 3, 2]
    lists: list[list[str]] = [[] for _ in range(4)]
    for start in range(4):
        state, letters, turns, cost = start, "", "", 0
        for _ in range(3):
            def add(after, letter, price, when, turn, m=f"m[{start + 1}]", letters=letters, turns=turns, cost=cost):
                lists[after].append(f"CASE WHEN {m} IS NOT NULL AND {when} THEN {{'c': {m}.c + {cost} + {price}, "
                                    f"'a': {m}.a || '{letters}{letter}', 'r': {m}.r || {turns or "''"} || {turn}}} END")

            extra = "CASE WHEN fault = 't' THEN 5 ELSE 0 END"
            stays = "fault NOT IN ('b', 'd')"
            add(state, "D", "2", "true", "''")
            add(to[state], "R", f"1 + {extra}", stays, f"chr(10) || '{role[state]}:' || text")
            add(to[state], "K", extra, f"{stays} AND initial = '{role[state][0]}'", "chr(10) || role || ':' || text")
            if state == 0:
                add(1, "K", extra, f"{stays} AND initial = 's'", "chr(10) || role || ':' || text")
            letters, cost = letters + "I", cost + 5
            turns = (turns + " || " if turns else "") + f"chr(10) || '{role[state]}:'"
            state = to[state]
    return "[" + ",\n    ".join(f"list_min(list_filter([{', '.join(x)}], lambda x: x IS NOT NULL))" for x in lists) + "]"


ORACLE: dict[str, str] = {
    "op1_minhash": f"""
WITH RECURSIVE
w AS (SELECT doc_id, {_words("text", "[\\x20\\x09-\\x0D]+")} AS w FROM documents),
s AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM w),
shingle AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
link AS (
  SELECT a.doc_id AS i, b.doc_id AS j
  FROM shingle a JOIN shingle b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 85 * (max(a.n) + max(b.n) - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.j FROM reach r JOIN link l ON l.i = r.other),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN component c USING (doc_id)
""",
    "op8_decontaminate": f"""
WITH
d AS (SELECT doc_id, {_words("text", "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, {_words("text", "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")} AS v FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, unnest([array_to_string(v[k:k + n - 1], ' ') FOR k IN range(1, len(v) - n + 2)]) AS x
  FROM (SELECT *, least(10, len(v)) AS n FROM i WHERE len(v) > 0 AND item_id IS NOT NULL)),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, unnest([array_to_string(w[k:k + n - 1], ' ') FOR k IN range(1, len(w) - n + 2)]) AS x
  FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n),
occ AS (SELECT doc_id, item_id, p, n FROM dw JOIN iw USING (n, x)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op6_mixing": """
WITH RECURSIVE
docs AS (SELECT doc_id, coalesce(source, '(none)') AS source, sha256(doc_id::VARCHAR) AS h FROM documents),
w AS (SELECT source, floor(pow(count(*), 0.5) * 1000)::BIGINT AS w FROM docs GROUP BY source),
f AS (SELECT greatest(1000, 4 * count(*))::BIGINT AS frame, count(*) AS n, sum(w)::BIGINT AS total FROM w),
base AS (
  SELECT source, 1 + (frame - n) * w // total AS q, frame,
    row_number() OVER (ORDER BY (frame - n) * w % total DESC, source) AS place,
    frame - sum(1 + (frame - n) * w // total) OVER () AS spare
  FROM w, f),
share AS (SELECT source, (q + (place <= spare)::INT)::BIGINT AS q, frame FROM base),
q AS (SELECT list(q ORDER BY source) AS q, list(source ORDER BY source) AS name, max(frame) AS frame FROM share),
edf AS (
  SELECT 0::BIGINT AS slot, list_transform(q, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS pick, NULL::BIGINT AS turn FROM q
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda x, i: x + (i = best.i)::BIGINT), best.i, done[best.i]
  FROM (
    SELECT slot, done, list_min(list_filter(
      list_transform(done, lambda x, i: {'due': ((x + 1) * frame + q[i] - 1) // q[i], 'i': i, 'ready': x < q[i] AND x * frame // q[i] <= slot}),
      lambda c: c.ready)) AS best
    FROM edf, q WHERE slot < frame)),
frame_plan AS (
  SELECT name[pick] AS source, turn, slot - 1 AS slot, turn * frame // q[pick] AS release, ((turn + 1) * frame + q[pick] - 1) // q[pick] AS deadline
  FROM edf, q WHERE pick IS NOT NULL),
ranked AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) - 1 AS r FROM docs)
SELECT doc_id, source, r // 16 AS block, r % 16 AS place,
  r // 16 // q * frame + slot AS slot, r // 16 // q * frame + release AS release, r // 16 // q * frame + deadline AS deadline
FROM ranked JOIN share USING (source) JOIN frame_plan p USING (source)
WHERE p.turn = r // 16 % q
""",
    "op5_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p
""",
    "op7_substrings": """
WITH
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS p, unnest([array_to_string(w[k:k + 34], ' ') FOR k IN range(1, len(w) - 33)]) AS x
  FROM d WHERE len(w) >= 35),
again AS (SELECT doc_id, p FROM win WHERE x IN (SELECT x FROM win GROUP BY x HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM again),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS text
  FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
""",
    "op11_trie": f"""
WITH
c AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos, id, n
  FROM (SELECT conv_id, turn, sha256(strlen(role)::VARCHAR || ':' || role || text) AS id, strlen(text) AS n
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))),
v AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM c)),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d, id, n FROM (
    SELECT v.conv_id, 0 AS own, c.pos, c.id, c.n FROM v JOIN c ON c.conv_id = v.conv_id - v.conv_id % 5 AND c.pos <= v.h
    UNION ALL
    SELECT conv_id, 1, pos, id, n FROM v JOIN c USING (conv_id) WHERE pos > h)),
paths AS (SELECT conv_id, d, n, list(id) OVER (PARTITION BY conv_id ORDER BY d) AS path FROM turns),
visits AS (
  SELECT conv_id, d, n, path, path[1:d - 1] AS up FROM paths
  UNION ALL SELECT conv_id, 0, 0, [], NULL FROM v),
nodes AS (SELECT path, any_value(up) AS up, min(conv_id) AS conv_id, any_value(d) AS d, any_value(n) AS n, count(*) AS n_convs FROM visits GROUP BY path),
kids AS (SELECT up AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY up),
below AS (
  SELECT t.path, count(*) FILTER (k.path IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.n) AS saved
  FROM nodes m LEFT JOIN kids k ON k.path = m.path JOIN visits t ON t.conv_id = m.conv_id AND t.d <= m.d GROUP BY t.path),
stops AS (SELECT conv_id, max(d) AS d FROM visits GROUP BY conv_id),
ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha FROM visits JOIN stops USING (conv_id, d) GROUP BY path)
SELECT n.conv_id::BIGINT AS conv_id, n.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.path = n.up LEFT JOIN kids k ON k.path = n.path JOIN below b ON b.path = n.path LEFT JOIN ends e ON e.path = n.path
""",
    "op13_repair": f"""
WITH RECURSIVE
keyed AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, lag(left(role, 1)) OVER w AS was, left(role, 1) AS initial
  FROM damaged WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 't' ELSE 'o' END AS fault
  FROM placed),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (was IS NOT NULL AND was || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv),
walk(conv, i, m) AS (
  SELECT conv, 0::BIGINT, [{{'c': 0::BIGINT, 'a': '', 'r': ''}}, NULL, NULL, NULL] FROM counts
  UNION ALL
  SELECT w.conv, f.i, {_edits()}
  FROM walk w JOIN faulty f ON f.conv = w.conv AND f.i = w.i + 1),
best AS (
  SELECT w.conv, list_min(list_filter([m[1], m[4],
    CASE WHEN m[3] IS NOT NULL THEN {{'c': m[3].c + 5, 'a': m[3].a || 'I', 'r': m[3].r || chr(10) || 'assistant:'}} END,
    CASE WHEN m[2] IS NOT NULL THEN {{'c': m[2].c + 10, 'a': m[2].a || 'II', 'r': m[2].r || chr(10) || 'user:' || chr(10) || 'assistant:'}} END],
    lambda x: x IS NOT NULL)) AS b
  FROM walk w JOIN counts c ON c.conv = w.conv AND c.n = w.i)
SELECT k.conv_id::BIGINT AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv, conv_id FROM keyed) k LEFT JOIN counts c ON c.conv = k.conv LEFT JOIN best e ON e.conv = k.conv
""",
}
