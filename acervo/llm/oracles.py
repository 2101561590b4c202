"""DuckDB SQL for the queries that SQL can state."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, unnest([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, greatest(2, len(ws) - 3))]) AS shingle
  FROM w WHERE len(ws) > 0),
c AS (SELECT doc_id, shingle, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT doc_id, sum(n) AS n FROM c GROUP BY ALL),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS common
  FROM c a JOIN c b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN t x ON p.a = x.doc_id JOIN t y ON p.b = y.doc_id
  WHERE common >= 0.8 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id AS node, doc_id AS reached FROM documents
  UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a)
SELECT node AS doc_id, min(reached) AS class_id FROM r GROUP BY node
"""

OP4 = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP6 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (
  SELECT page_id, octet_length(body) AS payload_bytes, CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits FROM p),
b AS (
  SELECT page_id, payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(list_sum([CAST(substr(bits, i * 5 + j, 1) AS INTEGER) * (1 << (5 - j))
      FOR j IN range(1, 6)]) AS INTEGER), 1) FOR i IN range(0, 32)], '') AS payload_digest FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

OP7 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS s, unnest([md5(array_to_string(ws[i:i + 19], ' ')) FOR i IN range(1, len(ws) - 18)]) AS h
  FROM w WHERE len(ws) >= 20),
o AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS place FROM g),
x AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM o WHERE place > 1),
m AS (SELECT doc_id, list(i) AS gone FROM x GROUP BY doc_id),
k AS (
  SELECT w.doc_id, ws, coalesce(gone, []) AS gone,
         [ws[i] FOR i IN range(1, len(ws) + 1) IF NOT list_contains(coalesce(gone, []), i)] AS kept
  FROM w LEFT JOIN m USING (doc_id)),
y AS (
  SELECT doc_id, s2 AS i FROM (SELECT DISTINCT doc_id, i AS s2 FROM x) z
  WHERE NOT EXISTS (SELECT 1 FROM x p WHERE p.doc_id = z.doc_id AND p.i = z.s2 - 1)),
n AS (SELECT doc_id, count(*) AS n_spans FROM y GROUP BY doc_id)
SELECT k.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k LEFT JOIN n USING (doc_id)
"""

WORDS8 = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = f"""
WITH w AS (SELECT doc_id, {WORDS8} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS8} AS ws FROM benchmark),
p AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n,
         unnest([array_to_string(ws[i:i + 9], ' ') FOR i IN range(1, greatest(2, len(ws) - 8))]) AS phrase
  FROM b WHERE len(ws) > 0),
z AS (SELECT DISTINCT n FROM p),
g AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS s,
         unnest([array_to_string(ws[i:i + n - 1], ' ') FOR i IN range(1, len(ws) - n + 2)]) AS phrase
  FROM w, z WHERE len(ws) >= n),
h AS (SELECT doc_id, s, g.n, item FROM g JOIN p ON g.n = p.n AND g.phrase = p.phrase),
x AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN x USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP10 = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
g AS (
  SELECT doc_id, unnest(range(0, CAST(length(x) / 2 AS BIGINT) - 99)) AS s,
         unnest([md5(substr(x, 2 * i + 1, 200)) FOR i IN range(0, CAST(length(x) / 2 AS BIGINT) - 99)]) AS h
  FROM b WHERE length(x) >= 200),
o AS (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS place FROM g),
r AS (SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM o WHERE place > 1),
q AS (SELECT doc_id, s, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r),
n AS (SELECT doc_id, run, min(s) AS s, max(s) + 100 AS e FROM q GROUP BY ALL),
m AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed, list(s ORDER BY s) AS ss, list(e ORDER BY s) AS es FROM n GROUP BY ALL),
k AS (
  SELECT b.doc_id, x, coalesce(n_spans, 0) AS n_spans, coalesce(n_removed, 0) AS n_removed,
         CASE WHEN ss IS NULL THEN x ELSE array_to_string([
           substr(x, 2 * coalesce(es[i - 1], 0) + 1, 2 * (coalesce(ss[i], CAST(length(x) / 2 AS BIGINT)) - coalesce(es[i - 1], 0)))
           FOR i IN range(1, len(ss) + 2)], '') END AS kept
  FROM b LEFT JOIN m USING (doc_id))
SELECT doc_id, CAST(length(x) / 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed,
       CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM k
"""

def crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII or UTF-8 text; reads the text's bytes from its hexadecimal form."""
    byte = "CAST('0x' || substr(hex(encode({t})), 2 * i + 1, 2) AS BIGINT)".format(t=text)
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
            f"[{byte} FOR i IN range(0, CAST(length(hex(encode({text}))) / 2 AS BIGINT))]), "
            "lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))))")


OP13 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, {crc32("CAST(doc_id AS VARCHAR)")} AS h
  FROM documents),
e AS (
  SELECT doc_id, len(ws) AS n, ws, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a,
         1 + (len(ws) - (h // 10) % greatest(len(ws), 1)) // (3 + (h // 10) % 8) AS p FROM d),
w AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN ws ELSE [ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(0, n)] END AS ws
  FROM e),
g AS (
  SELECT doc_id, unnest(range(0, n - 5)) AS i, unnest([md5(array_to_string(ws[j + 1:j + 6], ' ')) FOR j IN range(0, n - 5)]) AS gram
  FROM w WHERE n >= 12),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
o AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
c AS (SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS l FROM o GROUP BY doc_id, q, island HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
r AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c b WHERE b.doc_id = c.doc_id AND b.q < c.q AND b.s <= c.s AND b.s + b.l >= c.s + c.l)),
t AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         min([-l, s, q]) AS best FROM r GROUP BY doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(s + q, s + l)))) AS gone FROM r GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best[2] AS BIGINT) AS start, CAST(-best[1] AS BIGINT) AS length,
       CAST(best[3] AS BIGINT) AS period, CAST(-1000 * best[1] // best[3] AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(array_to_string([ws[i + 1] FOR i IN range(0, n) IF gone IS NULL OR NOT list_contains(gone, i)], ' ')) AS collapsed_sha256
FROM w LEFT JOIN t USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

def _state(of: list[str]) -> str:
    return f"list_min(list_filter([{', '.join(of)}], lambda z: z IS NOT NULL))"


def _edit(state: str, letter: str, cost: str, line: str | None = None, when: str = "true") -> str:
    """A state after an edit, null if the edit is not allowed or the state was not reached."""
    lines = f"{state}.o" if line is None else f"list_append({state}.o, {line})"
    return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {lines}}} END"


def _step() -> str:
    """The four states after a row, before insertions."""
    cut = "CASE WHEN cut THEN 3 ELSE 0 END"
    stay = "NOT blank AND NOT dup"

    def turn(state: str, initial: str) -> list[str]:
        role = {"u": "user", "a": "assistant"}.get(initial)
        kept = _edit(state, "K", cut, "role || ':' || text", f"{stay} AND ini = '{initial}'")
        return [kept] + ([_edit(state, "R", f"3 + {cut}", f"'{role}:' || text", stay)] if role else [])

    asked = [e for s in ("s0", "s1", "s3") for e in turn(s, "u")]
    return (f"{_state([_edit('s0', 'D', '4')])} AS t0, {_state([_edit('s1', 'D', '4'), *turn('s0', 's')])} AS t1, "
            f"{_state([_edit('s2', 'D', '4'), *asked])} AS t2, {_state([_edit('s3', 'D', '4'), *turn('s2', 'a')])} AS t3")


def _closed() -> str:
    """The four states with the insertions that may follow; user before assistant."""
    asked = _state(["t2", *[_edit(f"t{i}", "I", "3", "'user:'") for i in (0, 1, 3)]])
    return f"t0 AS s0, t1 AS s1, {asked} AS s2, t3"


ANSWERED = _state(["t3", _edit("s2", "I", "3", "'assistant:'")])


OP12 = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
r AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM r),
f AS (
  SELECT *, left(role, 1) AS ini, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS solid,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM o),
g AS MATERIALIZED (
  SELECT *, solid = '' AS blank, solid <> '' AND seen > 1 AS dup,
         solid <> '' AND seen = 1 AND right(solid, 1) NOT IN ('.', '!', '?') AS cut FROM f),
q AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
z AS (SELECT conv_id, {{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS t0 FROM q),
a0 AS (SELECT conv_id, t0, CASE WHEN t0.c > 0 THEN t0 END AS t1, CASE WHEN t0.c > 0 THEN t0 END AS t2, CASE WHEN t0.c > 0 THEN t0 END AS t3 FROM z),
d AS (
  SELECT conv_id, i, s0, s1, s2, {ANSWERED} AS s3 FROM (SELECT conv_id, CAST(0 AS BIGINT) AS i, {_closed()} FROM a0)
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {ANSWERED} AS s3 FROM (SELECT conv_id, i, {_closed()} FROM (
    SELECT g.conv_id, g.i, {_step()} FROM d JOIN g ON g.conv_id IS NOT DISTINCT FROM d.conv_id AND g.i = d.i + 1))),
e AS (SELECT d.conv_id, {_state(["s0", "s3"])} AS best FROM d JOIN q ON d.conv_id IS NOT DISTINCT FROM q.conv_id AND d.i = q.n),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM c LEFT JOIN q ON c.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

OP11 = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
