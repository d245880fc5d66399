"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every window of an item is one joined string; document windows of the same sizes are looked up in it.
OP7_SQL = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), doc_windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), matches AS (
  SELECT doc_id, item_id, k, i FROM doc_windows JOIN windows USING (k, gram)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM matches) GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(o.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(o.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN owners o USING (doc_id)
"""

# CRC-32 of an id's decimal text: shift right per bit, with the reflected polynomial where a one falls out.
CRC32 = ("xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), "
         "lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), "
         "lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)")

# Bigram automaton, mu = 50: (c(h,w) + 50 P(w)) / (c(h) + 50) where the context was seen, P(w) elsewhere.
OP2_SQL = rf"""
WITH toks AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({CRC32.format("doc_id")} % 7 = 2, false) AS held_out,
    list_append(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+'), chr(10)) AS w
  FROM documents
), seq AS (
  SELECT r, held_out, unnest(w) AS w, unnest(list_concat([chr(10)], w[:-2])) AS h FROM toks
), uni AS (
  SELECT w, count(*) AS c FROM seq WHERE NOT held_out GROUP BY w
), bi AS (
  SELECT h, w, count(*) AS c FROM seq WHERE NOT held_out GROUP BY h, w
), size AS (
  SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM uni
), scored AS (
  SELECT s.r, count(*) AS n_tokens, count(u.c) AS n_known,
    round(fsum(log10((coalesce(u.c, 0) + 1) / (n + v + 1))), 6) AS base_score,
    round(fsum(log10(CASE WHEN g.c IS NULL THEN (coalesce(u.c, 0) + 1) / (n + v + 1)
      ELSE (coalesce(b.c, 0) + 50 * ((coalesce(u.c, 0) + 1) / (n + v + 1))) / (g.c + 50) END)), 6) AS score
  FROM seq s CROSS JOIN size LEFT JOIN uni u ON s.w = u.w LEFT JOIN uni g ON s.h = g.w
    LEFT JOIN bi b ON s.h = b.h AND s.w = b.w GROUP BY s.r
)
SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, base_score, score
FROM toks JOIN scored USING (r), size
"""

# Every usable vector as integers; products of equal length lists, best five of each query.
OP8_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""


def _any_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


_ASSIGN = f"(?:{_any_case('password|passwd|secret|token|api_?key')})" + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _found(rank: int, pattern: str, group: int = 0, of: str = "t") -> str:
    return (f"SELECT r, {rank} AS rank, regexp_extract_all({of}, '{pattern}') AS f, regexp_extract_all({of}, '{pattern}', {group}) AS v, "
            f"string_split_regex({of}, '{pattern}') AS g FROM d")


def _blank(text: str, pattern: str, also: str = "true") -> str:
    """Spaces in place of the matches that also fulfil a condition on ``m``."""
    blanked = f"list_transform(regexp_extract_all({text}, '{pattern}'), lambda m: CASE WHEN {also} THEN repeat(' ', length(m)) ELSE m END)"
    return f"array_to_string(list_transform(list_zip(string_split_regex({text}, '{pattern}'), {blanked}), lambda p: p[1] || coalesce(p[2], '')), '')"


_WORDS = "example|sample|dummy|placeholder|changeme|redacted|yourkey|yourtoken|yoursecret|abcdefgh|01234567|12345678"
_RUNS = "|".join(f"{c}{{6,}}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789/_=-") + "|[+]{6,}"

# Matches with the lengths of what stands before them added up; every window's entropy from a fresh count of its characters.
OP3_SQL = rf"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
pieces AS (SELECT *, CASE WHEN regexp_matches(t, '[A-Za-z0-9+/_=-]{{20,}}') THEN {_blank('t', '[A-Za-z0-9+]+', f"regexp_matches(lower(m), '{_WORDS}')")} ELSE '' END AS p FROM given),
d AS (SELECT *, {_blank('p', _RUNS)} AS o FROM pieces),
m AS ({_found(0, _ASSIGN, 1)} UNION ALL {_found(1, 'AKIA[A-Z0-9]+')} UNION ALL {_found(2, '[0-9a-f]+')}
  UNION ALL {_found(3, '[A-Za-z0-9+/_=-]{20,}', of='o')}),
e AS (SELECT r, rank, unnest(f) AS x, unnest(v) AS v, unnest(g[:len(f)]) AS gap, unnest(range(1, len(f) + 1)) AS k FROM m WHERE len(f) > 0),
p AS (SELECT r, rank, x, v, CAST(sum(length(gap) + length(x)) OVER (PARTITION BY r, rank ORDER BY k) AS BIGINT) AS stop FROM e),
base AS (SELECT r, rank, stop - length(x) AS start, stop FROM p
  WHERE (rank = 0 AND length(v) >= 8) OR (rank = 1 AND length(x) >= 16) OR (rank = 2 AND length(x) >= 32)),
cand AS (SELECT row_number() OVER () AS c, r, x, stop - length(x) AS start,
    CASE WHEN regexp_full_match(x, '[0-9a-fA-F]+') THEN 3.0 WHEN regexp_full_match(x, '[A-Za-z/_=+-]+') THEN 4.05 WHEN regexp_full_match(x, '[A-Za-z0-9]+') THEN 3.7 ELSE 3.8 END AS least
  FROM p WHERE rank = 3
    AND NOT regexp_matches(lower(x), '^sha(1|256|384|512)-')
    AND NOT regexp_full_match(x, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}')
    AND NOT regexp_full_match(x, '[0-9/_=+-]*')),
win AS (SELECT c, i, unnest(string_split(x[i:i + 19], '')) AS ch FROM (SELECT c, x, unnest(range(1, length(x) - 18)) AS i FROM cand)),
ent AS (SELECT c, i, -sum(n / 20 * log2(n / 20)) AS h FROM (SELECT c, i, ch, count(*) AS n FROM win GROUP BY ALL) GROUP BY ALL),
hot AS (SELECT cand.r, 3 AS rank, any_value(start) + min(i) - 1 AS start, any_value(start) + max(i) + 19 AS stop
  FROM ent JOIN cand USING (c) WHERE h >= least - 1e-9 GROUP BY c, cand.r),
spans AS (SELECT * FROM base UNION ALL
  SELECT r, rank, start, stop FROM hot WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = hot.r AND b.start < hot.stop AND b.stop > hot.start)),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][rank + 1] || ':' || start || ':' || stop AS s FROM spans),
per AS (SELECT r, count_if(rank = 0) AS n_assign, count_if(rank = 1) AS n_access, count_if(rank = 2) AS n_hex, count_if(rank = 3) AS n_entropy,
    string_agg(s, ',' ORDER BY start, rank, stop) FILTER (WHERE rank < 3) AS base, string_agg(s, ',' ORDER BY start, rank, stop) AS spans
  FROM named GROUP BY r)
SELECT d.doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, CAST(coalesce(n_entropy, 0) AS BIGINT) AS n_entropy,
  sha256(coalesce(per.base, '')) AS base_sha256, coalesce(per.spans, '') AS spans
FROM d LEFT JOIN per USING (r)
"""

def _cluster_sql(k: int = 8, rounds: int = 10) -> str:
    """Every round as two tables: the nearest centroid of each vector, then floored means by division with a remainder that is never negative."""
    out = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS INTEGER) AS c, v
  FROM kept QUALIFY c < {k}
)"""]
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(kept.v) AS v,
    min([list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c]) AS near
  FROM kept CROSS JOIN c{i} GROUP BY r
)""")
        if i < rounds:
            out.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v
    FROM (SELECT c, d, sum(x) AS s, count(*) AS n FROM (SELECT near[2] AS c, unnest(v) AS x, unnest(range(64)) AS d FROM a{i}) GROUP BY ALL) GROUP BY c
  ) m USING (c)
)""")
    return ",\n".join(out) + f"""
SELECT vec_id, CAST(near[2] AS INTEGER) AS cluster, CAST(near[1] AS BIGINT) AS distance,
  CAST(sum(near[1]) OVER (PARTITION BY near[2]) AS BIGINT) AS cluster_inertia, CAST(sum(near[1]) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON near[2] = c
"""


OP11_SQL = _cluster_sql()


def _least(*ways: str) -> str:
    """The cheapest of (cost, audit) rows, NULL ones aside; equal costs by audit."""
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w.c IS NOT NULL))"


def _way(place: str, cost: str, edit: str, when: str = "true") -> str:
    return f"CASE WHEN {when} THEN {{'c': {place}.c + {cost}, 'a': {place}.a || '{edit}'}} END"


def _repair_sql() -> str:
    """Whole audits as strings, one row of every conversation per step; the damage is dealt by the same checksum as elsewhere."""
    stays = "f IN (0, 3)"
    more = "5 * CAST(f = 3 AS INT)"
    edit = lambda place, initial, to: [_way(place, more, "K", f"{stays} AND i = '{initial}'")] + ([_way(place, f"1 + {more}", "R", stays)] if to else [])
    step = {
        "e": [_way("e", "2", "D")],
        "s": [_way("s", "2", "D"), *edit("e", "s", False)],
        "u": [_way("u", "2", "D"), *(w for p in ("e", "s", "p") for w in edit(p, "u", True))],
        "p": [_way("p", "2", "D"), *edit("u", "a", True)],
    }
    inserted = (f"SELECT *, {_least('p0', _way('u', '5', 'I'))} AS p FROM (SELECT * EXCLUDE (u, p), p AS p0, "
                f"{_least('u', _way('e', '5', 'I'), _way('s', '5', 'I'), _way('p', '5', 'I'))} AS u FROM %s)")
    crc = CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    white = r"\x20\x09-\x0D"
    return rf"""
WITH RECURSIVE dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM dealt WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER w AS k, role[1] AS i, lag(role[1]) OVER w || role[1] AS pair,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), turns AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, CASE WHEN NOT regexp_matches(text, '[^{white}]') THEN 1 WHEN nth > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][{white}]*$') THEN 3 ELSE 0 END AS f FROM placed
), dp AS (
  SELECT c, 0::BIGINT AS k, {{'c': 0, 'a': ''}} AS e, {{'c': NULL::INTEGER, 'a': NULL::VARCHAR}} AS s, s AS u, s AS p FROM turns GROUP BY c
  UNION ALL
  SELECT c, k, {_least(*step['e'])} AS e, {_least(*step['s'])} AS s, {_least(*step['u'])} AS u, {_least(*step['p'])} AS p
  FROM (SELECT x.* EXCLUDE (k), turns.k, i, f FROM ({inserted % 'dp'}) x JOIN turns ON turns.c = x.c AND turns.k = x.k + 1)
), done AS (
  SELECT c, best.c AS cost, best.a AS audit FROM (SELECT c, {_least('e', 'p')} AS best FROM ({inserted % '(SELECT * FROM dp QUALIFY k = max(k) OVER (PARTITION BY c))'}))
), edits AS (
  SELECT c, n, audit[n] AS edit, n - length(replace(audit[1:n], 'I', '')) AS inserted, length(replace(audit[1:n], 'D', '')) AS m
  FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS n FROM done)
), kept AS (
  SELECT edits.c, m, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, CASE WHEN edit = 'K' THEN role END AS role,
    max(CASE WHEN m = 1 AND edit = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY edits.c) AS led
  FROM edits LEFT JOIN turns ON turns.c = edits.c AND turns.k = n - inserted AND edit <> 'I' WHERE edit <> 'D'
), lines AS (
  SELECT c, string_agg(coalesce(role, CASE WHEN (m - led) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY m) AS lines FROM kept GROUP BY c
), counted AS (
  SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(f = 1) AS blank,
    count_if(f = 2) AS duplicate, count_if(f = 3) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY c
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN done USING (c) LEFT JOIN lines USING (c)
"""


OP13_SQL = _repair_sql()
