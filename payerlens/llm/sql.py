"""DuckDB SQL for the queries that SQL can express. The others are tested by brute force."""

from __future__ import annotations

from payerlens.llm import mixing, packing

_WORDS = r"[^\x20\x09-\x0D]+"

OP2 = """
WITH vectors AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP3 = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM texts JOIN groups USING (t)
"""

OP7 = """
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
    SELECT doc_id, p, l[p + 1] AS a, l[p + 2] AS b, l[p + 3] AS c
    FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS p FROM lines WHERE len(l) >= 3)
), later AS (
    SELECT doc_id, p FROM (
        SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS n FROM windows
    ) WHERE n > 1
), covered AS (
    SELECT doc_id, list(DISTINCT p + k) AS gone
    FROM later, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
)
SELECT doc_id,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(
           list_filter(l, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text,
       CAST(coalesce(len(l), 0) AS INTEGER) AS line_count,
       CAST(coalesce(len(gone), 0) AS INTEGER) AS removed_lines
FROM lines LEFT JOIN covered USING (doc_id)
"""

OP8 = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{_WORDS}') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, w[i:i + 3] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM words WHERE len(w) >= 4)
        UNION ALL SELECT doc_id, w FROM words WHERE len(w) BETWEEN 1 AND 3
    )
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * i >= 80 * (x.n + y.n - i)
), reached(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM reached JOIN documents ON doc_id = a LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def _levels() -> str:
    """One group of CTEs for each level of the tree, as in the mixing operator's description."""
    parts, names = [], ["domain", "language", "source_name"]
    for depth, name in enumerate(names):
        keys, above = ", ".join(names[: depth + 1]), ", ".join(names[:depth])
        weights = mixing.LANGUAGE_WEIGHTS if name == "language" else {}
        weight = "CASE " + name + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"
        weight = weight if weights else "1"
        by = above or "1"
        source = f"leaves JOIN b{depth - 1} USING ({above})" if depth else "leaves, total"
        order = f"PARTITION BY {by} ORDER BY capacity::DOUBLE / weight, {name}"
        parts.append(f"""
n{depth} AS (SELECT {keys}, sum(tokens * {mixing.MAX_EPOCHS})::HUGEINT AS capacity, any_value(budget)::HUGEINT AS budget,
             ({weight})::HUGEINT AS weight FROM {source} GROUP BY {keys}),
o{depth} AS (SELECT *, coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
             sum(weight) OVER (PARTITION BY {by}) - coalesce(sum(weight) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
             FROM n{depth}),
p{depth} AS (SELECT *, greatest(budget - taken, 0) AS rest, greatest(budget - taken, 0) * weight >= capacity * open AS filled FROM o{depth}),
q{depth} AS (SELECT *, sum(CASE WHEN filled THEN 0 ELSE 1 END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > 0 AS later FROM p{depth}),
b{depth} AS (SELECT {keys}, CASE WHEN later THEN
             (max(CASE WHEN later THEN rest END) OVER (PARTITION BY {by}) * weight) // max(CASE WHEN later THEN open END) OVER (PARTITION BY {by})
             ELSE capacity END AS budget FROM q{depth}),""")
    return "".join(parts)


OP6 = rf"""
WITH base AS (
    SELECT doc_id, coalesce(lang, '') AS language, coalesce(source, '') AS source_name,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS tokens,
           substr(coalesce(source, ''), 1, greatest(length(coalesce(source, '')) - 1, 1)) AS domain
    FROM documents
), leaves AS (SELECT domain, language, source_name, sum(tokens) AS tokens FROM base GROUP BY ALL),
total AS (SELECT (sum(tokens) * {mixing.BUDGET_PERCENT}) // 100 AS budget FROM leaves),
{_levels()}
quotas AS (
    SELECT domain, language, source_name, (budget // tokens)::INTEGER AS full_epochs, (budget % tokens)::BIGINT AS part
    FROM leaves JOIN b2 USING (domain, language, source_name) WHERE tokens > 0 AND budget > 0
), keyed AS (
    SELECT *, md5(concat_ws('|', '{mixing.SEED}', full_epochs, doc_id)) AS order_key
    FROM base JOIN quotas USING (domain, language, source_name)
), prefix AS (
    SELECT *, sum(tokens) OVER (PARTITION BY domain, language, source_name
        ORDER BY order_key, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
    FROM keyed WHERE part > 0
)
SELECT doc_id, domain, language, source_name, tokens, full_epochs AS epoch FROM prefix WHERE so_far <= part
UNION ALL
SELECT doc_id, domain, language, source_name, tokens, CAST(unnest(range(0, full_epochs)) AS INTEGER) FROM keyed WHERE full_epochs > 0
"""


def _packing() -> str:
    """The dynamic program as one CTE per bucket; a state carries its boundaries."""
    best = ["d0 AS MATERIALIZED (SELECT 0 AS j, 0::HUGEINT AS cost, []::BIGINT[] AS bounds),"]
    for k in range(1, packing.BUCKETS + 1):
        best.append(f"""
s{k} AS MATERIALIZED (
    SELECT h.j, min(struct_pack(c := d.cost + h.length * (h.upto - coalesce(g.upto, 0)), i := d.j,
                                b := list_append(d.bounds, h.length))) AS s
    FROM d{k - 1} d JOIN numbered h ON h.j > d.j LEFT JOIN numbered g ON g.j = d.j GROUP BY h.j
), d{k} AS MATERIALIZED (
    SELECT coalesce(s.j, d.j) AS j,
           CASE WHEN d.j IS NULL OR s.s.c < d.cost THEN s.s.c ELSE d.cost END AS cost,
           CASE WHEN d.j IS NULL OR s.s.c < d.cost THEN s.s.b ELSE d.bounds END AS bounds
    FROM s{k} s FULL JOIN d{k - 1} d ON s.j = d.j
),""")
    return rf"""
WITH counted AS (
    SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS n FROM documents
), pieces AS MATERIALIZED (
    SELECT doc_id, piece, piece * {packing.MAX_LENGTH} AS token_start,
           least({packing.MAX_LENGTH}, n - piece * {packing.MAX_LENGTH}) AS length,
           md5(concat_ws('|', '{packing.SEED}', doc_id, piece)) AS order_key
    FROM (SELECT doc_id, n, unnest(range(0, greatest((n + {packing.MAX_LENGTH - 1}) // {packing.MAX_LENGTH}, 1))) AS piece FROM counted)
), histogram AS (SELECT length, count(*) AS c FROM pieces WHERE length > 0 GROUP BY length),
numbered AS MATERIALIZED (
    SELECT length, row_number() OVER (ORDER BY length) AS j, sum(c) OVER (ORDER BY length) AS upto FROM histogram
), {"".join(best)}
chosen AS (SELECT bounds FROM d{packing.BUCKETS} ORDER BY j DESC LIMIT 1),
placed AS (
    SELECT p.*, CASE WHEN length > 0 THEN len(list_filter(bounds, lambda b: b < length))::INTEGER END AS bucket, bounds
    FROM pieces p, chosen
), ordered AS (
    SELECT *, bounds[bucket + 1] AS padded_length,
           row_number() OVER (PARTITION BY bucket ORDER BY order_key, doc_id, piece, length) - 1 AS number
    FROM placed
), sized AS (SELECT *, greatest({packing.TOKEN_BUDGET} // padded_length, 1) AS size FROM ordered)
SELECT doc_id, piece, token_start, length, bucket, padded_length,
       CASE WHEN bucket IS NOT NULL THEN number // size END AS batch,
       CASE WHEN bucket IS NOT NULL THEN CAST(number % size AS INTEGER) END AS slot
FROM sized
"""


OP11 = rf"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
           regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w
    FROM documents
), marked AS (
    SELECT b.doc_id, part, [
        len(w) < 200,
        100 * len(list_distinct(w)) < 50 * len(w),
        100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t),
        regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
    FROM base b
), known AS (
    SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id
), rows AS (
    SELECT part, fails, len(list_filter(fails, lambda x: x)) AS failed,
           coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM marked LEFT JOIN known USING (doc_id)
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step::INTEGER AS step,
           list_transform(string_split(filter_order, ''), lambda x: ascii(x) - 64) AS ids
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
), decided AS (
    SELECT part, filter_order, step, good, toxic, failed, fails[ids[step]] AS here,
           len(list_filter(ids[1:step - 1], lambda i: fails[i])) > 0 AS before
    FROM rows, steps
)
SELECT part, filter_order, step,
       count(*) FILTER (NOT here AND NOT before) AS kept,
       count(*) FILTER (here AND NOT before) AS removed,
       count(*) FILTER (here AND before) AS redundant,
       count(*) FILTER (here AND failed = 1) AS unique_fails,
       count(*) FILTER (here AND NOT before AND good) AS good_lost,
       count(*) FILTER (here AND NOT before AND toxic) AS toxic_lost,
       CAST(coalesce(sum(120 // greatest(failed, 1)) FILTER (here), 0) AS BIGINT) AS shapley
FROM decided GROUP BY ALL
"""


_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, b: xor(c >> 8, bits[(xor(c, b) & 255) + 1])), 4294967295)"

OP12 = f"""
WITH bits AS (
    SELECT list(list_reduce(list_prepend(n, list_transform(range(8), lambda x: x)), lambda c, x: {_BIT}) ORDER BY n) AS bits
    FROM (SELECT unnest(range(256)) AS n)
), named AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
                         sha256(strlen(role) || ':' || role || text)) AS turns
    FROM named GROUP BY conv_id
), heads AS (SELECT conv_id, turns, {_CRC} % 9 AS h FROM own, bits),
built AS MATERIALIZED (
    SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS t
    FROM heads o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), members AS MATERIALIZED (
    SELECT conv_id, t[1:depth] AS prefix, depth, len(t) = depth AS ends
    FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM built)
), nodes AS MATERIALIZED (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * coalesce(strlen(prefix[depth].text), 0) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
           bool_and(ends) AS leaf
    FROM members GROUP BY prefix, depth
), below AS (
    SELECT a.prefix, sum(b.leaf::INT)::BIGINT AS n_leaves, sum(b.saved)::BIGINT AS saved_tokens,
           count(*) FILTER (b.depth = a.depth + 1) AS n_children
    FROM nodes a JOIN nodes b ON b.prefix[1:a.depth] = a.prefix AND b.depth >= a.depth GROUP BY a.prefix
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (prefix) LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""


LLM_SQL = {
    "op2_exact_topk": OP2,
    "op3_exact_dedup": OP3,
    "op5_packing": _packing(),
    "op6_mixing": OP6,
    "op7_line_dedup": OP7,
    "op8_near_dedup": OP8,
    "op11_filter_audit": OP11,
    "op12_prefix_trie": OP12,
}
