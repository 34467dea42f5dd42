"""SQL for DuckDB that states what some of the queries return, written without regard to how they get there."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    octets = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS UBIGINT))"
    bit = "lambda x, i: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1))"
    octet = f"lambda crc, b: list_reduce([xor(crc, b)] || [CAST(0 AS UBIGINT) FOR i IN range(8)], {bit})"
    return f"xor(list_reduce([CAST(4294967295 AS UBIGINT)] || {octets}, {octet}), CAST(4294967295 AS UBIGINT))"


JACCARD = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])))
            END AS g FROM words),
    listed AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM sets),
    shared AS (
        SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
        FROM listed a JOIN listed b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    links AS (SELECT u, v FROM shared WHERE 100 * c >= 90 * (n + m - c)),
    sides AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
    reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents WHERE doc_id IS NOT NULL
        UNION SELECT r.doc_id, b.v FROM reach r JOIN sides b ON b.u = r.other)
    SELECT sets.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, min(other) AS component_id
    FROM sets LEFT JOIN reach USING (doc_id) GROUP BY sets.doc_id, g"""

# Bytes as pairs of hexadecimal digits, windows cut from blocks of a thousand bytes.
REPEATS = """
    WITH docs AS (
        SELECT doc_id, encode(coalesce(text, '')) AS raw, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    blocks AS (
        SELECT doc_id, k, substr(h, 2000 * k + 1, 2198) AS piece
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2000 + 1)) AS k FROM docs)),
    windows AS (
        SELECT doc_id, 1000 * k + j AS s, substr(piece, 2 * j + 1, 200) AS w
        FROM (SELECT doc_id, k, piece, unnest(range(0, least(1000, length(piece) // 2 - 99))) AS j FROM blocks)),
    later AS (
        SELECT doc_id, s FROM windows
        QUALIFY row_number() OVER (PARTITION BY md5_number(w) ORDER BY doc_id, s) > 1),
    begun AS (
        SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM later),
    numbered AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM begun),
    spans AS (SELECT doc_id, span, min(s) AS a, max(s) + 100 AS b FROM numbered GROUP BY doc_id, span),
    kept AS (
        SELECT doc_id, span, substr(h, 2 * lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY span) + 1,
                   2 * (a - lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY span))) AS piece
        FROM spans JOIN docs USING (doc_id)),
    cut AS (
        SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS b FROM spans GROUP BY doc_id),
    rest AS (SELECT doc_id, string_agg(piece, '' ORDER BY span) AS piece FROM kept GROUP BY doc_id)
    SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           CASE WHEN n_removed IS NULL THEN sha256(raw) ELSE sha256(unhex(concat(rest.piece, substr(h, 2 * b + 1)))) END
           AS kept_sha256
    FROM docs LEFT JOIN cut USING (doc_id) LEFT JOIN rest USING (doc_id)"""

TRIE = f"""
    WITH RECURSIVE own AS (
        SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT c, {_crc32("CAST(c AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT c FROM own)),
    turns AS (
        SELECT ids.c, 0 AS part, o.i, o.r, o.t FROM ids JOIN own o ON o.c = ids.c - ids.c % 100 AND o.i <= h
        UNION ALL SELECT c, 1, i, r, t FROM own JOIN ids USING (c) WHERE i > h),
    built AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM turns),
    paths(c, depth, key, parent, chars) AS (
        SELECT c, CAST(0 AS BIGINT), '', CAST(NULL AS VARCHAR), CAST(0 AS BIGINT) FROM ids
        UNION ALL SELECT b.c, b.d, md5(concat(p.key, '/', length(b.r), ':', b.r, b.t)), p.key, CAST(length(b.t) AS BIGINT)
        FROM paths p JOIN built b ON b.c = p.c AND b.d = p.depth + 1),
    nodes AS (
        SELECT key, depth, min(parent) AS parent, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars
        FROM paths GROUP BY key, depth),
    children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
    below AS (
        SELECT DISTINCT a.key, b.key AS under FROM paths a JOIN paths b ON a.c = b.c AND a.depth <= b.depth),
    sums AS (
        SELECT below.key, count(*) FILTER (WHERE children.n IS NULL) AS n_leaves,
               sum((nodes.n_convs - 1) * nodes.chars) AS saved
        FROM below JOIN nodes ON nodes.key = under LEFT JOIN children ON children.parent = under GROUP BY below.key),
    lengths AS (SELECT c, max(depth) AS depth FROM paths GROUP BY c),
    ends AS (
        SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS members
        FROM paths JOIN lengths USING (c, depth) GROUP BY key)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(children.n, 0) AS n_children,
           n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(members, '')) AS ends_sha256
    FROM nodes n JOIN sums USING (key) LEFT JOIN nodes p ON p.key = n.parent LEFT JOIN children ON children.parent = n.key
    LEFT JOIN ends ON ends.key = n.key"""

# Positions 1 to 4: start, after a system, a user and an assistant turn. f[p] is the least cost from row i on; what must
# go or cannot be kept costs a million.
REPAIR = f"""
    WITH RECURSIVE hits AS (
        SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("concat(conv_id, ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS hit
        FROM conversations WHERE conv_id IS NOT NULL),
    damaged AS (
        SELECT c, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
               CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hits),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
               regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS ink FROM damaged),
    seen AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS nth FROM placed),
    rows AS (
        SELECT *, left(role, 1) AS initial, CASE WHEN ink = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
            WHEN ink NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
            lead(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS after FROM seen),
    ids AS (SELECT c, coalesce(max(i), 0) AS m FROM (SELECT DISTINCT c FROM hits) LEFT JOIN rows USING (c) GROUP BY c),
    costed AS (
        SELECT *, CASE fault WHEN 'blank' THEN 1000000 WHEN 'duplicate' THEN 1000000 WHEN 'truncated' THEN 3 ELSE 0 END AS x,
               CASE initial WHEN 's' THEN [2, 5, 5, 5] WHEN 'u' THEN [3, 3, 5, 3] WHEN 'a' THEN [5, 5, 4, 5]
                   ELSE [5, 5, 5, 5] END AS kept FROM rows),
    least_cost(c, i, f) AS (
        SELECT c, m + 1, [0, 6, 3, 0, 1000000] FROM ids
        UNION ALL
        SELECT c, i, [least(b[1], 3 + least(b[3], 3 + b[4])), least(b[2], 3 + least(b[3], 3 + b[4])),
                      least(b[3], 3 + b[4]), least(b[4], 3 + b[3]), 1000000]
        FROM (SELECT r.c, r.i, list_transform([1, 2, 3, 4], lambda p: least(4 + l.f[p], x + l.f[kept[p]],
                  x + 3 + l.f[[3, 3, 4, 3][p]])) AS b
              FROM least_cost l JOIN costed r ON r.c = l.c AND r.i = l.i - 1)),
    edits(c, i, p, audit, written) AS (
        SELECT c, CAST(1 AS BIGINT), 1, '', '' FROM ids
        UNION ALL
        SELECT c, CASE edit WHEN 'I' THEN i ELSE i + 1 END,
               CASE edit WHEN 'D' THEN p WHEN 'K' THEN kept[p] ELSE [3, 3, 4, 3][p] END, concat(audit, edit),
               CASE edit WHEN 'D' THEN written ELSE concat(written, CASE WHEN written = '' THEN '' ELSE chr(10) END,
                   CASE edit WHEN 'K' THEN role ELSE [NULL, NULL, 'user', 'assistant'][[3, 3, 4, 3][p]] END, ':',
                   CASE edit WHEN 'I' THEN '' ELSE text END) END
        FROM (SELECT e.*, r.role, r.text, r.kept, CASE
                  WHEN r.i IS NOT NULL AND l.f[p] = 4 + n.f[p] THEN 'D'
                  WHEN l.f[p] = 3 + l.f[[3, 3, 4, 3][p]] THEN 'I'
                  WHEN r.i IS NOT NULL AND l.f[p] = r.x + n.f[r.kept[p]] THEN 'K'
                  WHEN r.i IS NOT NULL AND l.f[p] = r.x + 3 + n.f[[3, 3, 4, 3][p]] THEN 'R' END AS edit
              FROM edits e JOIN least_cost l ON l.c = e.c AND l.i = e.i LEFT JOIN costed r ON r.c = e.c AND r.i = e.i
              LEFT JOIN least_cost n ON n.c = e.c AND n.i = e.i + 1)
        WHERE edit IS NOT NULL),
    last AS (SELECT c, arg_max(audit, length(audit)) AS audit, arg_max(written, length(audit)) AS written
             FROM edits GROUP BY c),
    stats AS (
        SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
               count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
               count(*) FILTER (WHERE after IS NOT NULL AND concat(initial, after) NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY c)
    SELECT ids.c AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(f[1] AS BIGINT) AS cost, audit,
           sha256(written) AS repaired_sha256
    FROM ids JOIN least_cost l ON l.c = ids.c AND l.i = 1 JOIN last ON last.c = ids.c LEFT JOIN stats ON stats.c = ids.c"""
