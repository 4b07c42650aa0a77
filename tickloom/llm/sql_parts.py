"""SQL of the contracts that needs more than a line: crc32, positions of matches, the trie, the word groups."""

from __future__ import annotations

#: One row (t): the 256 words of crc32's table, from its polynomial.
CRC_TABLE = """
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i)
    )
"""


def crc32(text: str, table: str = "t") -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; ``table`` is the column of CRC_TABLE."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda p: ('0x' || substr(hex(encode({text})), 2 * p + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: xor(c >> 8, {table}[xor(c, b) % 256 + 1])), 4294967295)"


def _spans(kind: str, rank: int, pattern: str, keep: str) -> str:
    found, between = f"regexp_extract_all(x, '{pattern}')", f"string_split_regex(x, '{pattern}')"
    return f"""
        SELECT doc_id, row_id, '{kind}' AS kind, {rank} AS rank, m, list_sum(list_transform(b[1:k], lambda s: length(s))) + coalesce(list_sum(list_transform(f[1:k - 1], lambda s: length(s))), 0) AS start
        FROM (SELECT doc_id, row_id, f, b, unnest(f) AS m, unnest(range(1, len(f) + 1)) AS k FROM (SELECT doc_id, row_id, {found} AS f, {between} AS b FROM texts)) WHERE {keep}
    """


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_VALUE = "[A-Za-z0-9+/_.=-]"
_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
_BEFORE = f"(?:{_NAMES})[\"'']?\\x20*[:=]\\x20*[\"'']?"

#: Columns of op12 that patterns alone decide.
BASE_SPANS = f"""
    WITH texts AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS x FROM documents),
    spans AS (
        {_spans("assign", 0, f"{_BEFORE}{_VALUE}+", f"length(regexp_replace(m, '^{_BEFORE}', '')) >= 6")}
        UNION ALL {_spans("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 20")}
        UNION ALL {_spans("hex", 2, "[0-9a-f]+", "length(m) >= 24")}
    )
    SELECT t.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           sha256(coalesce(string_agg(kind || ':' || start::BIGINT || ':' || (start + length(m))::BIGINT, ',' ORDER BY start, rank), '')) AS base_sha256
    FROM texts t LEFT JOIN spans s ON t.row_id = s.row_id GROUP BY t.doc_id, t.row_id
"""

SPELLING = f"""
    WITH RECURSIVE crc AS MATERIALIZED ({CRC_TABLE}),
    runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
    ),
    hashed AS (SELECT run, k, {crc32("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc),
    n AS MATERIALIZED (
        SELECT word, sum(k)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
        GROUP BY word HAVING length(word) >= 5 AND sum(k) >= 3
    ),
    places AS (SELECT word, n, unnest(range(length(word))) AS p FROM n),
    masked AS (SELECT word, n, p, substr(word, 1, p) || '_' || substr(word, p + 2) AS form FROM places),
    cut AS (SELECT DISTINCT word, n, substr(word, 1, p) || substr(word, p + 2) AS form FROM places),
    near AS MATERIALIZED (
        SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM masked a JOIN masked b ON a.p = b.p AND a.form = b.form AND a.word <> b.word
        UNION ALL SELECT cut.word, cut.n, n.word, n.n FROM cut JOIN n ON cut.form = n.word
        UNION ALL SELECT n.word, n.n, cut.word, cut.n FROM cut JOIN n ON cut.form = n.word
    ),
    best AS (SELECT word, count(*) AS n_near, arg_min((other, other_n), (-other_n, encode(other))) AS b FROM near GROUP BY word),
    forms AS MATERIALIZED (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b[2] >= 2 * n THEN b[1] END AS form, CASE WHEN b[2] >= 2 * n THEN b[2] END AS form_n FROM n LEFT JOIN best USING (word)
    ),
    walk AS (SELECT word, word AS root FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NOT NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT walk.word, root FROM walk JOIN forms ON walk.root = forms.word WHERE forms.form IS NULL) USING (word)
"""

TRIE = f"""
    WITH crc AS MATERIALIZED ({CRC_TABLE}),
    own AS MATERIALIZED (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, unhex(md5(strlen(role) || ':' || role || text))) AS p, role, text
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
    ),
    convs AS (SELECT conv_id, {crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own), crc),
    again AS (
        SELECT c.conv_id, 0 AS tail, own.p, role, text FROM convs c JOIN own ON own.conv_id = c.conv_id - c.conv_id % 5 AND own.p <= h
        UNION ALL SELECT c.conv_id, 1, own.p, role, text FROM convs c JOIN own ON own.conv_id = c.conv_id AND own.p > h
    ),
    placed AS (SELECT conv_id, row_number() OVER w AS depth, md5(strlen(role) || ':' || role || text) AS t, strlen(text) AS size FROM again WINDOW w AS (PARTITION BY conv_id ORDER BY tail, p)),
    prefixes AS MATERIALIZED (
        SELECT conv_id, depth, size, string_agg(t, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM placed
        UNION ALL SELECT conv_id, 0, 0, '' FROM convs
    ),
    ends AS (
        SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path
    ),
    nodes AS MATERIALIZED (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(size) AS saved FROM prefixes GROUP BY path, depth),
    children AS (SELECT path[:-33] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
    full_nodes AS MATERIALIZED (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
    sums AS (
        SELECT a.path, count(*) FILTER (d.n_children = 0) AS n_leaves, sum(d.saved)::BIGINT AS saved_tokens
        FROM (SELECT path, depth, n_children, saved, unnest(range(depth + 1)) AS up FROM full_nodes) d JOIN nodes a ON a.path = left(d.path, 32 * d.up) GROUP BY a.path
    )
    SELECT f.conv_id, f.depth, parent.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM full_nodes f JOIN sums USING (path) LEFT JOIN ends USING (path) LEFT JOIN nodes parent ON f.depth > 0 AND parent.path = left(f.path, 32 * (f.depth - 1))
"""
