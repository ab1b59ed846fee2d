"""SQL that another engine runs over the same tables, by query name."""

from __future__ import annotations

from viewtally.llm.secrets import MIN_ASSIGNED, REACH, WORD_SIZE

SQL: dict[str, str] = {}

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _item_windows(width: int) -> str:
    """Windows of each size up to ``width`` as one text, of items and of documents."""
    parts = []
    for n in range(1, width + 1):
        own = f"n_words = {n}" if n < width else f"n_words >= {n}"
        parts.append(f"""
            SELECT {n} AS size, d.doc_id, d.pos, i.item_id
            FROM (SELECT doc_id, pos, string_agg(w, ' ') OVER win AS t, count(*) OVER win AS c FROM doc_words
                  WINDOW win AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)) d
            JOIN (SELECT item_id, string_agg(w, ' ') OVER win AS t, count(*) OVER win AS c FROM item_words WHERE {own}
                  WINDOW win AS (PARTITION BY item_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)) i
              ON d.t = i.t AND d.c = {n} AND i.c = {n}""")
    return " UNION ALL ".join(parts)


def _word_table(table: str, key: str) -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        SELECT {key}, len(ws) AS n_words, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
        FROM (SELECT {key}, regexp_extract_all({lower}, '{_WORDS}') AS ws FROM {table} WHERE text IS NOT NULL)"""


SQL["op3_decontamination"] = f"""
    WITH doc_words AS ({_word_table("documents", "doc_id")}),
    item_words AS ({_word_table("benchmark", "item_id")}),
    hits AS MATERIALIZED ({_item_windows(10)}),
    hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY doc_id),
    hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id),
    sizes AS (SELECT doc_id, count(*) AS n_words FROM doc_words GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = {
    "assign": (_ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= {MIN_ASSIGNED}"),
    "access": ("AKIA[A-Z0-9]+", "length(m) >= 16"),
    "hex": ("[0-9a-f]+", "length(m) >= 32"),
    "weak_secret": (
        "[A-Za-z0-9/+]+",
        f"length(m) = {WORD_SIZE} AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')",
    ),
    "endpoint": ("https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/?=&%-]*)?", "true"),
}


def _spans(number: int, kind: str, pattern: str, keep: str) -> str:
    return f"""
        SELECT doc_id, {number} AS kind, '{kind}' AS name, start, start + length(m) AS stop FROM (
            SELECT doc_id, m, sum(length(gap)) OVER win + coalesce(sum(length(m)) OVER (PARTITION BY doc_id ORDER BY i
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM (SELECT doc_id, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap, generate_subscripts(ms, 1) AS i
                  FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms,
                               regexp_split_to_array(text, '{pattern}') AS gaps FROM documents WHERE text IS NOT NULL))
            WINDOW win AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING))
        WHERE {keep}"""


SQL["op9_secrets"] = f"""
    WITH found AS MATERIALIZED ({" UNION ALL ".join(_spans(i, k, *v) for i, (k, v) in enumerate(_KINDS.items()))}),
    base AS (SELECT * FROM found WHERE kind < 3),
    weak AS (SELECT x.* FROM found x WHERE kind >= 3
        AND EXISTS (SELECT 1 FROM base p WHERE p.doc_id = x.doc_id AND p.kind < 2 AND (p.kind = 1 OR x.kind = 4)
                    AND greatest(p.start - x.stop, x.start - p.stop) <= {REACH})
        AND NOT EXISTS (SELECT 1 FROM base p WHERE p.doc_id = x.doc_id AND p.start < x.stop AND x.start < p.stop)),
    every AS (SELECT * FROM base UNION ALL SELECT * FROM weak),
    told AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
                    count(*) FILTER (kind = 2) AS n_hex,
                    string_agg(name || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS b,
                    string_agg(name || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind, stop) AS spans
             FROM every GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents d LEFT JOIN told USING (doc_id)
"""


def _placement() -> str:
    from viewtally.llm.queries import SHARD_NAMES
    from viewtally.llm.sharding import SLOTS, lookup_table

    table = ",".join(map(str, lookup_table(SHARD_NAMES)))
    slot = f"('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SLOTS}"
    return f"""
        WITH slots AS (SELECT unnest(string_split('{table}', ',')) AS number, unnest(range({SLOTS})) AS slot)
        SELECT doc_id, slot::INTEGER AS slot, 'shard-' || lpad(number, 3, '0') AS shard
        FROM (SELECT doc_id, {slot} AS slot FROM documents) JOIN slots USING (slot)
    """


SQL["op5_sharding"] = _placement()

#: crc32 of a decimal number, its table made from the polynomial.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"""
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, b: xor(x >> 8, crc_table[(xor(x, b) & 255) + 1])), 4294967295)"""

SQL["op11_conversation_trie"] = f"""
    WITH said AS (
        SELECT conv_id, turn, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS token,
               strlen(coalesce(text, '')) AS bytes
        FROM conversations WHERE conv_id IS NOT NULL),
    numbered AS (SELECT conv_id, token, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) - 1 AS pos FROM said),
    convs AS (SELECT conv_id, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM said), (SELECT {_CRC_TABLE} AS crc_table)),
    parts AS (
        SELECT c.conv_id, 0 AS part, pos, token, bytes FROM convs c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 5 AND pos < h
        UNION ALL
        SELECT c.conv_id, 1 AS part, pos, token, bytes FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND pos >= h),
    rebuilt AS (SELECT conv_id, row_number() OVER w AS depth, bytes, md5(string_agg(token, ',') OVER w) AS key
                FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
    members AS (SELECT *, coalesce(lag(key) OVER (PARTITION BY conv_id ORDER BY depth), '') AS above FROM rebuilt
                UNION ALL SELECT conv_id, 0 AS depth, 0 AS bytes, '' AS key, NULL AS above FROM convs),
    nodes AS (SELECT key, any_value(depth) AS depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes
              FROM members GROUP BY key),
    children AS (SELECT above AS key, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
    own AS (SELECT n.key, n.conv_id, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM nodes n LEFT JOIN children c USING (key)),
    below AS (
        SELECT m.key, sum(CASE WHEN m.conv_id = o.conv_id AND n_children = 0 THEN 1 ELSE 0 END) OVER w AS leaves,
               sum(CASE WHEN m.conv_id = o.conv_id THEN saved ELSE 0 END) OVER w AS saved
        FROM members m JOIN own o USING (key) WINDOW w AS (PARTITION BY m.conv_id ORDER BY m.depth DESC)),
    sums AS (SELECT key, sum(leaves)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY key),
    lengths AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id),
    ends AS (SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM members JOIN lengths USING (conv_id, depth) GROUP BY key)
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, o.n_children, n_leaves, saved_tokens,
           sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes n JOIN own o USING (key) JOIN sums USING (key) LEFT JOIN nodes p ON n.above = p.key LEFT JOIN ends e ON e.key = n.key
"""
