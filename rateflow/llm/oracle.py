"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP2 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

# Base32 of a hex digest: every 5 bits of its 160 as one digit.
OP3 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT DISTINCT hex, array_to_string(list_transform(string_split(hex, ''),
         lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS b FROM p),
digits AS (SELECT hex, array_to_string(list_transform(range(0, 32),
           lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                            1 + list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr(b, 5 * i + j + 1, 1) = '1' THEN 16 >> j ELSE 0 END))::INT, 1)), '') AS payload_digest
           FROM bits),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM f JOIN digits USING (hex)
"""

OP8 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS t FROM (SELECT *, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
f AS (SELECT t, min(doc_id) AS first FROM win GROUP BY t HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM win JOIN f USING (t) WHERE first < doc_id),
lists AS (SELECT doc_id, count(*) AS n, map_from_entries(list((p, true))) AS ps FROM gone GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE [x[1] FOR x IN list_zip(w, range(1, len(w) + 1)) IF NOT coalesce(ps[x[2]], false)] END, ' ')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)
"""

# crc32 of a decimal id, bit by bit; a node is the hash of the sequence of turns that leads to it.
OP11 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'id': id, 'words': len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))} ORDER BY turn NULLS FIRST, id) AS turns
        FROM t GROUP BY 1),
crc AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ord(ch)::BIGINT)),
                  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                           lambda c, z: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT) % 4 AS h FROM own),
full_ AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
          FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
pre AS (SELECT conv_id, d, len(turns) AS n, CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words,
               md5(array_to_string(list_transform(turns[1:d], lambda z: z.id), ',')) AS node,
               CASE WHEN d > 0 THEN md5(array_to_string(list_transform(turns[1:d - 1], lambda z: z.id), ',')) END AS parent
        FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM full_)),
nodes AS (SELECT node, parent, d, words, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends FROM pre GROUP BY 1, 2, 3, 4),
kids AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY 1),
below AS (SELECT p.node, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((u.n_convs - 1) * u.words) AS saved
          FROM nodes u JOIN pre p ON p.conv_id = u.conv_id AND p.d <= u.d LEFT JOIN kids k ON k.parent = u.node GROUP BY 1)
SELECT v.conv_id, v.d AS depth, q.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN below USING (node) LEFT JOIN nodes q ON q.node = v.parent LEFT JOIN kids k ON k.parent = v.node
"""

OP12 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 3], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
links AS (SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2) p
          JOIN sizes a ON a.doc_id = p.x JOIN sizes b ON b.doc_id = p.y WHERE 100 * c >= 80 * (a.n + b.n - c)),
reached AS (SELECT doc_id AS node, doc_id AS least FROM d UNION SELECT y, least FROM reached JOIN links ON x = node),
component AS (SELECT node, min(least) AS component_id FROM reached GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN component ON node = d.doc_id LEFT JOIN sizes USING (doc_id)
"""

OP13 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256(concat('1:', doc_id::VARCHAR)) AS hex FROM documents),
h AS (SELECT *, ('0x' || substr(hex, 1, 8))::BIGINT AS h1, ('0x' || substr(hex, 9, 8))::BIGINT AS h2,
             ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
cut AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM cut
"""

ORACLE_SQL = {
    "op11_conversation_trie": OP11,
    "op12_minhash_dedup": OP12,
    "op13_fill_in_middle": OP13,
    "op2_topk_search": OP2,
    "op3_warc": OP3,
    "op8_substring_dedup": OP8,
    "op4_decontaminate": OP4,
}
