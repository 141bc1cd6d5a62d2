"""SQL of the queries that SQL can express.

Token ids, models and 64-bit hashes are beyond it: op4, op5, op6, op7, op9, op10 and op13 are
tested against brute force, exact round trips and held-out accuracy in tests/llm.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, '{pattern}')"


_LOW = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LLM_ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_words(_LOW, _ALPHANUMERIC)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words(_LOW, _ALPHANUMERIC)} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i+9], ' ') AS s
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
o AS (SELECT doc_id, i, n, array_to_string(w[i:i+n-1], ' ') AS s
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
h AS (SELECT o.doc_id, o.i, o.n, p.item FROM o JOIN p ON o.s = p.s AND o.n = p.n),
hit AS (SELECT doc_id, count(*) AS n_hit
        FROM (SELECT DISTINCT doc_id, i + j AS x FROM (SELECT DISTINCT doc_id, i, n FROM h), (SELECT unnest(range(0, 10)) AS j) WHERE j < n) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op2_warc_revisits": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
h AS (SELECT *, sha1(html) AS hex FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INTEGER), 5) AS BIGINT)
                        >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1) for k in range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h""",
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')", _SPACED)} AS w FROM documents),
o AS (SELECT doc_id, i, array_to_string(w[i:i+49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM o GROUP BY s),
x AS (SELECT DISTINCT o.doc_id, i + j AS at FROM o JOIN f USING (s), (SELECT unnest(range(0, 50)) AS j) WHERE first < o.doc_id),
e AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM d),
k AS (SELECT e.doc_id, count(x.at) AS gone, string_agg(CASE WHEN x.at IS NULL THEN word END, ' ' ORDER BY e.at) AS kept
      FROM e LEFT JOIN x ON x.doc_id = e.doc_id AND x.at = e.at GROUP BY e.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op8_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words(_LOW, _SPACED)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op11_fill_in_middle": """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
g AS (SELECT *, [CAST('0x' || substr(x, CAST(8 * i + 1 AS INTEGER), 8) AS BIGINT) for i in range(4)] AS h FROM h),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head, text, translate(text, '{_UPPER}', '{_LOWER}') AS low,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT) for i in range(1, strlen(CAST(doc_id AS VARCHAR)) + 1)]),
             lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 3 = 0 AS tampered FROM documents),
f AS (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS other FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n FROM f),
tree AS (SELECT lang, 0 AS level, rank AS pos, leaf AS hash, n FROM leaves
         UNION ALL SELECT lang, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM tree WHERE n > 1 GROUP BY lang, level, pos // 8, n),
tops AS (SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM tree WHERE n = 1),
upper AS (SELECT 0 AS level, rank AS pos, hash, n FROM tops
          UNION ALL SELECT level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM upper WHERE n > 1 GROUP BY level, pos // 8, n),
depth AS (SELECT lang, max(level) AS depth FROM tree GROUP BY lang),
nodes AS (SELECT lang, level, pos, hash FROM tree WHERE n > 1 UNION ALL SELECT t.lang, depth.depth + u.level, u.pos, u.hash FROM upper u, tops t, depth WHERE u.n > 1 AND depth.lang IS NOT DISTINCT FROM t.lang),
height AS (SELECT depth.lang, depth.depth, depth.depth + (SELECT max(level) FROM upper) AS height, tops.rank, tops.hash AS subroot FROM depth JOIN tops ON depth.lang IS NOT DISTINCT FROM tops.lang),
steps AS (SELECT l.doc_id, l.leaf, h.height, level, CASE WHEN level < h.depth THEN l.rank // CAST(8 ** level AS BIGINT) ELSE h.rank // CAST(8 ** (level - h.depth) AS BIGINT) END AS pos, l.lang
          FROM (SELECT doc_id, leaf, lang, rank FROM leaves) l JOIN height h ON l.lang IS NOT DISTINCT FROM h.lang, unnest(range(0, h.height)) AS r(level)),
runs AS (SELECT s.doc_id, s.leaf, s.level, coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (n.pos < s.pos), '') AS before, coalesce(string_agg(n.hash, '' ORDER BY n.pos) FILTER (n.pos > s.pos), '') AS behind
         FROM steps s JOIN nodes n ON n.lang IS NOT DISTINCT FROM s.lang AND n.level = s.level AND n.pos // 8 = s.pos // 8 GROUP BY s.doc_id, s.leaf, s.level, s.pos),
fold AS (SELECT doc_id, leaf, 0 AS level, CASE WHEN tampered THEN other ELSE leaf END AS hash FROM leaves
         UNION ALL SELECT doc_id, leaf, level + 1, sha256(before || hash || behind) FROM fold JOIN runs USING (doc_id, leaf, level)),
proof AS (SELECT doc_id, leaf, string_agg(before || behind, '' ORDER BY level) AS proof FROM runs GROUP BY doc_id, leaf),
root AS (SELECT hash AS root FROM upper WHERE n = 1)
SELECT l.doc_id, l.leaf, h.subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, fold.hash AS folded_root, fold.hash = root AS verified
FROM leaves l JOIN height h ON l.lang IS NOT DISTINCT FROM h.lang JOIN fold ON fold.doc_id = l.doc_id AND fold.leaf = l.leaf AND fold.level = h.height
     LEFT JOIN proof ON proof.doc_id = l.doc_id AND proof.leaf = l.leaf, root""",
}
