"""DuckDB SQL of the queries that SQL can express."""

CHAT = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker,
           replace(replace(coalesce(text, ''), '<|im_start|>', '<||im_start||>'), '<|im_end|>', '<||im_end||>') AS body
    FROM conversations
), people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
shown AS (
    SELECT s.conv_id, perspective, turn, speaker, body,
           CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS rendered_as,
           CASE WHEN speaker = 'system' THEN '<|im_start|>system' WHEN speaker = perspective THEN '<|im_start|>assistant'
                ELSE '<|im_start|>user name=' || speaker END || chr(10) AS head
    FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), told AS (
    SELECT *, head || body || '<|im_end|>' || chr(10) AS segment,
           row_number() OVER w - 1 AS position,
           sum(length(head || body) + 11) OVER w AS stop
    FROM shown WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, body
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, perspective, position, turn, speaker, rendered_as, segment,
       CAST(stop - length(segment) AS BIGINT) AS start, CAST(stop AS BIGINT) AS "end",
       CAST(CASE WHEN rendered_as = 'assistant' THEN stop - length(segment) + length(head) ELSE stop END AS BIGINT) AS train_start,
       CAST(CASE WHEN rendered_as = 'assistant' THEN stop - 1 ELSE stop END AS BIGINT) AS train_end
FROM told
"""

# One row per shard number and landing: the generator's states modulo 2^64, until the key lands beyond the last shard.
SHARDS = """
WITH RECURSIVE jumps AS (
    SELECT DISTINCT doc_id, CAST(coalesce(doc_id, 0) AS HUGEINT) AS state, CAST(0 AS BIGINT) AS land, 0 AS step FROM documents
    UNION ALL
    SELECT doc_id, state, CAST(floor((land + 1) * (2147483648.0::DOUBLE / ((state >> 33) + 1)::DOUBLE)) AS BIGINT), step + 1 FROM (
        SELECT doc_id, land, step, (state * 2862933555777941757 + 1) % 18446744073709551616 AS state FROM jumps WHERE land < 41
    )
) SELECT doc_id, max(land) FILTER (land < 40) AS shard, max(land) FILTER (land < 41) AS grown_shard FROM jumps GROUP BY doc_id
"""

DUPLICATES = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), shingled AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
    FROM worded
), sized AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY 1),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingled a JOIN shingled b USING (shingle) GROUP BY 1, 2
), linked AS (
    SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
    WHERE 100 * common >= 75 * (x.n + y.n - common)
), reached AS (
    SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a
), smallest AS (SELECT a, min(b) AS least FROM reached GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, d.doc_id) AS component_id,
       coalesce(least, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN smallest ON a = d.doc_id
"""

# A checksum bit by bit; a tree per source and one over the sources, each level a list.
MERKLE = """
WITH RECURSIVE rows AS (
    SELECT doc_id, source, CASE WHEN crc % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown,
           concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'), coalesce(strlen(source) || ':' || source, '-'),
                  coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS head, text
    FROM (SELECT *, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
        list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ord(CAST(doc_id AS VARCHAR)[i]) AS BIGINT))),
        lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: CAST(0 AS BIGINT))),
            lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) AS crc FROM documents)
), leaves AS (
    SELECT doc_id, source, sha256(concat(head, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
           sha256(concat(head, coalesce(strlen(shown) || ':' || shown, '-'))) AS other FROM rows
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), tree AS (
    SELECT source, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY source
    UNION ALL
    SELECT source, level + 1, list_transform(range(0, (len(nodes) + 15) // 16), lambda i: sha256(array_to_string(nodes[i * 16 + 1 : i * 16 + 16], '')))
    FROM tree WHERE len(nodes) > 1
), subroots AS (
    SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS nth FROM tree WHERE len(nodes) = 1
), top AS (
    SELECT 0 AS level, list(subroot ORDER BY nth) AS nodes FROM subroots HAVING count(*) > 0
    UNION ALL
    SELECT level + 1, list_transform(range(0, (len(nodes) + 15) // 16), lambda i: sha256(array_to_string(nodes[i * 16 + 1 : i * 16 + 16], '')))
    FROM top WHERE len(nodes) > 1
), steps AS (
    SELECT p.doc_id, p.leaf, p.other, p.source, p.pos, 0 AS tree, level, nodes, p.pos >> (4 * level) AS spot
    FROM placed p JOIN tree t ON p.source IS NOT DISTINCT FROM t.source
    UNION ALL
    SELECT p.doc_id, p.leaf, p.other, p.source, p.pos, 1, level, nodes, nth >> (4 * level)
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN top
), told AS (
    SELECT doc_id, leaf, other, source, pos, list({'l': array_to_string(nodes[spot - spot % 16 + 1 : spot], ''),
        'r': array_to_string(nodes[spot + 2 : spot - spot % 16 + 16], '')} ORDER BY tree, level) FILTER (len(nodes) > 1) AS path
    FROM steps GROUP BY ALL
)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(coalesce(path, []), lambda s: s.l || s.r), '')) AS proof_sha256,
       list_reduce(list_concat([{'l': other, 'r': ''}], coalesce(path, [])), lambda x, y: {'l': sha256(y.l || x.l || y.r), 'r': ''}).l AS folded_root,
       folded_root = root AS verified
FROM told t JOIN subroots s ON t.source IS NOT DISTINCT FROM s.source CROSS JOIN (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1)
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces
), spread AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded
), started AS (SELECT lang, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3 FROM spread),
ones AS (SELECT lang, w1, count(*) AS f FROM started GROUP BY ALL),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM started WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM started WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM ones GROUP BY lang),
cuts AS (
    SELECT p.lang, concat(p.w1, ' ', p.w2) AS phrase, p.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM twos p JOIN ones x ON x.lang = p.lang AND x.w1 = p.w1 JOIN ones y ON y.lang = p.lang AND y.w1 = p.w2
    WHERE NOT EXISTS (SELECT 1 FROM threes t WHERE t.lang = p.lang AND t.w1 = p.w1 AND t.w2 = p.w2 AND 100 * t.f >= 50 * p.f)
      AND NOT EXISTS (SELECT 1 FROM threes t WHERE t.lang = p.lang AND t.w2 = p.w1 AND t.w3 = p.w2 AND 100 * t.f >= 50 * p.f)
    UNION ALL
    SELECT p.lang, concat(p.w1, ' ', p.w2, ' ', p.w3), p.f, 1, x.f, y.f
    FROM threes p JOIN ones x ON x.lang = p.lang AND x.w1 = p.w1 JOIN twos y ON y.lang = p.lang AND y.w1 = p.w2 AND y.w2 = p.w3
    UNION ALL
    SELECT p.lang, concat(p.w1, ' ', p.w2, ' ', p.w3), p.f, 2, x.f, y.f
    FROM threes p JOIN twos x ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2 JOIN ones y ON y.lang = p.lang AND y.w1 = p.w3
), scored AS (
    SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY 1000000::HUGEINT * a * a // (l::HUGEINT * r), k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored JOIN totals USING (lang) QUALIFY rank <= 2000
"""

VECTORS = """
WITH RECURSIVE fit AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reached r JOIN linked l ON r.b = l.a
), smallest AS (SELECT a, min(b) AS least FROM reached GROUP BY 1), counted AS (SELECT a, count(*) AS n FROM linked GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(s.least, vec_id)) AS component_id,
       vec_id <= coalesce(s.least, vec_id) AS kept
FROM embeddings LEFT JOIN smallest s ON s.a = vec_id LEFT JOIN counted c ON c.a = vec_id
"""
