"""DuckDB statements with the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

from cellsift.llm import embeddings, mixing, sharding

#: Sixty bits of a hash of id and text, as both operators on hash prefixes use them.
_PLACE = "CAST('0x' || left(md5({prefix}coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 15) AS BIGINT)"

EMBEDDINGS = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= {embeddings.COSINE}),
reach(id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other),
roots AS (SELECT id, min(other) AS root FROM reach GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, r.root AS component_id, e.vec_id = r.root AS kept
FROM embeddings e JOIN roots r ON r.id = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""

#: The least depth at which a row's bucket fits; ids are unique, so no row needs a further part.
SHARDS = f"""
WITH rows AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, {_PLACE.format(prefix="")} AS h FROM documents),
levels AS (
    SELECT r.*, CAST(d AS INTEGER) AS depth, h >> CAST({sharding.HASH_BITS} - d AS BIGINT) AS bucket
    FROM rows r, range({sharding.HASH_BITS} + 1) t(d)),
sums AS (
    SELECT depth, bucket, sum(n_bytes) AS b, count(*) AS n FROM levels GROUP BY depth, bucket
    HAVING sum(n_bytes) <= {sharding.SHARD_BYTES} OR min(h) = max(h)),
fits AS (
    SELECT l.*, CAST(b AS BIGINT) AS shard_bytes, n AS shard_docs FROM levels l JOIN sums USING (depth, bucket)
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1)
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(bucket), depth, '0') END AS shard, depth,
    CAST(0 AS BIGINT) AS part, shard_bytes, shard_docs
FROM fits
"""

MIXING = f"""
WITH rows AS (
    SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS src,
        CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens,
        {_PLACE.format(prefix=f"'{mixing.SEED}:' || ")} AS h
    FROM documents),
sources AS (SELECT src, CAST(sum(n_tokens) AS DOUBLE) AS t, count(*) AS n FROM rows GROUP BY src),
total AS (
    SELECT sum(t) AS s, max(t) AS most, min(t) AS least, CAST(count(*) AS DOUBLE) AS k, entropy FROM sources,
        (SELECT -sum(t / s * ln(t / s)) AS entropy FROM sources, (SELECT sum(t) AS s FROM sources) WHERE t > 0)
    WHERE t > 0 GROUP BY entropy),
grid AS (
    SELECT m / {1 << mixing.GRID_BITS}.0::DOUBLE AS a, sum(pow(t / most, m / {1 << mixing.GRID_BITS}.0::DOUBLE)) AS z,
        sum(pow(t / most, m / {1 << mixing.GRID_BITS}.0::DOUBLE) * ln(pow(t / most, m / {1 << mixing.GRID_BITS}.0::DOUBLE))) AS xl
    FROM sources, total, range({(1 << mixing.GRID_BITS) + 1}) g(m) WHERE t > 0 GROUP BY m),
chosen AS (
    SELECT coalesce(min(a), 1.0) AS a FROM grid, total
    WHERE ln(z) - xl / z <= entropy + 0.5 * (ln(k) - entropy) + 1e-12
      AND pow(most / least, 1 - a) * (s / most / z) <= 4.0 + 1e-9),
weights AS (
    SELECT src, t, n, CASE WHEN t > 0 THEN pow(t, a) / sum(CASE WHEN t > 0 THEN pow(t, a) END) OVER () ELSE 0 END AS weight
    FROM sources, chosen),
quotas AS (SELECT w.*, round(weight * s) AS quota FROM weights w, total),
plans AS (
    SELECT src, weight, CASE WHEN t > 0 THEN floor(quota / t) ELSE 1 END AS passes,
        CASE WHEN t > 0 THEN quota - floor(quota / t) * t ELSE 0 END AS rest,
        CAST(greatest(0, ceil(log2(n / {mixing.BLOCK_ROWS}.0))) AS BIGINT) AS bits
    FROM quotas),
running AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY src ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto FROM rows),
cuts AS (SELECT src, min(h) AS cut FROM running JOIN plans USING (src) WHERE upto > rest GROUP BY src),
copies AS (
    SELECT r.*, weight, h >> ({mixing.HASH_BITS} - bits) AS block,
        unnest(range(CAST(passes + CASE WHEN h < cut THEN 1 ELSE 0 END AS BIGINT))) AS epoch
    FROM rows r JOIN plans USING (src) LEFT JOIN cuts USING (src))
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, block, round(weight, 9) AS weight,
    lpad(CAST(epoch AS VARCHAR), 6, '0') || '-'
        || left(md5(concat_ws(':', '{mixing.SEED}', CAST(epoch AS VARCHAR), src, CAST(block AS VARCHAR))), 16) AS order_key
FROM copies
"""

LINES = """
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM rows),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (
    SELECT key, min(doc_id) AS least FROM keyed WHERE length(key) >= 10 GROUP BY key
    HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) > 1),
judged AS (SELECT k.*, f.key IS NOT NULL AND coalesce(doc_id <> least, least IS NOT NULL) AS gone FROM keyed k LEFT JOIN firsts f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r
"""

#: CRC-32 of a list of bytes, by the table of its 256 first steps.
_CRC_TABLE = """
crc AS (
    SELECT list(v ORDER BY i) AS steps FROM (
        SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))))
"""
_CRC = "xor(list_reduce(list_concat([4294967295], {bytes}), lambda c, x: xor(c >> 8, steps[xor(c & 255, x) + 1])), 4294967295)"

PREFIXES = f"""
WITH {_CRC_TABLE},
own AS (
    SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS t,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
    FROM conversations WHERE conv_id IS NOT NULL),
seqs AS (SELECT c, list(t ORDER BY i) AS s FROM own GROUP BY c),
shared AS (
    SELECT c, s, {_CRC.format(bytes="list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 6 AS h
    FROM seqs, crc),
whole AS (
    SELECT a.c, CASE WHEN b.c IS NULL THEN a.s[h + 1:] ELSE list_concat(b.s[1:h], a.s[h + 1:]) END AS s
    FROM shared a LEFT JOIN seqs b ON b.c = a.c - a.c % 100),
prefixes AS (SELECT c, len(s) AS n, d, s[1:d] AS k FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM whole)),
nodes AS (
    SELECT k, d, min(c) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
    FROM prefixes GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
weighed AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.d > 0 THEN (n_convs - 1) * length(n.k[n.d].t) ELSE 0 END AS saved
    FROM nodes n LEFT JOIN kids ON kids.d = n.d AND kids.k = n.k),
ups AS (SELECT k[1:u] AS k, u AS d, n_children, saved FROM (SELECT *, unnest(range(d + 1)) AS u FROM weighed)),
sums AS (
    SELECT k, d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM ups GROUP BY k, d)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM weighed w JOIN sums s ON s.d = w.d AND s.k = w.k LEFT JOIN nodes p ON p.d = w.d - 1 AND p.k = w.k[1:w.d - 1]
"""

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
coded AS (
    SELECT w, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS t, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x
    FROM runs WHERE length(w) >= 6),
hashed AS (
    SELECT w, {_CRC.format(bytes="list_transform(range(strlen(t)), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))")} AS h
    FROM coded, crc),
slipped AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w FROM hashed),
words AS (SELECT w, count(*) AS n FROM slipped WHERE length(w) >= 6 GROUP BY w HAVING count(*) >= 5),
cuts AS (
    SELECT w, i, substr(w, 1, i - 1) || substr(w, i + 1) AS v FROM (SELECT w, unnest(range(1, length(w) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.w AS w, b.w AS o FROM cuts a JOIN cuts b ON a.i = b.i AND a.v = b.v AND a.w <> b.w
    UNION SELECT c.w, s.w FROM cuts c JOIN words s ON c.v = s.w
    UNION SELECT s.w, c.w FROM cuts c JOIN words s ON c.v = s.w),
near AS (
    SELECT p.w, count(*) AS n_near, arg_min(o.w, struct_pack(less := -o.n, o := o.w)) AS best, max(o.n) AS best_n
    FROM pairs p JOIN words o ON o.w = p.o GROUP BY p.w),
forms AS (
    SELECT w.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
        CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
    FROM words w LEFT JOIN near USING (w)),
ways(w, root) AS (SELECT w, w FROM forms UNION SELECT x.w, f.form FROM ways x JOIN forms f ON f.w = x.root WHERE f.form IS NOT NULL)
SELECT f.w AS word, f.form, x.root, f.n, f.n_near, f.form_n
FROM forms f JOIN ways x ON x.w = f.w JOIN forms r ON r.w = x.root WHERE r.form IS NULL
"""


def statements() -> dict[str, str]:
    """Learned, voted and iterated operators are no SQL; nor are spans scored by their context."""
    return {
        "op2_embedding_near_dedup": EMBEDDINGS,
        "op3_sharding": SHARDS,
        "op8_mixing": MIXING,
        "op11_spelling_variants": SPELLING,
        "op12_line_dedup": LINES,
        "op13_conversation_prefix_trie": PREFIXES,
    }
