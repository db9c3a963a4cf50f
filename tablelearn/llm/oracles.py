"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others run models, tokenizers or hash-based sampling; they are tested against brute
force, exact round trips or held-out accuracy."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"

OP4 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) AS s FROM w WHERE len(words) >= 2
    UNION ALL SELECT doc_id, words[1] FROM w WHERE len(words) = 1)),
sizes AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN shingles ON w.doc_id = shingles.doc_id GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON reach.other = edges.x)
SELECT r.doc_id, any_value(sizes.n) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r JOIN sizes ON r.doc_id = sizes.doc_id GROUP BY r.doc_id
"""

OP6 = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, (s.key IS NOT NULL AND s.holder <> k.doc_id) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Every pair that one of the two rules holds for is retrieved by the passage search. Rule 0 takes
# words as they stand, rule 1 without signs at their ends.
_BARE = (
    "list_filter(list_transform({w}, lambda w: regexp_replace(w, "
    "'^[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+|[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+$', '', 'g')), lambda w: w <> '')"
)

OP8 = f"""
WITH items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
cuts AS (
  SELECT item_id, words, {_BARE.format(w="words")} AS bare,
         coalesce(list_max(list_filter(range(1, len(words)), lambda k: words[k][-1] IN ('.', '!', '?'))), greatest(1, 2 * len(words) // 3)) AS cut
  FROM items WHERE len(words) > 0),
sized AS (
  SELECT item_id, 0 AS rule, words, len(words) AS n, least(5, len(words)) AS width, cut, cut AS mark, 0 AS extra FROM cuts WHERE len(bare) > 0
  UNION ALL
  SELECT item_id, 1, bare, len(bare), least(5, len(bare)), cut, len({_BARE.format(w="words[1:cut]")}), 1 FROM cuts WHERE len(bare) > 0),
parts AS (
  SELECT item_id, rule, 'q' AS part, width, words[1:greatest(mark, width)] AS words FROM sized
  UNION ALL
  SELECT item_id, rule, 'a', width,
         words[CASE WHEN rule = 0 THEN least(mark, n - width) ELSE greatest(0, least(mark - width + 1, n - width - 4)) END + 1:] FROM sized),
runs AS (
  SELECT DISTINCT item_id, rule, part, width, unnest(list_transform(range(1, len(words) - width + 2), lambda k: array_to_string(words[k:k + width - 1], ' '))) AS run
  FROM parts),
texts AS (
  SELECT doc_id, 0 AS rule, {_WORDS} AS words FROM documents
  UNION ALL SELECT doc_id, 1, {_BARE.format(w=_WORDS)} FROM documents),
held AS (
  SELECT DISTINCT doc_id, texts.rule, width, unnest(list_transform(range(1, len(words) - width + 2), lambda k: array_to_string(words[k:k + width - 1], ' '))) AS run
  FROM texts JOIN (SELECT DISTINCT rule, width FROM sized) w ON texts.rule = w.rule),
totals AS (SELECT item_id, rule, part, count(*) AS n FROM runs GROUP BY 1, 2, 3),
found AS (
  SELECT doc_id, item_id, rule, part, count(*) AS n
  FROM runs JOIN held USING (run, width, rule) GROUP BY 1, 2, 3, 4),
shares AS (SELECT doc_id, item_id, rule, part, f.n / t.n AS share FROM found f JOIN totals t USING (item_id, rule, part)),
pairs AS (
  SELECT q.doc_id, q.item_id, q.rule, q.share AS question_overlap, a.share AS answer_overlap
  FROM shares q JOIN shares a ON q.doc_id = a.doc_id AND q.item_id = a.item_id AND q.rule = a.rule AND q.part = 'q' AND a.part = 'a'
  WHERE q.share >= 0.6 AND a.share >= 0.6)
SELECT doc_id, item_id, arg_min(question_overlap, rule) AS question_overlap, arg_min(answer_overlap, rule) AS answer_overlap
FROM pairs GROUP BY 1, 2
"""

def _seeded(what, *parts):
    text = " || ".join([f"'11:{what}'", *[f"':' || coalesce(CAST({p} AS VARCHAR), ' ')" for p in parts]])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


OP11 = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, 1 + rank % 3 AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM sources),
filled AS (
  SELECT *, total - (sum(cap) OVER up - cap) AS open_words, sum(weight) OVER () - (sum(weight) OVER up - weight) AS open_weight
  FROM weighed WINDOW up AS (ORDER BY cap / weight, rank)),
stopping AS (SELECT *, cap <= CAST(open_words AS DOUBLE) * weight / open_weight AS stopped FROM filled),
opened AS (
  SELECT *, total - coalesce(sum(cap) FILTER (WHERE stopped) OVER (), 0) AS rest, sum(weight) FILTER (WHERE NOT stopped) OVER () AS rest_weight
  FROM stopping),
targets AS (
  SELECT source, rank, source_size, total, CASE WHEN stopped THEN CAST(cap AS DOUBLE) ELSE CAST(rest AS DOUBLE) * weight / rest_weight END AS target
  FROM opened),
blocks AS (SELECT greatest(1, CAST(floor(sum(source_size) / 16 + 0.5) AS BIGINT)) AS n, count(*) AS parties FROM targets),
quotients AS (
  SELECT rank, target, unnest(range(1, CAST(floor(n * target / total) AS BIGINT) + parties + 3)) AS k FROM targets, blocks WHERE target > 0),
seats AS (
  SELECT rank, count(*) AS source_blocks
  FROM (SELECT rank, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, rank, k) AS place FROM quotients), blocks
  WHERE place <= n GROUP BY rank),
placed AS (
  SELECT d.*, t.rank, t.source_size, t.target, coalesce(s.source_blocks, 0) AS source_blocks,
         {_seeded("shard", "doc_id")} % CAST(greatest(1, ceil(t.source_size / 2000000)) AS BIGINT) AS shard
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN seats s ON s.rank = t.rank),
shards AS (
  SELECT rank, shard, CAST(sum(size) AS BIGINT) AS shard_size, max(source_blocks) AS source_blocks,
         sum(sum(size)) OVER (PARTITION BY rank) AS words, count(*) OVER (PARTITION BY rank) AS parties
  FROM placed GROUP BY rank, shard HAVING sum(size) > 0),
shard_quotients AS (
  SELECT rank, shard, shard_size, source_blocks,
         unnest(range(1, CAST(floor(source_blocks * shard_size / words) AS BIGINT) + parties + 3)) AS k FROM shards),
shard_seats AS (
  SELECT rank, shard, count(*) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY shard_size / (2 * k - 1) DESC, shard, k) AS place FROM shard_quotients)
  WHERE place <= source_blocks GROUP BY rank, shard),
runs AS (
  SELECT s.rank, s.shard, s.shard_size, least(coalesce(q.quota, 0) * 16, 3 * s.shard_size) AS run,
         {_seeded("start", "s.rank", "s.shard")} % s.shard_size AS start
  FROM shards s LEFT JOIN shard_seats q ON s.rank = q.rank AND s.shard = q.shard),
circle AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY rank, shard ORDER BY {_seeded("order", "doc_id")}, doc_id NULLS FIRST, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM placed WHERE size > 0)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(run // shard_size * size + greatest(0, least(begins + size, start + run % shard_size) - greatest(begins, start))
            + greatest(0, least(begins + size, start + run % shard_size - shard_size) - begins) AS BIGINT) AS taken
FROM circle JOIN runs USING (rank, shard)
UNION ALL SELECT doc_id, size, CAST(source_size AS BIGINT), target, 0 FROM placed WHERE size = 0
"""

def _vector_rounds(rounds):
    near = """near{r} AS MATERIALIZED (
  SELECT n, p, arg_min(e, (away, e)) AS e, min(away) AS away
  FROM (SELECT n, p, e, list_distance(parts.v, b.v) AS away FROM parts JOIN book{r} b USING (p)) GROUP BY n, p)"""
    book = """book{s} AS MATERIALIZED (
  SELECT p, e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY i) AS v FROM (
      SELECT p, e, i, floor(sum(x) / count(*)) AS mean
      FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM near{r} JOIN parts USING (n, p)) GROUP BY p, e, i)
    GROUP BY p, e) m USING (p, e))"""
    steps = [t.format(r=r, s=r + 1) for r in range(rounds) for t in (near, book)]
    return ",\n".join([*steps, near.format(r=rounds)])


# Square roots of different whole numbers below 2^50 differ, so distances order like their squares.
OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS n, vec_id, label,
         list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT n, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS v FROM kept, (SELECT unnest(range(4)) AS p)),
book0 AS (SELECT p, n - 1 AS e, v FROM parts WHERE n <= 256),
{_vector_rounds(4)},
codes AS (
  SELECT n, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(round(away * away)) AS BIGINT) AS error FROM near4 GROUP BY n),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM book4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN kept USING (n), digest
"""

ORACLE_SQL = {
    "op4_minhash_near_dedup": OP4,
    "op6_line_dedup": OP6,
    "op8_decontamination": OP8,
    "op11_source_mixing": OP11,
    "op12_vector_codes": OP12,
}
