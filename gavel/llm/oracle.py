"""DuckDB SQL for the training-data queries that SQL can express (ids are taken to be distinct)."""

from gavel.llm.mixing import SLOTS

LINE_DEDUP = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM split),
counted AS (SELECT *, len(regexp_extract_all(line, '[^\x09-\x0D\x20]+')) AS words, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k FROM lines WHERE NOT regexp_full_match(line, '[\x09-\x0D\x20]*')),
ahead AS (SELECT doc_id, k, words, line, lead(words, 1) OVER w AS w1, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2 FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
sized AS (SELECT *, CASE WHEN words >= 50 THEN 1 WHEN words + w1 >= 50 THEN 2 ELSE 3 END AS m FROM ahead),
wide AS (SELECT doc_id, k, m, CASE m WHEN 1 THEN line WHEN 2 THEN line || chr(10) || l1 ELSE line || chr(10) || l1 || chr(10) || l2 END AS content FROM sized),
first AS (SELECT doc_id, k, m, first_value(doc_id) OVER f AS fd, first_value(k) OVER f AS fk FROM wide WHERE content IS NOT NULL WINDOW f AS (PARTITION BY content ORDER BY doc_id, k)),
gone AS (SELECT DISTINCT doc_id, unnest(range(CASE WHEN doc_id = fd THEN greatest(k, fk + m) ELSE k END, k + m)) AS k FROM first WHERE NOT (doc_id = fd AND k = fk)),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE last IS NULL OR last < k - 1) AS n_runs FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS last FROM gone) GROUP BY 1),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text FROM lines l LEFT JOIN counted c USING (doc_id, i) LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.k = c.k WHERE g.k IS NULL GROUP BY 1)
SELECT d.doc_id, (SELECT count(*) FROM counted c WHERE c.doc_id = d.doc_id) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[p : p + n - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS p FROM b)),
cut AS (SELECT doc_id, ws, l.n, unnest(range(1, len(ws) - l.n + 2)) AS p FROM w, (SELECT DISTINCT n FROM win) l WHERE len(ws) >= l.n),
occ AS (SELECT doc_id, p, n, phrase FROM (SELECT doc_id, p, n, array_to_string(ws[p : p + n - 1], ' ') AS phrase FROM cut) WHERE (n, phrase) IN (SELECT (n, phrase) FROM win)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY 1),
own AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM occ JOIN win USING (n, phrase) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN own USING (doc_id)
"""

MIXING = rf"""
WITH sized AS (SELECT doc_id, source, size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest) AS o FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5(coalesce(text, '')) AS digest FROM documents)),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS words, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS src FROM sized GROUP BY source),
f AS (SELECT *, [3.0, 1.0, 2.0][CAST(src % 3 + 1 AS INT)]::DOUBLE AS w, 2.0::DOUBLE * words AS cap, 1.5::DOUBLE * sum(words) OVER () AS budget FROM s),
g AS (SELECT *, cap / w AS ratio FROM f),
h AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY ratio, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY ratio, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS try FROM g),
t AS (SELECT src, source, words, least(cap, coalesce((SELECT min_by(try, (ratio, src)) FROM h WHERE try <= ratio) * w, cap)) AS target FROM h),
n AS (SELECT CAST(pow(2, ceil(log2(greatest(1, least({SLOTS}, floor(1.5 * sum(words))))))) AS BIGINT) AS slots, 1.5::DOUBLE * sum(words) AS total FROM t),
edges AS (SELECT src, sum(target) OVER (ORDER BY src) / sum(target) OVER () AS high FROM t),
points AS (SELECT slot, list_sum(list_transform(range(0, CAST(log2(slots) AS BIGINT)), lambda k: ((slot >> k) & 1) * (slots >> (k + 1)))) / slots::DOUBLE AS point FROM (SELECT unnest(range(slots)) AS slot, slots FROM n)),
named AS (SELECT slot, least((SELECT count(*) FROM edges WHERE high <= point), (SELECT count(*) - 1 FROM edges)) AS src FROM points),
plan AS (SELECT src, words, CAST(greatest(1, round(words / greatest(1e-9, total / slots))) AS BIGINT) AS blocks FROM t, n),
times AS (SELECT src, (rank % blocks) AS block, least(count(*), 2) AS times, any_value(words) AS words, any_value(blocks) AS blocks FROM (SELECT src, row_number() OVER (PARTITION BY src ORDER BY slot) - 1 AS rank FROM named) JOIN plan USING (src) GROUP BY 1, 2),
taken AS (SELECT src, times, block::HUGEINT * words // blocks AS lo, (block + 1)::HUGEINT * words // blocks AS hi FROM times),
laid AS (SELECT d.doc_id, d.source, d.size, t.src, t.words AS source_size, t.target, CAST(sum(d.size) OVER (PARTITION BY t.src ORDER BY o, doc_id ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
got AS (SELECT doc_id, sum((least(hi, start + size) - greatest(lo, start)) * times) AS taken FROM laid JOIN taken ON laid.src = taken.src AND lo < start + size AND hi > start GROUP BY 1)
SELECT doc_id, source, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM laid LEFT JOIN got USING (doc_id)
"""

NEAR = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s FROM w),
n AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN sh USING (doc_id) GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
SELECT n.doc_id, n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN least ON x = n.doc_id
"""

# the checksum goes byte by byte through the table that the reversed polynomial gives; sums and quotients are exact
SHARDING = r"""
WITH poly AS (SELECT list(CAST(list_reduce(list_prepend(CAST(b AS UBIGINT), CAST(range(8) AS UBIGINT[])), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS UBIGINT) ORDER BY b) AS tab FROM range(256) t(b)),
bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
cut AS (SELECT doc_id, len(h) // 2 + 8 AS size, list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS UBIGINT)) AS bs FROM bytes),
summed AS (SELECT doc_id, size, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), bs), lambda c, b: xor(c >> 8, tab[CAST(xor(c, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) AS BIGINT) AS text_crc32 FROM cut, poly),
laid AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS earlier, sum(size) OVER () AS every FROM summed),
placed AS (SELECT *, CAST(least(23, (2 * earlier + size) * 24 // (2 * every)) AS INTEGER) AS shard FROM laid)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM placed
"""

# two hexadecimal digits a byte, so that strings are cut at bytes; pieces that overlap spare walking long texts
REPEATS = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT doc_id, o, substr(h, 2 * o + 1, 2398) AS g FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199, 1000)) AS o FROM d WHERE len(h) >= 400)),
starts AS (SELECT doc_id, o + q AS p, md5_number(substr(g, 2 * q + 1, 400)) AS k FROM (SELECT doc_id, o, g, unnest(range(len(g) // 2 - 199)) AS q FROM pieces)),
again AS (SELECT doc_id, p FROM starts WHERE k IN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1)),
edges AS (SELECT *, coalesce(p > lag(p) OVER w + 200, true) AS opens FROM again WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
runs AS (SELECT doc_id, min(p) AS lo, max(p) + 200 AS hi FROM (SELECT *, count(*) FILTER (WHERE opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM edges) GROUP BY doc_id, run),
gaps AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS last FROM runs),
gone AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * last + 1, 2 * (lo - last)), '' ORDER BY lo) AS kept, max(hi) AS hi FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept || substr(h, 2 * hi + 1), h))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""



def _trie(start: str, name: str, levels: int) -> str:
    """CTEs {name}0 ... (g, r, d, c) of the nodes of a trie over start (g, r, d, c: group, rank, digest, nodes of the group), and {name}p (g, r, top, path) from each leaf to the top."""
    out = [f"{name}0 AS (SELECT g, r, d, c FROM {start})", f"{name}f0 AS (SELECT g, r, r AS q, [] :: STRUCT(l VARCHAR, r VARCHAR)[] AS path FROM {start})"]
    for k in range(levels):
        up = f"SELECT g, r // 8 AS r, CASE WHEN any_value(c) > 1 THEN sha256(string_agg(d, '' ORDER BY r)) ELSE any_value(d) END AS d, any_value((c + 7) // 8) AS c FROM {name}{k} GROUP BY g, r // 8"
        run = f"SELECT g, r, c, coalesce(string_agg(d, '') OVER (PARTITION BY g, r // 8 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lt, coalesce(string_agg(d, '') OVER (PARTITION BY g, r // 8 ORDER BY r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rt FROM {name}{k}"
        out += [f"{name}{k + 1} AS ({up})", f"{name}f{k + 1} AS (SELECT f.g, f.r, q // 8 AS q, CASE WHEN c > 1 THEN list_append(path, {{'l': lt, 'r': rt}}) ELSE path END AS path FROM {name}f{k} f JOIN ({run}) s ON s.g = f.g AND s.r = f.q)"]
    return ",\n".join([*out, f"{name}p AS (SELECT f.g, f.r, t.d AS top, path FROM {name}f{levels} f JOIN {name}{levels} t USING (g))"])


def _bytes(field: str) -> str:
    return f"coalesce(strlen(CAST({field} AS VARCHAR)) || ':' || {field}, '-')"


# eight levels: sixteen million documents a language
_FIELDS = [_bytes(f) for f in ("doc_id", "source", "lang", "n_chars")]
MANIFEST = f"""
WITH poly AS (SELECT list(CAST(list_reduce(list_prepend(CAST(b AS UBIGINT), CAST(range(8) AS UBIGINT[])), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) AS UBIGINT) ORDER BY b) AS tab FROM range(256) t(b)),
ids AS (SELECT DISTINCT doc_id AS id, list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS UBIGINT)) AS bs FROM documents WHERE doc_id IS NOT NULL),
sums AS (SELECT id, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), bs), lambda c, b: xor(c >> 8, tab[CAST(xor(c, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) % 3 = 0 AS hit FROM ids, poly),
own AS (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256(concat({", ".join(_FIELDS)}, {_bytes("text")})) AS leaf, CASE WHEN hit THEN sha256(concat({", ".join(_FIELDS)}, {_bytes("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})) END AS presented FROM documents LEFT JOIN sums ON id = doc_id),
leaves AS (SELECT *, leaf AS d, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS c FROM own),
{_trie("leaves", "a", 8)},
langs AS (SELECT DISTINCT '' AS g, ap.g AS lang, top AS d, dense_rank() OVER (ORDER BY encode(ap.g)) - 1 AS r, (SELECT count(DISTINCT g) FROM own) AS c FROM ap),
{_trie("langs", "b", 8)},
whole AS (SELECT l.doc_id, leaf, presented, ap.top AS subroot, bp.top AS root, list_concat(ap.path, bp.path) AS path FROM leaves l JOIN ap ON ap.g = l.g AND ap.r = l.r JOIN langs ON langs.lang = l.g JOIN bp ON bp.r = langs.r),
folded AS (SELECT *, list_reduce(list_prepend({{'l': coalesce(presented, leaf), 'r': ''}}, path), lambda x, y: {{'l': sha256(concat(y.l, x.l, y.r)), 'r': ''}}).l AS folded_root FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""



def _rounds(rounds: int) -> str:
    """CTEs a0 ... (i, p, v, e, d: nearest entry and distance) and c0 ... (p, e, v) in turn."""
    out = []
    for k in range(rounds + 1):
        out.append(f"a{k} AS MATERIALIZED (SELECT i, p, v, m % 16 AS e, m // 16 AS d FROM (SELECT x.i, x.p, any_value(x.v) AS v, min(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 16 + c.e) AS m FROM parts x JOIN c{k} c ON c.p = x.p GROUP BY x.i, x.p))")
        sums = f"SELECT p, e, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS j FROM a{k}) GROUP BY p, e, j"
        out.append(f"c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(f.v, c.v) AS v FROM c{k} c LEFT JOIN (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM ({sums}) GROUP BY p, e) f ON f.p = c.p AND f.e = c.e)")
    return ",\n".join(out[:-1])


CODES = f"""
WITH kept AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS i, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT i, p, ints[p * (len(ints) // 8) + 1 : (p + 1) * (len(ints) // 8)] AS v FROM kept, range(8) t(p)),
c0 AS (SELECT p, i AS e, v FROM parts WHERE i < 16),
{_rounds(6)},
coded AS (SELECT i, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY i),
flat AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (i), flat
"""

NEAR_VECTORS = """
WITH RECURSIVE good AS (SELECT *, row_number() OVER () AS i, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)),
links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.i <> b.i AND len(a.v) = len(b.v) AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.x = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN least ON least.x = vec_id
"""

# every vector is compared, as the index does in tables of up to two thousand vectors; sums go component after component
NEIGHBOURS = """
WITH good AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id, embedding) AS row, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
asked AS (SELECT * FROM good WHERE vec_id % 100 = 0 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY v, row) = 1),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id, b.row, sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), lambda s, x: s + x)) AS score FROM asked a JOIN good b ON a.row <> b.row)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id, row) AS INTEGER) AS rank, vec_id, score FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id, row) <= 10
"""

ORACLE = {"op2_line_dedup": LINE_DEDUP, "op3_sharding": SHARDING, "op4_repeats": REPEATS, "op5_decontamination": DECONTAMINATION, "op6_near_duplicates": NEAR, "op7_mixing": MIXING, "op8_neighbours": NEIGHBOURS, "op11_manifest": MANIFEST, "op12_codes": CODES, "op13_near_vectors": NEAR_VECTORS}
