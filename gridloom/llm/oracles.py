"""SQL of the operators that SQL can express."""

from __future__ import annotations

from gridloom.llm.quality import MARKS, QualityParams

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRINGS = rf"""
WITH docs AS (SELECT doc_id, {WORDS} AS ws FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS p, ws FROM docs WHERE len(ws) >= 20),
windows AS (SELECT doc_id, p, array_to_string(ws[p:p+19], ' ') AS k FROM starts),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM ranked WHERE n > 1),
placed AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM docs),
kept AS (SELECT p.doc_id, string_agg(w, ' ' ORDER BY i) AS text, count(*) AS n FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""


def quality_sql(p: QualityParams = QualityParams()) -> str:
    removed = lambda keep: f"length(regexp_replace(t, '[^{keep}]', '', 'g'))"
    js = lambda a, n, b, m: (
        f"sqrt(greatest(0, list_sum(list_transform(list_zip({a}, {b}), lambda z: "
        f"(CASE WHEN z[1] > 0 THEN z[1] / {n} * log2(2 * (z[1] / {n}) / (z[1] / {n} + z[2] / {m})) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] / {m} * log2(2 * (z[2] / {m}) / (z[1] / {n} + z[2] / {m})) ELSE 0 END) / 2))))"
    )
    sums = lambda c, n: ", ".join(f"sum({c}[{i}])" for i in range(1, n + 1))
    return rf"""
WITH docs AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
grams AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS p, ws FROM docs WHERE len(ws) >= 3),
again AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, ws[p], ws[p+1], ws[p+2]) AS n FROM grams),
repeats AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest([p, p+1, p+2]) AS i FROM again WHERE n > 1) GROUP BY 1),
lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
  list_filter(list_transform(ws, lambda w: rtrim(lower(w), '{MARKS}')), lambda w: w <> '') AS fs FROM docs),
langs AS (SELECT lang FROM docs WHERE lang IS NOT NULL GROUP BY 1 HAVING count(*) >= {p.min_share} * (SELECT count(*) FROM docs)),
stood AS (SELECT lang, unnest(list_distinct(fs)) AS w FROM lined SEMI JOIN langs USING (lang)),
ranked AS (SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS r FROM stood GROUP BY 1, 2),
vocabulary AS (SELECT lang, list(w ORDER BY r) AS vs FROM ranked WHERE r <= {p.common_words} GROUP BY 1),
base AS (SELECT l.doc_id, lang, t, ws, fs, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST({removed('#*$%&|<>')} AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM lined l LEFT JOIN repeats r USING (doc_id)),
hist AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {removed(r'\p{Ll}')} AS a, {removed(r'\p{Lu}')} AS b, {removed(r'\p{N}')} AS c, length(t) - word_chars AS d,
  {removed(r".,;:!?''\"()\-")} AS e, list_transform(vs, lambda k: len(list_filter(fs, lambda f: f = k))) AS cw FROM base LEFT JOIN vocabulary USING (lang)),
feats AS (SELECT *, [a, b, c, d, e, word_chars - a - b - c - e] AS cs, list_append(cw, n_words - list_sum(cw)) AS hs FROM hist),
refs AS (SELECT lang, [{sums('cs', 6)}] AS rc, list_filter([{sums('hs', p.common_words + 1)}], lambda x: x IS NOT NULL) AS rh, sum(n_words) AS n FROM feats
  WHERE NOT base_failed AND hs IS NOT NULL GROUP BY 1 HAVING sum(n_words) >= {p.min_reference_words}),
far AS (SELECT f.*, r.n, CASE WHEN list_sum(cs) >= {p.min_chars} THEN {js('cs', 'list_sum(cs)', 'rc', 'list_sum(rc)')} ELSE 0 END AS dc, CASE WHEN n_words >= {p.min_words} THEN {js('hs', 'n_words', 'rh', 'r.n')} ELSE 0 END AS dw
  FROM feats f LEFT JOIN refs r USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (n IS NULL OR (dc <= {p.class_base} + {p.class_slack} / sqrt(list_sum(cs)) AND dw <= {p.word_base} + {p.word_slack} / sqrt(n_words))) AS kept FROM far
"""


def packing_sql(buckets: int = 8, budget: int = 65_536) -> str:
    """The optimum by trying every last boundary of every prefix of the lengths, a table a number of buckets."""
    steps = ", ".join(
        f"c{b} AS (SELECT {b} AS b, h.j, min(p.cost + h.k * (h.n - p.n) - (h.s - p.s)) AS cost, arg_min(p.j, (p.cost + h.k * (h.n - p.n) - (h.s - p.s), -p.j)) AS i, any_value(h.n) AS n, any_value(h.s) AS s "
        f"FROM hist h JOIN c{b - 1} p ON p.j < h.j GROUP BY h.j)"
        for b in range(1, buckets + 1)
    )
    every = " UNION ALL ".join(f"SELECT b, j, cost, i FROM c{b}" for b in range(1, buckets + 1))
    return rf"""
WITH RECURSIVE rows AS (SELECT doc_id, len({WORDS}) + 1 AS length FROM documents),
hist AS (SELECT length AS k, row_number() OVER (ORDER BY length) AS j, sum(count(*)) OVER (ORDER BY length) AS n, sum(length * count(*)) OVER (ORDER BY length) AS s FROM rows GROUP BY length),
c0 AS (SELECT 0 AS b, 0 AS j, 0::HUGEINT AS cost, 0 AS i, 0::HUGEINT AS n, 0::HUGEINT AS s), {steps},
steps AS ({every}), best AS (SELECT b, j FROM steps WHERE j = (SELECT max(j) FROM hist) ORDER BY cost, b LIMIT 1),
path AS (SELECT b, j FROM best UNION ALL SELECT p.b - 1, t.i FROM path p JOIN steps t ON t.b = p.b AND t.j = p.j WHERE p.b > 1),
edges AS (SELECT row_number() OVER (ORDER BY k) - 1 AS bucket, k AS width, greatest(1, {budget} // k) AS size FROM path JOIN hist USING (j)),
placed AS (SELECT doc_id, length, (SELECT count(*) FROM edges WHERE width < length) AS bucket FROM rows),
numbered AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id NULLS FIRST, length) - 1 AS r FROM placed),
starts AS (SELECT bucket, coalesce(sum(-(-n // size)) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM (SELECT bucket, size, CAST(ceil(count(*) / size) AS BIGINT) * size AS n FROM placed JOIN edges USING (bucket) GROUP BY 1, 2))
SELECT doc_id, length, CAST(bucket AS INTEGER) AS bucket, width, CAST(first + r // size AS BIGINT) AS batch, CAST(r % size AS BIGINT) AS slot, width - length AS padding FROM numbered JOIN edges USING (bucket) JOIN starts USING (bucket)
"""


def sharding_sql(shards: int = 40, overhead: int = 16) -> str:
    """CRC-32 by its table, made from the polynomial; shards by running bytes over all documents."""
    return rf"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
bytes AS (SELECT doc_id, strlen(coalesce(text, '')) + {overhead} AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bs FROM documents),
sizes AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, bs), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32 FROM bytes, crc),
ordered AS (SELECT *, row_number() OVER w AS r, sum(size) OVER w AS upto, sum(size) OVER () AS total FROM sizes WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
dealt AS (SELECT *, CAST(least((2 * upto - size) * {shards} // (2 * total), {shards - 1}) AS INTEGER) AS shard FROM ordered)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, r - min(r) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM dealt
"""

# The primes of the 64-bit hash.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261


M = "18446744073709551616::UHUGEINT"


def _big(x) -> str:
    return f"({x})::UHUGEINT"


def _cut(x) -> str:
    return f"(({x}) % {M})::UBIGINT"


def _times(a, p) -> str:
    return _cut(f"{_big(a)} * {_big(p)}")


def _turn(x, r: int) -> str:
    return _cut(f"{_big(x)} * {2**r} + {_big(x)} // {2 ** (64 - r)}")


def _with(value: str, step: str) -> str:
    """step of x, with value worked out once."""
    return f"list_transform([{value}], lambda x: {step})[1]"


def _end(h: str) -> str:
    for shift, p in ((33, P2), (29, P3)):
        h = _times(_with(h, f"xor(x, x >> {shift})"), p)
    return _with(h, "xor(x, x >> 32)")


def hash_sql(source: str, seed: int) -> str:
    """CTEs that end in hashed(g, h): the 64-bit hash of every text g of source, by stripes, lanes and bytes."""
    mix = lambda a, lane: _times(_turn(_cut(f"{_big(a)} + {_big(_times(lane, P2))}"), 31), P1)
    zero = "0::UBIGINT"
    lanes = lambda size, at, n: f"list_transform(range({n}), lambda i: CAST('0x' || array_to_string(list_reverse(hs[{at} + i * {size} + 1 : {at} + i * {size} + {size}]), '') AS UBIGINT))"
    fold = lambda first, rest, step: f"list_reduce(list_prepend({first}, {rest}), lambda a, x: {step})"
    stripes = ", ".join(
        f"{fold(f'{(seed + init) % 2**64}::UBIGINT', f'list_transform(range(whole), lambda k: w8[4 * k + {i + 1}])', mix('a', 'x'))} AS v{i + 1}" for i, init in enumerate((P1 + P2, P2, 0, -P1))
    )
    joined = f"{_big(_turn('v1', 1))} + {_big(_turn('v2', 7))} + {_big(_turn('v3', 12))} + {_big(_turn('v4', 18))}"
    gather = fold(_cut(joined), "[v1, v2, v3, v4]", _cut(f"{_big(_times('xor(a, ' + mix(zero, 'x') + ')', P1))} + {_big(P4)}"))
    eights = fold("h0", "w8[4 * whole + 1 :]", _cut(f"{_big(_times(_turn('xor(a, ' + mix(zero, 'x') + ')', 27), P1))} + {_big(P4)}"))
    fours = fold("h1", lanes(4, "8 * len(w8)", "(n - 8 * len(w8)) // 4"), _cut(f"{_big(_times(_turn('xor(a, ' + _times('x', P1) + ')', 23), P2))} + {_big(P3)}"))
    ones = fold("h2", lanes(1, "n - n % 4", "n % 4"), _times(_turn("xor(a, " + _times("x", P5) + ")", 11), P1))
    return f"""cutup AS (SELECT g, regexp_extract_all(hex(encode(g)), '..') AS hs, strlen(g) AS n, CASE WHEN strlen(g) >= 32 THEN strlen(g) // 32 ELSE 0 END AS whole FROM (SELECT DISTINCT g FROM {source})),
laned AS (SELECT *, {lanes(8, 0, "n // 8")} AS w8 FROM cutup), striped AS (SELECT *, {stripes} FROM laned),
begun AS (SELECT *, {_cut(f"(CASE WHEN whole > 0 THEN {_big(gather)} ELSE {_big((seed + P5) % 2**64)} END) + n::UHUGEINT")} AS h0 FROM striped),
a8 AS (SELECT *, {eights} AS h1 FROM begun), a4 AS (SELECT *, {fours} AS h2 FROM a8), a1 AS (SELECT g, {ones} AS h FROM a4), hashed AS (SELECT g, {_end("h")} AS h FROM a1)"""


def simhash_sql(shingle: int = 3, seed: int = 42, distance: int = 2) -> str:
    """The hash of every distinct shingle, bits by majority, links between all distinct fingerprints, and reach."""
    return rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (SELECT doc_id, unnest(CASE WHEN len(ws) < {shingle} THEN [array_to_string(ws, ' ')] ELSE list_transform(range(len(ws) - {shingle - 1}), lambda i: array_to_string(ws[i + 1 : i + {shingle}], ' ')) END) AS g FROM docs WHERE len(ws) > 0),
{hash_sql("shingles", seed)},
bits AS (SELECT doc_id, b, 2 * sum((h >> b) & 1) > count(*) AS one FROM shingles JOIN hashed USING (g), range(64) t(b) GROUP BY 1, 2),
printed AS (SELECT d.doc_id, coalesce(p.fp, '{"0" * 64}') AS fp FROM docs d LEFT JOIN (SELECT doc_id, string_agg(CASE WHEN one THEN '1' ELSE '0' END, '' ORDER BY b DESC) AS fp FROM bits GROUP BY 1) p USING (doc_id)),
classes AS (SELECT fp, CAST(fp AS BIT) AS v, min(doc_id) AS rep FROM printed GROUP BY 1),
links AS (SELECT a.fp AS x, b.fp AS y FROM classes a JOIN classes b ON a.fp <> b.fp AND bit_count(xor(a.v, b.v)) <= {distance}),
reach AS (SELECT fp, fp AS far FROM classes UNION SELECT r.fp, l.y FROM reach r JOIN links l ON l.x = r.far),
named AS (SELECT r.fp, min(rep) AS component_id FROM reach r JOIN classes c ON c.fp = r.far GROUP BY 1)
SELECT doc_id, lower(hex(CAST(CAST(fp AS BIT) AS BLOB))) AS fingerprint, component_id FROM printed JOIN named USING (fp)
"""


def winnow_sql(gram: int = 5, window: int = 8, seed: int = 42) -> str:
    """Words, grams and windows of every text and its edited text; a gram's hash chains its words' hashes."""
    step = f"xor({_cut(f'{_big("a")} + {_big(P5)} + 8')}, {_times(_turn(_times('y', P2), 31), P1)})"
    chained = f"list_reduce(list_prepend({seed}::UBIGINT, gs), lambda a, y: {_end(_cut(f'{_big(_times(_turn(step, 27), P1))} + {_big(P4)}'))})"
    return rf"""
WITH ordered AS (SELECT row_number() OVER w AS r, doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER w AS after, first_value(coalesce(text, '')) OVER w AS top FROM documents WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, coalesce(text, ''))),
nexts AS (SELECT r, doc_id, t, coalesce(after, top) AS nt FROM ordered),
texts AS (SELECT r, unnest([0, 1, 2]) AS kind, unnest([t, left(t, length(t) - length(t) // 2) || left(nt, length(t) // 2), nt]) AS t FROM nexts),
worded AS (SELECT t, list_transform(flatten(list_transform(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), lambda w: CASE WHEN length(w) > 64 THEN regexp_extract_all(w, '(?s).{{1,16}}') ELSE [w] END)), lambda w: w) AS ws FROM (SELECT DISTINCT t FROM texts)),
words AS (SELECT t, unnest(ws) AS g, generate_subscripts(ws, 1) AS i FROM worded),
{hash_sql("words", seed)},
placed AS (SELECT t, list(h ORDER BY i) AS hs FROM words JOIN hashed USING (g) GROUP BY t),
grams AS (SELECT t, list_transform(CASE WHEN len(hs) < {gram} THEN [hs] ELSE list_transform(range(len(hs) - {gram - 1}), lambda i: hs[i + 1 : i + {gram}]) END, lambda gs: {chained}) AS us FROM placed),
signed AS (SELECT t, list_transform(us, lambda u: CASE WHEN u >= 9223372036854775808 THEN (u::HUGEINT - 18446744073709551616)::BIGINT ELSE u::BIGINT END) AS ss, us, least({window}, len(us)) AS w FROM grams),
kept AS (SELECT t, us, list_sort(list_distinct(list_transform(range(len(ss) - w + 1), lambda s: s + w - list_position(list_reverse(ss[s + 1 : s + w]), list_min(ss[s + 1 : s + w]))))) AS ats FROM signed),
prints AS (SELECT t, list_transform(ats, lambda p: CAST(p AS INTEGER)) AS positions, list_transform(ats, lambda p: lpad(lower(hex((us[p + 1] & 4294967295)::BIGINT)), 8, '0')) AS hx FROM kept),
joined AS (SELECT x.r, kind, x.t, coalesce(hx, []) AS hx, coalesce(positions, []) AS positions FROM texts x LEFT JOIN prints USING (t)),
sides AS (SELECT n.doc_id, n.t, e.t AS et, a.positions, a.hx AS a, e.hx AS b, c.hx AS c FROM nexts n JOIN joined a ON a.r = n.r AND a.kind = 0 JOIN joined e ON e.r = n.r AND e.kind = 1 JOIN joined c ON c.r = n.r AND c.kind = 2)
SELECT doc_id, length(t) AS n_chars, sha256(et) AS edited_sha256, array_to_string(a, ' ') AS fingerprint, array_to_string(b, ' ') AS edited_fingerprint,
CASE WHEN len(a) + len(b) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_distinct(a), list_distinct(b)))::DOUBLE / len(list_distinct(a || b)) END AS near_edited,
CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(list_distinct(a), list_distinct(c)))::DOUBLE / len(list_distinct(a || c)) END AS near_next, positions FROM sides
"""
