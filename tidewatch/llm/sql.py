"""SQL with the results of those queries that SQL can express, for comparison."""

from __future__ import annotations

from tidewatch.llm import quality_rules as Q

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def crc_table() -> list[int]:
    """CRC-32 of the single bytes, reversed polynomial EDB88320."""
    out = []
    for b in range(256):
        for _ in range(8):
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        out.append(b)
    return out


def winner(n: int) -> str:
    score = "('0x' || substr(md5('shard/' || i || '/' || key), 1, 13))::BIGINT"
    return f"-list_max(list_transform(range({n}), lambda i: {{'s': {score}, 'n': -i}})).n::INTEGER"


OP8 = f"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents),
s AS (
  SELECT doc_id, size, {winner(24)} AS shard, {winner(25)} AS grown_shard,
    xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, bytes),
      lambda c, b: xor(c >> 8, {crc_table()}[1 + xor(c & 255, b)]::BIGINT))) AS text_crc32
  FROM d)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM s
"""

#: Passes of the draw that the SQL spells out; the operator goes on until nothing fits.
_PASSES = 16


def _op7_passes() -> str:
    """A pass takes, in the order of ranks, the free documents that fit what is open, up to the first that doesn't."""
    start = "p0 AS (SELECT *, false AS drawn FROM q),"
    step = """
g{n} AS (SELECT source, any_value(free) - coalesce(sum(size) FILTER (drawn), 0) AS gap FROM p{m} GROUP BY source),
f{n} AS (
  SELECT p.uid, g.gap, sum(p.size) OVER (PARTITION BY p.source ORDER BY p.q, p.h, p.uid ROWS UNBOUNDED PRECEDING) AS run
  FROM p{m} p JOIN g{n} g ON p.source IS NOT DISTINCT FROM g.source WHERE p.q IS NOT NULL AND NOT p.drawn AND p.size <= g.gap),
p{n} AS (
  SELECT p.* EXCLUDE (drawn), p.drawn OR coalesce(f.run <= f.gap, false) AS drawn FROM p{m} p LEFT JOIN f{n} f ON p.uid = f.uid),"""
    return start + "".join(step.format(n=n, m=n - 1) for n in range(1, _PASSES + 1))


OP7 = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || coalesce(text, '')) AS h,
    row_number() OVER () AS uid
  FROM documents),
r AS (SELECT *, length(bin(size)) AS digits, (('0x' || substr(h, 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656 AS u FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
w AS (SELECT *, 3 * source_size AS most, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(most) OVER (ORDER BY most::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / (sum(weight) OVER (ORDER BY most::DOUBLE / weight,
      source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w),
t AS (
  SELECT source, source_size, CASE WHEN most <= level * weight THEN most::DOUBLE
    ELSE (SELECT arg_min(level, most::DOUBLE / weight) FROM l WHERE most > level * weight) * weight END AS target FROM l),
g AS (SELECT source, digits, sum(size)::BIGINT AS words FROM r GROUP BY source, digits),
a AS (
  SELECT g.*, target, (target - 3 * coalesce(sum(words) OVER (PARTITION BY g.source ORDER BY digits DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / nullif(sum(words * digits) OVER (PARTITION BY g.source
      ORDER BY digits DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0)::DOUBLE AS alpha
  FROM g JOIN t ON g.source IS NOT DISTINCT FROM t.source),
b AS (SELECT *, coalesce(alpha, 0) * digits >= 3 AS at_most FROM a),
f AS (SELECT source, arg_max(coalesce(alpha, 0), digits) AS alpha FROM b WHERE NOT at_most GROUP BY source),
m AS (
  SELECT b.source, digits, words, target, CASE WHEN at_most THEN 3.0::DOUBLE ELSE greatest(f.alpha, 0) * digits END AS m
  FROM b LEFT JOIN f ON b.source IS NOT DISTINCT FROM f.source),
p AS (
  SELECT *, floor(m)::BIGINT AS certain, m - floor(m) AS pi,
    target - (sum(floor(m)::BIGINT * words) OVER (PARTITION BY source))::DOUBLE AS free FROM m),
q AS (
  SELECT r.doc_id, r.source, r.size, r.h, r.uid, p.target, p.certain, p.free,
    CASE WHEN p.pi > 0 AND r.size > 0 THEN r.u * (1 - p.pi) / ((1 - r.u) * p.pi) END AS q
  FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source AND r.digits = p.digits),
{_op7_passes()}
z AS (SELECT p0.source, any_value(p0.free) - coalesce(sum(p0.size) FILTER (p{_PASSES}.drawn), 0) AS gap
  FROM p0 JOIN p{_PASSES} ON p0.uid = p{_PASSES}.uid GROUP BY p0.source),
k AS (
  SELECT arg_min(e.uid, {{'a': e.size, 'b': e.q, 'c': e.h, 'd': e.uid}}) AS uid FROM p{_PASSES} e JOIN z ON e.source IS NOT DISTINCT FROM z.source
  WHERE e.q IS NOT NULL AND NOT e.drawn AND e.size < 2 * z.gap GROUP BY e.source)
SELECT e.doc_id, e.size, t.source_size, e.target,
  CASE WHEN e.size = 0 THEN 0 ELSE (e.certain + CASE WHEN e.drawn OR k.uid IS NOT NULL THEN 1 ELSE 0 END) * e.size END::BIGINT AS taken
FROM p{_PASSES} e JOIN t ON e.source IS NOT DISTINCT FROM t.source LEFT JOIN k ON e.uid = k.uid
"""

OP9 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
x AS (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
y AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM x) WHERE n > 1),
v AS (SELECT r, count(DISTINCT i + j) AS n FROM y, range(3) AS s(j) GROUP BY r),
b AS (
  SELECT d.r, doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM d LEFT JOIN v ON d.r = v.r),
c AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [CASE WHEN n_words > 0 THEN least(100, 100 * n_symbols // n_words) ELSE 0 END,
     CASE WHEN n_lines > 0 THEN least(100, 100 * n_dup_lines // n_lines) ELSE 0 END,
     CASE WHEN n_words > 0 THEN least(100, 100 * n_repeat_words // n_words) ELSE 0 END,
     CASE WHEN word_chars > 0 THEN least(100, 100 * n_capitals // word_chars) ELSE 0 END] AS levels FROM b),
m AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
s AS (SELECT *, list_min([{", ".join(f"{f}[levels[{i + 1}] + 1]" for i, f in enumerate(Q.first_steps()))}]) AS step FROM c),
e AS (SELECT lang, step, good FROM s JOIN m ON s.doc_id = m.doc_id WHERE NOT base_failed),
h AS (
  SELECT lang, t, count(*) FILTER (good) AS n, count(*) FILTER (good AND step <= t) AS lost, count(*) FILTER (NOT good AND step <= t) AS caught
  FROM e, range(1, {len(Q.path()) + 1}) AS k(t) GROUP BY lang, t),
i AS (
  SELECT *, n > 0 AND lost < n * {Q.ALPHA} AND (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
      + j * ln({Q.ALPHA}) + (n - j) * ln(1 - {Q.ALPHA}))) FROM range(0, lost + 1) AS k(j))
    <= {Q.DELTA} / (SELECT count(DISTINCT lang) FROM e) AS good_enough FROM h),
j AS (SELECT *, bool_and(good_enough) OVER (PARTITION BY lang ORDER BY t) AS certified FROM i),
n AS (
  SELECT lang, arg_max(t, {{'w': caught - {Q.PENALTY} * lost, 't': -t}}) AS t FROM j
  WHERE certified AND caught - {Q.PENALTY} * lost > 0 GROUP BY lang),
u AS (SELECT s.r, step <= t AS rejected FROM s JOIN n ON s.lang = n.lang)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM c LEFT JOIN u ON c.r = u.r
"""

OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p),
d AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(h, 5 * i + 1, 5))::INTEGER) AS parts FROM m)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
  array_to_string(list_transform(parts, lambda x: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((x >> s) & 31), 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

_OP11_NEAREST = """
SELECT p.u, arg_min(p.n, [p.d, p.n]) AS n, min(p.d)::BIGINT AS d
FROM (SELECT v.u, c.n, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN {c} c ON v.i = c.i GROUP BY v.u, c.n) p GROUP BY p.u"""


def op11(rounds: int = 5, k: int = 40) -> str:
    """One pair of subqueries per round: assignment, then centroids."""
    steps = "".join(
        f"a{r} AS ({_OP11_NEAREST.format(c=f'c{r}')}),\n"
        f"m{r} AS (SELECT a.n, v.i, floor_of(sum(v.x), count(*)) AS x FROM a{r} a JOIN v ON a.u = v.u GROUP BY a.n, v.i),\n"
        f"c{r + 1} AS (SELECT c.n, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.n = m.n AND c.i = m.i),\n"
        for r in range(rounds)
    ).replace("floor_of(sum(v.x), count(*))", "((sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT")
    return f"""
WITH e AS (
  SELECT row_number() OVER () AS u, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
v AS (SELECT u, i, floor(256 * embedding[i]::DOUBLE)::BIGINT AS x FROM e, range(1, 65) r(i)),
s AS (SELECT u, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS n FROM e ORDER BY n LIMIT {k}),
c0 AS (SELECT s.n, v.i, v.x FROM s JOIN v ON s.u = v.u),
{steps}last AS ({_OP11_NEAREST.format(c=f'c{rounds}')}),
h AS (SELECT n, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY n)
SELECT e.vec_id, l.n::INTEGER AS cluster, l.d AS distance, (sum(l.d) OVER (PARTITION BY l.n))::BIGINT AS cluster_inertia,
  (sum(l.d) OVER ())::BIGINT AS inertia, h.h AS centroid_sha256
FROM last l JOIN e ON l.u = e.u JOIN h ON l.n = h.n
"""


OP11 = op11()

_TERMS = r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+'"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def share(count: str, total: str, terms: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({count} + 5)) // ({total} + 5::HUGEINT * {terms})"


OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS u, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER.replace('text', "coalesce(text, '')")}, {_TERMS}) AS terms
  FROM documents),
t AS (SELECT u, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT u) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
nl AS (SELECT lang, sum(total) AS total FROM n GROUP BY lang),
cl AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
p AS (
  SELECT n.lang, n.source, k.term, coalesce(c.n, 0) AS n, {share('coalesce(c.n, 0)', 'n.total', 'v.v')} AS p
  FROM n JOIN k ON n.lang = k.lang JOIN v ON n.lang = v.lang
    LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
q AS (SELECT k.lang, k.term, {share('cl.n', 'nl.total', 'v.v')} AS q FROM k JOIN v USING (lang) JOIN nl USING (lang) JOIN cl USING (lang, term)),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q)::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 50
"""

OP13 = """
WITH d AS (
  SELECT row_number() OVER () AS u, doc_id, coalesce(doc_id, 9223372036854775807) AS k, hex(encode(coalesce(text, ''))) AS hx
  FROM documents),
w AS (SELECT u, k, unnest(range(len(hx) // 2 - 49)) AS p, hx FROM d),
x AS (SELECT u, k, p, substr(hx, 2 * p + 1, 100) AS s FROM w),
f AS (SELECT s, min(k) AS least FROM x GROUP BY s),
hit AS (SELECT x.u, x.p, coalesce(x.p > lag(x.p) OVER (PARTITION BY x.u ORDER BY x.p) + 50, true) AS new FROM x JOIN f USING (s) WHERE f.least < x.k),
run AS (SELECT u, p, sum(new::INT) OVER (PARTITION BY u ORDER BY p) AS nr FROM hit),
cut AS (SELECT u, nr, min(p) AS a, max(p) + 50 AS b FROM run GROUP BY u, nr),
piece AS (SELECT u, a, b, coalesce(lag(b) OVER (PARTITION BY u ORDER BY a), 0) AS upto FROM cut),
kept AS (
  SELECT u, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(hx, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS head
  FROM piece JOIN d USING (u) GROUP BY u)
SELECT d.doc_id, (len(hx) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(head || substr(hx, 2 * last + 1), hx))) AS kept_sha256
FROM d LEFT JOIN kept USING (u)
"""
