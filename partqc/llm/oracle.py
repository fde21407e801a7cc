"""DuckDB SQL of the queries that SQL can express.

Not here: op1 (its hash function is Spark's), op2 (a search over a lattice), op4,
op7 and op8 (fitted models); ``tests/llm`` holds these against brute force,
round trips and held-out accuracy.
"""

from __future__ import annotations

from partqc.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _u32(x: str) -> str:
    return f"CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"


# The plain patterns; what may follow is told by a condition on the match v.
_IBAN = "replace(v, ' ', '')"
_TURNED = f"substr({_IBAN}, 5) || substr({_IBAN}, 1, 4)"
_IBAN_OK = (f"regexp_full_match({_IBAN}, '[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}') AND list_reduce(list_prepend(0,"
            f" list_transform(string_split(array_to_string(list_transform(string_split({_TURNED}, ''), lambda c:"
            f" CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), ''), ''), lambda d: CAST(d AS INT))),"
            f" lambda a, d: (a * 10 + d) % 97) = 1")
# What may be a number at a run r: itself, or leading parts of its groups, the longest first. RE2 has no
# lookahead; \\b does it once the underscore is no word character.
_GROUPS = (r"regexp_extract(translate(substr(t, s + 1, 44), '_', '-'),"
           r" '^[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}\b){2,7}(?: [A-Z0-9]{1,3}\b)?')")
_IBAN_PARTS = f"""CASE WHEN length(v) >= 15 THEN [v]
  WHEN regexp_full_match(v, '[A-Z]{{2}}[0-9]{{2}}') AND regexp_matches(substr(t, s + 5, 5), '^ [A-Z0-9]{{4}}') AND {_GROUPS} <> ''
  THEN list_concat([{_GROUPS}], list_transform(list_filter([7, 6, 5, 4, 3, 2], lambda n: 4 + 5 * n < length({_GROUPS})),
    lambda n: substr({_GROUPS}, 1, 4 + 5 * n))) ELSE [] END"""
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_PII = [  # kind, pattern, condition, base score, context words
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 70, "mail|contact|write|kontakt|correo"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
     "list_max(list_transform(string_split(v, '.'), lambda x: TRY_CAST(x AS HUGEINT))) <= 255"
     " AND len(list_filter(string_split(v, '.'), lambda x: TRY_CAST(x AS HUGEINT) IS NULL)) = 0", 60,
     "ip|address|host|server|adresse"),
    ("card", r"[0-9]([\x20-]?[0-9])+",
     f"length({_DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:"
     f" CAST(substr(CASE WHEN i % 2 = 1 THEN '0123456789' ELSE '0246813579' END,"
     f" CAST(substr({_DIGITS}, CAST(length({_DIGITS}) - i + 1 AS INT), 1) AS INT) + 1, 1) AS INT))) % 10 = 0", 80,
     "card|visa|credit|karte|carte|tarjeta"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15", 60, "tel|phone|call|fax|mobil|handy"),
    # A run of letters and digits: a whole number, or the first of groups (see _IBAN_PARTS).
    ("iban", r"[A-Za-z0-9]+", None, 80, "iban|account|konto|compte|cuenta"),
    ("phone_local", r"[0-9][0-9\x20().-]{6,}[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15", 30,
     "tel|phone|call|fax|mobil|handy"),
]


def _pii() -> str:
    parts = ["WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"]
    for k, (kind, pattern, valid, base, words) in enumerate(_PII):
        found, valid = f"p{k}", valid or "true"
        if kind == "iban":  # the longest part that holds, from the left those that begin after the last one's end
            found = f"kept{k}"
        parts.append(f"""m{k} AS (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS m,
          string_split_regex(t, '{pattern}') AS g FROM d WHERE regexp_matches(t, '{pattern}')),
        p{k} AS (SELECT doc_id, t, m[i] AS v, CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
          FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM m{k})),
        """ + (f"""part{k} AS (SELECT doc_id, t, s, unnest({_IBAN_PARTS}) AS v FROM p{k}),
        best{k} AS (SELECT doc_id, t, s, v FROM part{k} WHERE {_IBAN_OK}
          QUALIFY row_number() OVER (PARTITION BY doc_id, s ORDER BY length(v) DESC) = 1),
        kept{k} AS (SELECT * FROM best{k} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s) = 1 UNION ALL
          SELECT b.* FROM kept{k} a JOIN best{k} b ON a.doc_id = b.doc_id AND b.s >= a.s + length(a.v)
          QUALIFY row_number() OVER (PARTITION BY b.doc_id ORDER BY b.s) = 1),
        """ if kind == "iban" else "") + f"""s{k} AS (SELECT doc_id, {k} AS k, '{kind}' AS kind, s, s + length(v) AS e, {base} + CASE WHEN
          regexp_matches(lower(substr(t, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0))), '{words}') THEN 20 ELSE 0 END AS score
          FROM {found} WHERE {valid})""")
    parts.append("b AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)")
    parts.append("""a AS (SELECT * FROM s4 UNION ALL SELECT * FROM s5 x WHERE NOT EXISTS
        (SELECT 1 FROM b WHERE b.doc_id = x.doc_id AND b.s < x.e AND b.e > x.s))""")
    parts.append("""w AS (SELECT *, kind || ':' || s || ':' || e AS span FROM (SELECT *, true AS own FROM b UNION ALL
        SELECT *, false FROM a WHERE score >= 50)),
      r AS (SELECT doc_id, string_agg(span, ',' ORDER BY k, s) FILTER (own) AS base, string_agg(span, ',' ORDER BY k, s) AS every,
        string_agg(span || ':' || score, ',' ORDER BY k, s) AS scored, """
                 + ", ".join(f"count(*) FILTER (k = {k}) AS n{k}" for k in range(len(_PII))) + " FROM w GROUP BY doc_id)")
    counts = ", ".join(f"coalesce(n{k}, 0) AS n_{x[0]}" for k, x in enumerate(_PII))
    return ",\n".join(parts) + f"""
    SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans,
      coalesce(scored, '') AS scored_spans FROM d LEFT JOIN r USING (doc_id)"""


_MIX = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(text, '{_WORD}')) AS BIGINT) AS n_tokens,
    CAST('0x' || substr(md5(text), 1, 15) AS BIGINT) AS tie FROM documents),
docs AS (SELECT * FROM d WHERE n_tokens > 0),
src AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(*) AS n FROM docs GROUP BY source),
one AS (SELECT CAST(sum(tokens) AS BIGINT) AS total, list(tokens ORDER BY tokens, source) AS ts, count(*) AS k FROM src),
shares AS (SELECT total, k, list_transform(ts, lambda x: x / total) AS p FROM one),
by_entropy AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi UNION ALL
  SELECT i + 1, CASE WHEN h >= goal THEN m ELSE lo END, CASE WHEN h >= goal THEN hi ELSE m END FROM (
    SELECT i, lo, hi, m, 0.95 * ln(k) AS goal, ln(list_sum(list_transform(p, lambda x: pow(x, m))))
      - m * list_sum(list_transform(p, lambda x: pow(x, m) * ln(x))) / list_sum(list_transform(p, lambda x: pow(x, m))) AS h
    FROM (SELECT *, (lo + hi) / 2 AS m FROM by_entropy) e, shares WHERE i < 50)),
by_repeats AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi UNION ALL
  SELECT i + 1, CASE WHEN r > 4 THEN m ELSE lo END, CASE WHEN r > 4 THEN hi ELSE m END FROM (
    SELECT i, lo, hi, m, pow(p[1], m) / list_sum(list_transform(p, lambda x: pow(x, m))) / p[1] AS r
    FROM (SELECT *, (lo + hi) / 2 AS m FROM by_repeats) e, shares WHERE i < 50)),
ex AS (SELECT greatest((SELECT lo FROM by_entropy WHERE i = 50), CASE WHEN 1 / k / p[1] <= 4 THEN 0
  ELSE (SELECT hi FROM by_repeats WHERE i = 50) END) AS e FROM shares),
w AS (SELECT source, tokens, n, CAST(floor(round(pow(tokens / total, e)
  / list_sum(list_transform(p, lambda x: pow(x, e))) * total, 3)) AS BIGINT) AS quota FROM src, shares, ex),
plan AS (SELECT *, CAST(ceil(n / 4096) AS BIGINT) AS blocks, quota // tokens AS whole, quota % tokens AS rest FROM w),
dealt AS (SELECT docs.*, whole, rest, {_u32("'5:' || doc_id || ':' || tie")} % blocks AS block FROM docs JOIN plan USING (source)),
total AS (SELECT source, block, whole, rest, CAST(sum(n_tokens) AS BIGINT) AS t FROM dealt GROUP BY ALL),
pass AS (SELECT *, unnest(range(0, whole + 1)) AS epoch FROM total),
ranked AS (SELECT *, row_number() OVER o AS block_rank, CAST(sum(t) OVER o AS BIGINT) - t AS before FROM pass
  WINDOW o AS (PARTITION BY source, epoch ORDER BY md5('5:' || epoch || ':block:' || block), block)),
state AS (SELECT source, block, epoch, block_rank, rest - before AS room, CASE WHEN epoch < whole THEN 2
  WHEN before + t <= rest THEN 2 WHEN before < rest THEN 1 END AS state FROM ranked),
drawn AS (SELECT doc_id, source, n_tokens, epoch, block_rank, state, room, sum(n_tokens) OVER (
  PARTITION BY source, block, epoch ORDER BY md5('5:' || epoch || ':row:' || doc_id), n_tokens, tie
  ROWS UNBOUNDED PRECEDING) AS till FROM dealt JOIN state USING (source, block) WHERE state IS NOT NULL)
SELECT doc_id, source, n_tokens, epoch, block_rank FROM drawn WHERE state = 2 OR till <= room
"""

_JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3),
    lambda i: array_to_string(ws[i:i + 4], ' '))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c, any_value(a.n) AS n, any_value(b.n) AS m
  FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
edge AS (SELECT u, v FROM pair WHERE 100 * c >= 80 * (n + m - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM s UNION SELECT r.u, e.v FROM reach r JOIN edge e ON r.v = e.u)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(v) AS component_id FROM s JOIN reach ON reach.u = s.doc_id
GROUP BY s.doc_id, len(s.s)
"""

def _same(a: str, b: str) -> str:
    """Number of leading elements that two lists share."""
    return f"len(list_filter(range(1, least(len({a}), len({b})) + 1), lambda i: ({a})[1:i] = ({b})[1:i]))"


_LINES = f"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, list_transform(lines, lambda x: {_u32('x')}) AS h,
  list_transform(lines, lambda x: len(regexp_extract_all(x, '{_WORD}'))) AS w FROM l),
c AS (SELECT *, list_filter(range(1, len(h)), lambda i: w[i] >= 16 OR w[i + 1] >= 16
  OR (h[i] * 31 + coalesce(h[i - 1], 0)) % 3 = 0) AS cuts FROM h),
z AS (SELECT *, list_filter(list_zip(list_concat([CAST(0 AS BIGINT)], cuts), list_concat(cuts, [len(lines)])),
  lambda z: w[z[1] + 1] >= 16 OR (z[2] - z[1] > 1 AND list_sum(w[z[1] + 1:z[2]]) > 0)) AS z FROM c),
u AS (SELECT doc_id, lines, z, unnest(range(1, len(z) + 1)) AS n FROM z),
k AS (SELECT doc_id, lines, z[n][1] AS s, z[n][2] AS e, lines[z[n][1] + 1:z[n][2]] AS chunk,
  list_reverse(lines[coalesce(z[n - 1][1], 0) + 1:z[n][1]]) AS lft, lines[z[n][2] + 1:coalesce(z[n + 1][2], len(lines))] AS rgt FROM u),
f AS (SELECT *, row_number() OVER q AS nth, first_value(lft) OVER q AS lft0, first_value(rgt) OVER q AS rgt0
  FROM k WINDOW q AS (PARTITION BY chunk ORDER BY doc_id, s)),
g AS (SELECT *, coalesce(lag(e) OVER d, 0) AS lo, coalesce(lead(s) OVER d, len(lines)) AS hi FROM f WHERE nth > 1
  WINDOW d AS (PARTITION BY doc_id ORDER BY s)),
gone AS (SELECT doc_id, s - {_same('list_reverse(lines[lo + 1:s])', 'lft0')} AS s,
  e + {_same('lines[e + 1:hi]', 'rgt0')} AS e FROM g
  UNION ALL SELECT doc_id, 0, len(lines) FROM (SELECT *, row_number() OVER (PARTITION BY lines ORDER BY doc_id) AS nth FROM h
    WHERE list_sum(w) > 0) WHERE nth > 1),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS i FROM l),
stay AS (SELECT line.doc_id, i, line, gone.doc_id IS NOT NULL AS gone FROM line LEFT JOIN (SELECT DISTINCT doc_id,
    unnest(range(s, e)) AS j FROM gone) gone ON gone.doc_id = line.doc_id AND i = j)
SELECT d.doc_id, count(i) AS n_lines, count(*) FILTER (gone) AS n_removed_lines,
  CASE WHEN any_value(d.text) IS NULL THEN NULL ELSE coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') END AS kept_text
FROM documents d LEFT JOIN stay ON stay.doc_id = d.doc_id GROUP BY d.doc_id
"""

_NEAREST = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0
  AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

# A digest's input: '-' for null, else UTF-8 byte count, ':', value.
def _field(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
_CRC = ("xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(k) + 1),"
        " lambda i: CAST(ord(substr(k, CAST(i AS INT), 1)) AS BIGINT))), lambda c, b: list_reduce("
        "list_concat([xor(c, b)], range(8)), lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))))")
_FOLD = """SELECT p.k, p.g, p.l + 1, p.i // 2, (p.n + 1) // 2, p.proof || coalesce(s.d, ''),
  sha256(CASE WHEN s.d IS NULL THEN p.d WHEN s.i > p.i THEN p.d || s.d ELSE s.d || p.d END), p.root
  FROM {path} p LEFT JOIN {node} s ON s.g = p.g AND s.l = p.l AND s.i = xor(p.i, 1) WHERE p.n > 1"""

_MERKLE = f"""
WITH RECURSIVE leaf AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_LEAF.format(n='n_chars')} AS leaf,
  CASE WHEN {_CRC} % 7 = 0
    THEN {_LEAF.format(n='(n_chars + 1)')} ELSE {_LEAF.format(n='n_chars')} END AS claim FROM (SELECT *, CAST(doc_id AS VARCHAR) AS k FROM documents)),
placed AS (SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  count(*) OVER (PARTITION BY g) AS n FROM leaf),
node(g, l, i, d, n) AS (SELECT g, 0, i, leaf, n FROM placed UNION ALL
  SELECT g, l + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 1) // 2) FROM node WHERE n > 1
  GROUP BY g, l, i // 2),
sub AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
top(g, l, i, d, n) AS (SELECT '', 0, i, d, n FROM sub UNION ALL
  SELECT g, l + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), any_value((n + 1) // 2) FROM top WHERE n > 1
  GROUP BY g, l, i // 2),
low(k, g, l, i, n, proof, d, root) AS (SELECT k, g, 0, i, n, '', claim, '' FROM placed UNION ALL {_FOLD.format(path='low', node='node')}),
high(k, g, l, i, n, proof, d, root) AS (SELECT low.k, '', 0, sub.i, sub.n, low.proof, low.d, sub.d FROM low JOIN sub ON sub.g = low.g
  WHERE low.n = 1 UNION ALL {_FOLD.format(path='high', node='top')})
SELECT doc_id, leaf, high.root AS subroot, top.d AS root, sha256(high.proof) AS proof_sha256, high.d AS folded_root,
  high.d = top.d AS verified FROM placed JOIN high ON high.k = placed.k AND high.n = 1 JOIN top ON top.n = 1
"""


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Lloyd rounds written out: every part against every entry of its codebook."""
    def nearest(r: int) -> str:
        return (f"a{r} AS (SELECT v, p, any_value(x) AS x, min(list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform("
                f"list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), lambda a, b: a + b)) AS err,"
                f" arg_min(e, (list_reduce(list_concat([CAST(0 AS BIGINT)], list_transform(list_zip(x, c),"
                f" lambda z: (z[1] - z[2]) * (z[1] - z[2]))), lambda a, b: a + b)) * {entries} + e) AS e"
                f" FROM part JOIN b{r} USING (p) GROUP BY v, p)")
    steps = [nearest(0)]
    for r in range(1, rounds + 1):
        steps.append(
            f"m{r} AS (SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS c FROM (SELECT p, e, j, sum(y) AS s,"
            f" count(*) AS n FROM (SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS j FROM a{r - 1}) GROUP BY ALL) GROUP BY p, e)")
        steps.append(f"b{r} AS (SELECT p, e, coalesce(m{r}.c, b{r - 1}.c) AS c FROM b{r - 1} LEFT JOIN m{r} USING (p, e))")
        steps.append(nearest(r))
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS v, vec_id, label, list_transform(embedding,
    lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0),
part AS (SELECT v, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] AS x FROM v, range({parts}) t(p)),
b0 AS (SELECT p, v AS e, x AS c FROM part WHERE v < {entries}),
{', '.join(steps)},
row AS (SELECT v, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(err) AS BIGINT) AS error FROM a{rounds} GROUP BY v)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM v JOIN row USING (v)
"""


def _licenses() -> str:
    """Every block against every template, without filters."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    pick = lambda x: f"regexp_extract_all(translate({x}, '{_UPPER}', '{_LOWER}'), '{word}')"
    rows = ", ".join(f"({t}, '{label}', '{text}')" for t, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{phrase}', '{label}')" for phrase, label in PHRASES)
    return f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS k, {pick("coalesce(text, '')")} AS ws FROM documents),
tw AS (SELECT t, label, {pick('text')} AS ws FROM (VALUES {rows}) x(t, label, text)),
half AS (SELECT max(len(ws)) AS s FROM tw),
token AS (SELECT DISTINCT t, label, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS pair FROM tw),
need AS (SELECT t, count(*) AS m FROM token GROUP BY t),
pair AS (SELECT k, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS pair,
  unnest(range(len(ws) - 1)) AS i FROM w WHERE len(ws) > 1),
hit AS (SELECT k, t, label, pair, i FROM pair JOIN token USING (pair)),
dealt AS (SELECT k, t, label, pair, i // s AS b FROM hit, half UNION
  SELECT k, t, label, pair, i // s - 1 FROM hit, half WHERE i >= s AND i + 1 < (i // s + 1) * s),
held AS (SELECT k, t, label, count(*) AS c FROM dealt GROUP BY k, t, label, b),
good AS (SELECT k, label, c / m AS share FROM held JOIN need USING (t) WHERE 100 * c >= {THRESHOLD} * m),
place AS (SELECT k, label, i FROM (SELECT k, ws, label, string_split(phrase, ' ') AS ps, unnest(range(len(ws))) AS i
  FROM w, (VALUES {phrases}) x(phrase, label)) WHERE ws[i + 1:i + len(ps)] = ps),
base AS (SELECT k, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM place GROUP BY k),
every AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share FROM (
  SELECT k, label, share FROM good UNION ALL SELECT k, label, 1.0 FROM place) GROUP BY k)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(share, 0.0) AS score
FROM w LEFT JOIN base USING (k) LEFT JOIN every USING (k)
"""


ORACLE: dict[str, str] = {
    "op3_pii": _pii(),
    "op5_mixing": _MIX,
    "op6_jaccard_join": _JACCARD,
    "op9_line_dedup": _LINES,
    "op10_nearest": _NEAREST,
    "op11_vector_codes": _codes(),
    "op12_merkle_manifest": _MERKLE,
    "op13_license_scan": _licenses(),
}
