"""Personal data in texts: patterns propose, checksums confirm, context scores.

Base kinds (leftmost matches that do not overlap, each kind by itself):

  email        name@host.domain
  ip           four dotted numbers, each at most 255
  card         16 to 19 digits, single blanks or hyphens between, Luhn sum 0
  phone        + and 8 to 15 digits with the usual separators

Added by the method (never in place of a base span):

  iban         country, check digits and 11 to 30 more in one run or in groups
               of four, whose mod-97 remainder is 1, not in the middle of a word;
               of groups that words in capitals or numbers follow, the longest
               leading part (whole groups, the last one shorter) with remainder 1
  phone_local  8 to 15 digits without +, overlapping no base span, accepted only
               when a word for a telephone stands shortly before

A span's score in percent is its kind's base, plus ``CONTEXT_BONUS`` if one of
the kind's context words occurs in the ``CONTEXT`` code points before it; added
spans below ``ACCEPT`` are dropped.  Positions are code points, the end exclusive.

Patterns run possessively, or start only where a match can begin, so matching is
linear in the text; positions are running sums of the lengths of matches and of
what lies between them, overlaps of added spans a running maximum over the sorted
ends.  Both run by blocks of ``RUN`` (a total per block, then inside the block), so a text's work
grows with its matches, not with their square.  Everything is a column expression
on one row: no shuffle.

Nulls and oddities: a null or empty text has no spans; a null id and rows that
repeat an id are reported row by row; other columns pass through unused whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT, CONTEXT_BONUS, ACCEPT = 40, 20, 50

#: kind -> (pattern, cheap test, base score, context words)
KINDS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 70,
              "mail|contact|write|kontakt|correo"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", ".", 60, r"ip|address|host|server|adresse"),
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])", None, 80,
             "card|visa|credit|karte|carte|tarjeta"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", 60, "tel|phone|call|fax|mobil|handy"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20[A-Z0-9]{4})|[A-Za-z0-9]{15,}+", None, 80, "iban|account|konto|compte|cuenta"),
    "phone_local": (r"[0-9][0-9\x20().-]{6,}[0-9]", None, 30, "tel|phone|call|fax|mobil|handy"),
}
#: The groups that begin at a match of four characters, each a word of its own.
_GROUPS = r"^[A-Z]{2}[0-9]{2}(?:\x20[A-Z0-9]{4}(?![A-Za-z0-9])){2,7}(?:\x20[A-Z0-9]{1,3}(?![A-Za-z0-9]))?"
BASE = ("email", "ip", "card", "phone")
_TESTS = {"card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", "iban": r"[A-Z]{2}[0-9]{2}",
          "phone_local": r"(?i)tel|phone|call|fax|mobil|handy"}


def _digits(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]', '')"


def luhn(digits: str) -> str:
    """SQL: whether a string of digits has Luhn sum 0 modulo 10."""
    c = f"int(substr({digits}, length({digits}) - i + 1, 1))"
    return (f"aggregate(sequence(1, length({digits})), 0, (a, i) -> a + if(i % 2 = 1, {c}, "
            f"int(substr('0246813579', {c} + 1, 1)))) % 10 = 0")


def mod97(s: str) -> str:
    """SQL: whether an account number (blanks removed) has remainder 1."""
    turned = f"concat(substr({s}, 5), substr({s}, 1, 4))"
    return (f"aggregate(split({turned}, ''), 0, (a, c) -> if(c = '', a, if(c >= 'A', "
            f"(a * 100 + ascii(c) - 55) % 97, (a * 10 + ascii(c) - 48) % 97))) = 1")


_VALID = {
    "email": "true",
    "ip": r"v rlike r'^(?:0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$'",
    "card": luhn(_digits("v")),
    "phone": f"length({_digits('v')}) between 8 and 15",
    "iban": (r"replace(v, ' ', '') rlike r'^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$' and "
             + mod97("replace(v, ' ', '')")),
    "phone_local": f"length({_digits('v')}) between 8 and 15",
}


#: Matches per block of a running sum or maximum; code points per piece of a text.
RUN, PIECE = 128, 1024


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(steps: str, each: str, join: str) -> str:
    """SQL: for every place i of the array ``steps`` (not empty), ``each`` (an
    expression of i and ``before``), ``before`` being the elements ahead of i
    joined by ``join`` (of a and x; 0 for none)."""
    fold = lambda part: f"aggregate({part}, 0, (a, x) -> {join})"
    blocks = f"transform(sequence(0, (size(st) - 1) div {RUN}), b -> {fold(f'slice(st, b * {RUN} + 1, {RUN})')})"
    ahead = f"transform(sequence(0, size(bl) - 1), b -> {fold('slice(bl, 1, b)')})"
    inside = f"aggregate(slice(st, i - i % {RUN} + 1, i % {RUN}), ah[i div {RUN}], (a, x) -> {join})"
    body = f"transform(sequence(0, size(st) - 1), i -> {_let('before', inside, each)})"
    return _let("st", steps, _let("bl", blocks, _let("ah", ahead, body)))


def _matches(kind: str) -> Column:
    pattern, cheap, _, _ = KINDS[kind]
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    test = F.contains(F.col("text"), F.lit(cheap)) if cheap else F.col("text").rlike(_TESTS[kind])
    return F.when(test, found).otherwise(F.array().cast("array<string>"))


def _spans(kind: str, order: int) -> Column:
    """Confirmed matches with their places: array of (k, kind, s, e, v, score)."""
    m, g = f"m_{kind}", f"g_{kind}"
    _, _, base, words = KINDS[kind]
    steps = f"zip_with(slice({g}, 1, size({m})), {m}, (x, y) -> x + char_length(y))"
    starts = _running(steps, f"int(before + {g}[i])", "int(a + x)")
    # What stands before and after s, from the pieces around it: substr on the text would walk to s from its start.
    lead = f"substr(concat('', get(pc, s div {PIECE} - 1), coalesce(get(pc, s div {PIECE}), '')), 1, {PIECE} + s % {PIECE})"
    lead = f"if(s < {PIECE}, substr(coalesce(get(pc, 0), ''), 1, s), {lead})"
    near = f"lower(right({lead}, {CONTEXT})) rlike r'{words}'"
    after = f"substr(concat(get(pc, s div {PIECE}), coalesce(get(pc, s div {PIECE} + 1), '')), s % {PIECE} + 1, 44)"
    span = (f"named_struct('k', {order}, 'kind', '{kind}', 's', s, 'e', s + char_length(v), 'v', v, "
            f"'score', {base} + if({near}, {CONTEXT_BONUS}, 0))")
    if kind == "iban":
        # Of what begins at a match, the longest part that holds; parts that begin inside an earlier one go.
        kinds = "array<struct<k:int,kind:string,s:int,e:int,v:string,score:int>>"
        parts = (f"transform(array(if(char_length({m}[i]) > 4, {m}[i], regexp_extract({after}, r'{_GROUPS}', 0))), "
                 f"r -> concat(array(r), transform(filter(array(7, 6, 5, 4, 3, 2), n -> char_length({m}[i]) = 4 and "
                 f"4 + 5 * n < char_length(r)), n -> substr(r, 1, 4 + 5 * n))))[0]")
        best = f"transform(slice(filter({parts}, v -> {_VALID[kind]}), 1, 1), v -> {span})"
        found = f"flatten(transform(sequence(0, size({m}) - 1), i -> {_let('s', 'p[i]', best)}))"
        meet = "exists(sequence(1, greatest(size(f) - 1, 1)), i -> coalesce(get(f, i - 1).e > get(f, i).s, false))"
        apart = (f"if({meet}, aggregate(f, cast(array() as {kinds}), (a, x) -> "
                 f"if(size(a) > 0 and get(a, size(a) - 1).e > x.s, a, concat(a, array(x)))), f)")
        return F.expr(f"if(size({m}) = 0, cast(array() as {kinds}), {_let('p', starts, _let('f', found, apart))})")
    valid = f"filter(sequence(0, size({m}) - 1), i -> {_let('v', f'{m}[i]', _VALID[kind])})"
    spans = f"transform({valid}, i -> {_let('v', f'{m}[i]', _let('s', 'p[i]', span))})"
    return F.expr(
        f"if(size({m}) = 0, cast(array() as array<struct<k:int,kind:string,s:int,e:int,v:string,score:int>>), "
        f"{_let('p', starts, spans)})")


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input as column ``row``, its ``text`` (null as empty) and ``base`` and
    ``added``: arrays of spans (k, kind, s, e, v, score) by kind, then place."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    d = d.select("*", *[_matches(k).alias(f"m_{k}") for k in KINDS])
    gaps = [F.when(F.size(f"m_{k}") > 0, F.transform(F.split("text", KINDS[k][0], -1), lambda x: F.char_length(x)))
            .alias(f"g_{k}") for k in KINDS]
    hit = F.greatest(*[F.size(f"m_{k}") for k in KINDS]) > 0
    d = d.select("*", *gaps, F.when(hit, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("pc"))
    d = d.select("row", "text", *[_spans(k, i).alias(f"s_{k}") for i, k in enumerate(KINDS)])
    d = d.withColumn("base", F.concat(*[F.col(f"s_{k}") for k in BASE]))
    # A local number overlaps a base span if, of the base spans that begin before its end, the farthest
    # reaches beyond its start: a running maximum over base starts and local ends in one order.
    marks = ("array_sort(concat(transform(base, x -> named_struct('at', x.s, 'own', 1, 'e', x.e, 'i', -1)), "
             f"transform(sequence(0, size(loc) - 1), j -> named_struct('at', loc[j].e, 'own', 0, 'e', 0, 'i', j))))")
    clear = _let("mk", marks, "filter(" + _running(
        "transform(mk, x -> x.e)", "if(mk[i].own = 0 and before <= loc[mk[i].i].s, mk[i].i, -1)", "int(greatest(a, x))")
        + ", j -> j >= 0)")
    local = _let("loc", f"filter(s_phone_local, x -> x.score >= {ACCEPT})",
                 f"if(size(loc) = 0 or size(base) = 0, loc, transform(array_sort({clear}), j -> loc[j]))")
    return d.select("row", "text", "base", F.concat(F.filter("s_iban", lambda x: x["score"] >= ACCEPT), F.expr(local)).alias("added"))


def joined(spans: Column, score: bool = False) -> Column:
    """kind:start:end (with ``score``, :score too), comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["s"], x["e"], *([x["score"]] if score else []))), ",")


def masked(spans: DataFrame) -> DataFrame:
    """Adds ``masked_text`` to a frame of ``find_spans``: every span replaced by
    its kind in brackets, of overlapping ones the first."""
    cut = F.expr("""
        aggregate(array_sort(transform(concat(base, added), x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind))),
          named_struct('at', 0, 'out', ''),
          (a, x) -> if(x.s < a.at, a, named_struct('at', x.e, 'out',
             concat(a.out, substr(text, a.at + 1, x.s - a.at), '[', x.kind, ']'))),
          a -> concat(a.out, substr(text, a.at + 1)))""")
    return spans.withColumn("masked_text", cut)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts by kind, the digest of the base spans, all spans and
    their scores."""
    d = find_spans(docs, text_col)
    every = F.concat("base", "added")
    count = lambda k: F.size(F.filter(every, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return d.select(F.col(f"row.`{id_col}`").alias(id_col), *[count(k) for k in KINDS],
                    F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"),
                    joined(every, True).alias("scored_spans"))
