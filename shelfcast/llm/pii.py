"""Personal data: regular expressions propose spans, checksums confirm them, context words score them.

Everything is column expressions. A pattern's matches are taken with ``regexp_extract_all`` and
the text between them with ``split``; running sums of their lengths give exact code-point
positions, so no per-row Python is needed. Patterns use possessive repeats and boundary
look-behinds where these cannot change a match, so long digit or letter runs stay linear.

Kinds: email, ip, card (Luhn), phone - the base - and two that the method adds: iban (country length and mod-97) and
secret (a long run of letters and digits: keys, tokens). A span's score starts at its kind's value and rises when a context
word of the kind stands within ``CONTEXT`` code points of it (and before the neighbouring span). Added spans stay from
``MIN_SCORE`` on: a number that passes mod-97 has that without context, a run of characters, which may be anything, only
beside a word such as "token" or "password".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
CONTEXT_GAIN = 0.3
#: Added kinds are kept from this score on; base spans always stay.
MIN_SCORE = 0.5

# Patterns of the contract (possessive forms), lengths of the registered IBAN countries, context words.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
#: Each country's letters, then as many characters as its numbers have.
IBAN = "|".join(rf"(?:{'|'.join(c for c, n in IBAN_LENGTHS.items() if n == k)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{k - 4}}}"
                for k in sorted(set(IBAN_LENGTHS.values())))
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": IBAN,
    "secret": r"[A-Za-z0-9+/_=-]{20,}+",
}
CONTEXT_WORDS = {
    "email": "mail|e-mail|contact|write|courriel|correo",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|credit|visa|mastercard|amex|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|fax|cell|telefon|portable",
    "iban": "iban|account|bank|konto|compte|cuenta|transfer",
    "secret": "token|secret|password|passwd|passwort|key|apikey|api_key|auth|bearer|credential|credentials|clave",
}
BASE_SCORE = {"email": 0.7, "ip": 0.4, "card": 0.6, "phone": 0.5, "iban": 0.6, "secret": 0.3}
KINDS = ["email", "ip", "card", "phone", "iban", "secret"]
BASE_KINDS = KINDS[:4]
TAGS = {k: f"[{k.upper()}]" for k in KINDS}
#: A cheap test that must hold for any match.
HINT = {"email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
        "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), "phone": lambda t: F.contains(t, F.lit("+")),
        "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"), "secret": lambda t: t.rlike(r"[A-Za-z0-9+/_=-]{20}")}


def _mod97(iban: Column) -> Column:
    """First four characters to the end, letters as 10..35, remainder of 97."""
    s = F.translate(iban, " ", "")
    turned = F.concat(F.substring(s, 5, 40), F.substring(s, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        v = F.ascii(char)
        return F.when(v >= 65, (rest * 100 + v - 55) % 97).otherwise((rest * 10 + v - 48) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def confirmed(kind: str, match: Column) -> Column:
    """The checksum or range test of a kind."""
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
            F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = F.translate(match, " -", "")
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        return _mod97(match) == 1
    if kind == "secret":  # letters and digits mixed, no word and no number
        return (F.regexp_count(match, F.lit("[0-9]")) >= 4) & (F.regexp_count(match, F.lit("[A-Za-z]")) >= 4)
    return F.lit(True)


SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _located(kind: str, found: Column, between: Column) -> Column:
    """Spans of one kind: positions from running lengths, tests and scores on each match."""
    near = F.lit(rf"(?i)(?<![\p{{L}}])(?:{CONTEXT_WORDS[kind]})(?![\p{{L}}])")

    def step(acc: Column, i: Column) -> Column:
        gap, m, after = F.get(between, i), F.get(found, i), F.get(between, i + 1)
        start = acc["at"] + F.length(gap)
        end = start + F.length(m)
        gain = F.when(F.rlike(F.substring(gap, F.lit(-CONTEXT), F.lit(CONTEXT)), near)
                      | F.rlike(F.substring(after, 1, CONTEXT), near), CONTEXT_GAIN).otherwise(0.0)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                        (F.lit(BASE_SCORE[kind]) + gain).alias("score"))
        return F.struct(end.alias("at"), F.when(confirmed(kind, m), F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))
    zero = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("spans"))
    return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step, lambda a: a["spans"])


def find_pii(docs: DataFrame, text_col: str = "text", kinds=tuple(KINDS), out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: the spans (kind, start, end, score), by kind as listed, then start.

    Starts and ends are code points, end exclusive. Null and empty texts have none. Matches of one
    kind do not overlap; those of different kinds may. Failing matches are dropped and not retried.
    Rows are independent: repeated rows get equal spans, an empty table gives an empty result. A
    column named like ``out`` is replaced. Work grows with the text, memory with one text.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    rest = [c for c in docs.columns if c.lower() != out.lower()]
    work = docs.select(*rest)
    cols = {}
    for k in kinds:
        hit = HINT[k](t)
        cols[f"__found_{k}"] = F.when(hit, F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0)))
        cols[f"__between_{k}"] = F.when(hit, F.split(t, PATTERNS[k], -1))
    work = work.withColumns(cols)
    parts = [F.when(F.size(F.coalesce(F.col(f"__found_{k}"), F.array())) > 0,
                    _located(k, F.col(f"__found_{k}"), F.col(f"__between_{k}")))
             .otherwise(F.expr(f"cast(array() as array<{SPAN}>)")) for k in kinds]
    for i, k in enumerate(kinds):
        if k not in BASE_KINDS:
            parts[i] = F.filter(parts[i], lambda s: s["score"] >= MIN_SCORE)
    return work.select(*rest, F.concat(*parts).alias(out))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, digest of the base spans, all spans as text and their scores in the same order."""
    base = F.filter("pii", lambda s: s["kind"].isin(BASE_KINDS))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long")
    return found.select(F.col(id_col).alias("doc_id"), *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("pii")).alias("spans"),
                        count("iban").alias("n_iban"), count("secret").alias("n_secret"),
                        F.array_join(F.transform("pii", lambda s: F.format_string("%.1f", s["score"])), ",").alias("scores"))


def mask(found: DataFrame, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """The texts with every span replaced by its kind's tag; overlapping spans become one, with the
    tag of the first (the longer one on equal starts). Texts without spans, and nulls, are unchanged."""
    t = F.col(text_col)
    order = F.array_sort(F.transform(spans_col, lambda s: F.struct(
        s["start"].alias("a"), (-s["end"]).alias("b"), s["kind"].alias("kind"))))

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        grown = F.struct(last["a"].alias("a"), F.greatest(last["b"], -s["b"]).alias("b"), last["kind"].alias("kind"))
        fresh = F.struct(s["a"].alias("a"), (-s["b"]).alias("b"), s["kind"].alias("kind"))
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))
        return F.when((F.size(acc) > 0) & (F.coalesce(last["b"], F.lit(-1)) > s["a"]), joined).otherwise(
            F.concat(acc, F.array(fresh)))
    merged = F.aggregate(order, F.expr("cast(array() as array<struct<a:int,b:int,kind:string>>)"), merge)
    tags = F.create_map(*[F.lit(x) for kv in TAGS.items() for x in kv])

    def piece(s: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.coalesce(F.get(F.col("__merged"), i - 1)["b"], F.lit(0)))
        return F.concat(F.substring(t, start + 1, s["a"] - start), F.element_at(tags, s["kind"]))
    tail = F.substring(t, F.element_at("__merged", -1)["b"] + 1, F.length(t))
    new = F.concat(F.array_join(F.transform("__merged", piece), ""), tail)
    rest = [c for c in found.columns if c != spans_col]
    return found.withColumn("__merged", merged).select(*[
        F.when(F.size("__merged") > 0, new).otherwise(t).alias(c) if c == text_col else F.col(c) for c in rest])


# DuckDB's patterns have no possessive repeats or look-behind; these match the same.
_SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": IBAN,
    "secret": r"[A-Za-z0-9+/_=-]{20,}",
}


def _sql_kind(k: int, kind: str) -> str:
    """Matches of one kind with the text before each, in DuckDB."""
    re_ = _SQL_PATTERNS[kind]
    return f"""select doc_id, {k} as k, '{kind}' as kind, generate_subscripts(m, 1) as i, unnest(m) as m, unnest(g[1:len(m)]) as g, unnest(g[2:len(m) + 1]) as after
      from (select doc_id, regexp_extract_all(t, '{re_}') as m, regexp_split_to_array(t, '{re_}') as g from d) where len(m) > 0"""


ORACLE_SQL = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as ({" union all ".join(_sql_kind(i, k) for i, k in enumerate(KINDS))}),
p as (select *, sum(length(g) + length(m)) over (partition by doc_id, k order by i) - length(m) as b,
        regexp_replace(m, '[^0-9]', '', 'g') as digits, replace(m, ' ', '') as solid from m),
s as (select *, b + length(m) as e,
        case kind when 'email' then true
          when 'ip' then len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 or coalesce(try_cast(x as bigint), 0) > 255)) = 0
          when 'phone' then length(digits) between 9 and 15
          when 'card' then length(digits) between 13 and 19 and list_sum(list_transform(range(1, length(digits) + 1), lambda j:
            case when (length(digits) - j) % 2 = 1 then
              case when digits[j]::int * 2 > 9 then digits[j]::int * 2 - 9 else digits[j]::int * 2 end
            else digits[j]::int end)) % 10 = 0
          when 'secret' then length(digits) >= 4 and length(regexp_replace(m, '[^A-Za-z]', '', 'g')) >= 4
          else list_reduce(list_transform(string_split(solid[5:] || solid[1:4], ''),
            lambda c: case when ascii(c) >= 65 then ascii(c) - 55 else ascii(c) - 48 end),
            lambda a, v: (a * (case when v > 9 then 100 else 10 end) + v) % 97) = 1 end as ok
      from p),
r as (select *, case kind {" ".join(f"when '{k}' then {BASE_SCORE[k]}" for k in KINDS)} end
        + case when regexp_matches(right(g, {CONTEXT}), near) or regexp_matches(left(after, {CONTEXT}), near) then {CONTEXT_GAIN} else 0 end as score
      from (select *, '(?i)(?:^|[^\\p{{L}}])(?:' || case kind {" ".join(f"when '{k}' then '{w}'" for k, w in CONTEXT_WORDS.items())} end
              || ')(?:$|[^\\p{{L}}])' as near from s) where ok),
a as (select doc_id, count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
        count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone,
        count(*) filter (kind = 'iban') as n_iban, count(*) filter (kind = 'secret') as n_secret,
        string_agg(printf('%.1f', score::double), ',' order by k, i) as scores,
        string_agg(kind || ':' || b::bigint || ':' || e::bigint, ',' order by k, i) filter (k < 4) as base,
        string_agg(kind || ':' || b::bigint || ':' || e::bigint, ',' order by k, i) as spans
      from r where k < 4 or score >= {MIN_SCORE} group by doc_id)
select d.doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card,
  coalesce(n_phone, 0) as n_phone, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_iban, 0) as n_iban,
  coalesce(n_secret, 0) as n_secret, coalesce(scores, '') as scores
from d left join a using (doc_id)
"""
