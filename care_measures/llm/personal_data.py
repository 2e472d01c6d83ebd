"""Personal data in texts: regular expressions propose spans, checksums confirm them, nearby words adjust their scores.

DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from care_measures.llm.common import ROW, documents, keyed

#: Code points before and after a proposal in which context words count.
CONTEXT = 40
#: Proposals that are no base spans need this score.
THRESHOLD = 60


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """12 to 19 digits whose sum is a multiple of ten, every second one from the right doubled and its digits added."""
    reverse = F.reverse(_digits(match))
    total = F.aggregate(
        F.split(reverse, ""), F.struct(F.lit(0).alias("sum"), F.lit(1).alias("by")),
        lambda a, d: F.struct((a["sum"] + d.cast("int") * a["by"] - F.when(d.cast("int") * a["by"] > 9, 9).otherwise(0)).alias("sum"),
                              (F.lit(3) - a["by"]).alias("by")), lambda a: a["sum"])
    return F.when(F.length(reverse).between(12, 19), total % 10 == 0).otherwise(False)


def mod_97(match: Column) -> Column:
    """An account number whose first four characters, moved to its end, and letters, read as 10 to 35, leave 1 by 97."""
    number = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(number, 5, 40), F.left(number, F.lit(4)))
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97)
    return F.when(number.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), rest == 1).otherwise(False)


def _octets(match: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _phone_digits(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _issued(match: Column) -> Column:
    """Three, two and four digits; no group of zeros, and no area of 666 or above 899."""
    return match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") & ~match.rlike("^(000|666|9..)|-00-|-0000$")


def _mixed(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]")


@dataclass(frozen=True)
class Kind:
    """A proposal: its expression, a text every match has, and whether it always has a digit, the check of a match, its score in hundredths and the words
    around it that raise or lower that by 30. Base spans stay whatever their score."""

    name: str
    pattern: str
    contains: str
    confirm: Callable[[Column], Column]
    score: int
    base: bool = False
    raises: str = ""
    lowers: str = ""
    digit: bool = True


#: In order of names. Repeats are possessive, and a match starts where a run of its first characters does or where the
#: last match ended, so that a run of a million characters is read once; what is matched is what plain repeats match.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), 90, True,
         "mail|contact|write", "example", digit=False),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", _octets, 60, True, "address|host|server|from", "version|section|release"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", "", luhn, 80, True, "card|visa|credit|pay", "order|serial|isbn"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", _phone_digits, 70, True, "phone|call|tel|mobile|fax", "sum|total"),
    Kind("card", r"[0-9]{13,}+", "", luhn, 60, False, "card|visa|credit|pay", "order|serial|isbn"),
    Kind("iban", r"[A-Za-z0-9]{15,}+", "", mod_97, 80, False, "iban|account|bank|konto", ""),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [0-9]{1,3})?", " ", mod_97, 80, False, "iban|account|bank|konto", ""),
    Kind("ssn", r"[0-9]++(?:-[0-9]++)++", "-", _issued, 40, False, "ssn|social|security", "order|serial|part"),
    Kind("secret", r"[A-Za-z0-9_-]{20,}+", "", _mixed, 30, False, "token|secret|passw|api.?key|bearer", ""),
)
NAMES = tuple(dict.fromkeys(k.name for k in KINDS))


_CUT = "array<struct<at:struct<n:int,gap:int,ends:string,begins:string,match:string>,i:int>>"


def _matches(kind: Kind) -> Column:
    """The matches of a kind in a text; without its fixed text, or without a digit, a text is not searched."""
    none = F.array().cast("array<string>")
    has = F.contains(F.col("text"), F.lit(kind.contains)) if kind.contains else F.lit(True)
    has = has & F.col("digit") if kind.digit else has
    return F.when(has, F.regexp_extract_all(F.col("text"), F.lit(kind.pattern), F.lit(0))).otherwise(none)


def _cut(kind: Kind, n: int) -> Column:
    """The text at each match of a kind: (kind's number, code points of the gap before it, the end and the beginning of
    that gap, the match), and its place; the last one, after the last match, has no match. None without a match."""
    gaps = F.transform(F.split(F.col("text"), kind.pattern, -1), lambda s: F.struct(
        F.char_length(s).alias("gap"), F.right(s, F.lit(CONTEXT)).alias("ends"), F.left(s, F.lit(CONTEXT)).alias("begins")))
    rows = F.zip_with(gaps, F.col(f"m{n}"), lambda g, m: F.struct(
        F.lit(n).alias("n"), g["gap"].alias("gap"), g["ends"].alias("ends"), g["begins"].alias("begins"), m.alias("match")))
    rows = F.transform(rows, lambda x, i: F.struct(x.alias("at"), i.alias("i")))
    return F.when(F.size(f"m{n}") > 0, rows).otherwise(F.array().cast(_CUT))


def find(docs: DataFrame) -> DataFrame:
    """Spans of personal data: __row, doc_id, kind_no, kind, start, end (code points, end exclusive), match, score, base; a
    row without a span (all but the first two null) for each text, so that none is lost.

    Each expression is searched from left to right without overlaps; a match that its check does not confirm is dropped and
    not tried again. The score is the kind's, 30 more or less for words in the 40 code points on either side, no further
    than the next match of the same expression; a span that is not of a base kind needs 60. A span found twice is one.

    A null text counts as empty and has no span, as has an empty one. Rows that repeat are searched by themselves, and a
    null doc_id is kept. Other columns are not read; an empty table gives no row. The matches of one text are put in
    order in one task: as many as the text has."""
    texts = keyed(docs).withColumn("digit", F.col("text").rlike("[0-9]"))
    texts = texts.select("*", *[_matches(k).alias(f"m{n}") for n, k in enumerate(KINDS)])
    cut = texts.select(ROW, "doc_id", F.concat(F.array(F.lit(None)).cast(_CUT), *[_cut(k, n) for n, k in enumerate(KINDS)]).alias("found"))
    rows = cut.select(ROW, "doc_id", F.explode_outer("found").alias("x")).select(ROW, "doc_id", "x.i", "x.at.*").repartition(ROW)
    matches = Window.partitionBy(ROW, "n").orderBy("i")
    size = F.coalesce(F.char_length("match"), F.lit(0))
    placed = rows.withColumns({"end": F.sum(F.col("gap") + size).over(matches), "after": F.lead("begins").over(matches)})
    placed = placed.filter(F.col("n").isNull() | F.col("match").isNotNull()).withColumn("start", F.col("end") - size)

    def of(value: Callable[[Kind], Column], otherwise: Column) -> Column:
        out = F
        for n, k in enumerate(KINDS):
            out = out.when(F.col("n") == n, value(k))
        return out.otherwise(otherwise)

    context = F.lower(F.concat_ws(" ", "ends", "after"))
    word = lambda words: F.when(context.rlike(words), 30).otherwise(0) if words else F.lit(0)
    scored = placed.withColumns({
        "sure": of(lambda k: k.confirm(F.col("match")), F.lit(True)),
        "score": of(lambda k: F.lit(k.score) + word(k.raises) - word(k.lowers), F.lit(None).cast("int")),
        "base": of(lambda k: F.lit(k.base), F.lit(None).cast("boolean")),
        "kind": of(lambda k: F.lit(k.name), F.lit(None).cast("string")),
        "kind_no": of(lambda k: F.lit(NAMES.index(k.name)), F.lit(None).cast("int"))})
    scored = scored.filter("sure AND (n IS NULL OR base OR score >= " + str(THRESHOLD) + ")")
    return scored.groupBy(ROW, "kind_no", "start", "end").agg(
        F.first("doc_id").alias("doc_id"), F.first("kind").alias("kind"), F.first("match").alias("match"),
        F.max("score").alias("score"), F.bool_or("base").alias("base")).select(
            ROW, "doc_id", "kind_no", "kind", "start", "end", "match", "score", "base")


def summary(spans: DataFrame) -> DataFrame:
    """One row per text: __row, doc_id, the number of base spans of each kind, base_sha256, spans (kind:start:end by start,
    then kind, then end) and scores (in the order of spans)."""
    listed = F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("start", "kind_no", "end", "kind", "score", "base"))))
    name = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    found = spans.groupBy(ROW).agg(F.first("doc_id").alias("doc_id"), listed.alias("found"), *[
        F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in NAMES[:4]])
    return found.select(
        ROW, "doc_id", *[f"n_{k}" for k in NAMES[:4]],
        F.sha2(F.array_join(F.transform(F.filter("found", lambda x: x["base"]), name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", name), ",").alias("spans"),
        F.array_join(F.transform("found", lambda x: x["score"].cast("string")), ",").alias("scores"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(find(documents(spark, sf_dir))).drop(ROW)


def _sql() -> str:
    """The same in SQL, with plain repeats: proposals are cut and numbered by unnest, places summed by a window."""
    kinds = (  # name, expression, check, score, base, raises, lowers
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true", 90, "true", "mail|contact|write", "example"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda o: o::HUGEINT)) <= 255", 60, "true",
         "address|host|server|from", "version|section|release"),
        ("card", r"[0-9]([\x20-]?[0-9])+", "luhn", 80, "true", "card|visa|credit|pay", "order|serial|isbn"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 9 AND 15", 70, "true",
         "phone|call|tel|mobile|fax", "sum|total"),
        ("card", r"[0-9]{13,}", "luhn", 60, "false", "card|visa|credit|pay", "order|serial|isbn"),
        ("iban", r"[A-Za-z0-9]{15,}", "mod97", 80, "false", "iban|account|bank|konto", "^$"),
        ("iban", r"[A-Z]{2}[0-9]{2}( [A-Z0-9]{4}){2,7}( [0-9]{1,3})?", "mod97", 80, "false", "iban|account|bank|konto", "^$"),
        ("ssn", r"[0-9]+(-[0-9]+)+", "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND m[:3] NOT IN ('000', '666') AND m[1] <> '9' "
         "AND m[5:6] <> '00' AND m[8:] <> '0000'", 40, "false", "ssn|social|security", "order|serial|part"),
        ("secret", r"[A-Za-z0-9_-]{20,}", "regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')", 30, "false",
         "token|secret|passw|api.?key|bearer", "^$"),
    )
    luhn_sql = """length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i:
        CASE WHEN (length(d) - i) % 2 = 0 THEN d[i]::INT WHEN d[i]::INT > 4 THEN 2 * d[i]::INT - 9 ELSE 2 * d[i]::INT END)) % 10 = 0"""
    mod_sql = """regexp_full_match(b, '[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}') AND list_reduce(list_prepend(0, list_transform(
        string_split(b[5:] || b[:4], ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE ascii(c) - 55 END)),
        lambda a, v: (a * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97) = 1"""
    parts = [f"""SELECT r, doc_id, {n} AS n, {NAMES.index(name)} AS kind_no, '{name}' AS kind, {base} AS base, i, g, m, {score} AS prior, '{up}' AS up, '{down}' AS down
        FROM (SELECT r, doc_id, unnest(regexp_extract_all(t, '{rx}')) AS m, unnest(string_split_regex(t, '{rx}')) AS g,
              generate_subscripts(string_split_regex(t, '{rx}'), 1) AS i FROM d WHERE regexp_matches(t, '{rx}'))"""
             for n, (name, rx, _, score, base, up, down) in enumerate(kinds)]
    check = " ".join(f"WHEN {n} THEN {dict(luhn='luhn', mod97='mod97').get(c, c)}" for n, (_, _, c, *_) in enumerate(kinds))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS ({' UNION ALL '.join(parts)}),
placed AS (SELECT *, sum(length(g) + coalesce(length(m), 0)) OVER w AS stop, lower(right(g, {CONTEXT}) || ' ' || left(lead(g) OVER w, {CONTEXT})) AS near,
    regexp_replace(m, '[^0-9]', '', 'g') AS d, replace(m, ' ', '') AS b FROM cut WINDOW w AS (PARTITION BY r, n ORDER BY i)),
checked AS (SELECT *, CASE WHEN n IN (2, 4) THEN {luhn_sql} END AS luhn, CASE WHEN n IN (5, 6) THEN {mod_sql} END AS mod97 FROM placed WHERE m IS NOT NULL),
sure AS (SELECT r, kind_no, kind, base, stop - length(m) AS start, stop,
    prior + 30 * regexp_matches(near, up)::INT - 30 * regexp_matches(near, down)::INT AS score FROM checked WHERE CASE n {check} END),
one AS (SELECT r, kind_no, kind, start, stop, max(score) AS score, bool_or(base) AS base FROM sure WHERE base OR score >= {THRESHOLD} GROUP BY ALL),
said AS (SELECT r, {', '.join(f"count(*) FILTER (base AND kind = '{k}') AS n_{k}" for k in NAMES[:4])},
    string_agg(concat_ws(':', kind, start::BIGINT, stop::BIGINT), ',' ORDER BY start, kind_no, stop) FILTER (base) AS base_spans,
    string_agg(concat_ws(':', kind, start::BIGINT, stop::BIGINT), ',' ORDER BY start, kind_no, stop) AS spans,
    string_agg(score::VARCHAR, ',' ORDER BY start, kind_no, stop) AS scores FROM one GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in NAMES[:4])}, sha256(coalesce(base_spans, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM d LEFT JOIN said USING (r)
"""


SQL = _sql()
