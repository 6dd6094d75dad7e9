"""Personal data by patterns, checksums and context, in native DataFrame expressions only.

Patterns propose spans. Luhn confirms card numbers, mod-97 confirms bank account numbers,
ranges and digit counts confirm addresses and phone numbers; what fails is dropped and not
tried again at another place. Words near a span raise its score. Everything is row-local:
no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Possessive loops and the lookbehinds keep the patterns linear on long runs; they match
#: what the plain greedy patterns match, leftmost and without overlaps.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
}
BASE = ("email", "ip", "card", "phone")
#: A cheap test that a text may hold the pattern.
GUARDS = {"email": "instr(text, '@') > 0", "ip": r"text rlike '[0-9]\\.[0-9]'", "card": "text rlike '[0-9][ -]?[0-9]'", "phone": "instr(text, '+') > 0", "iban": "text rlike '[A-Z]{2}[0-9]{2}'"}
CONTEXT = {"email": "mail|contact|write|reach", "ip": "ip|host|server|address", "card": "card|visa|credit|pay", "phone": "phone|call|tel|mobile|fax", "iban": "iban|account|bank|transfer"}
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.8}
NEAR = 40
RUN = 64


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    d = F.reverse(_digits(s))
    values = F.transform(F.split(d, ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.length(d).between(13, 19) & (F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0)


def _mod97(s: Column) -> Column:
    flat = F.regexp_replace(s, " ", "")
    turned = F.split(F.concat(F.substring(flat, 5, 40), F.substring(flat, 1, 4)), "")

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(c == "", rest).otherwise((rest * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.length(flat).between(15, 34) & (F.aggregate(turned, F.lit(0), step) == 1)


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return {"card": _luhn, "iban": _mod97}.get(kind, lambda s: F.lit(True))(s)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _places(kind: str) -> Column:
    """All matches as (s, e, m): code points, end exclusive, and the matched text.

    Places are summed up in runs of ``RUN`` matches, so that no long array is copied for every match.
    """
    pattern = _literal(PATTERNS[kind])
    spot = "struct<s:int,e:int,m:string>"
    found = f"regexp_extract_all(text, {pattern}, 0)"
    run = f"""aggregate(slice(z, b * {RUN} + 1, {RUN}), struct(o.at as at, cast(array() as array<{spot}>) as found),
                (acc, x) -> struct(acc.at + x.gap + length(x.m) as at,
                                   array_append(acc.found, struct(acc.at + x.gap as s, acc.at + x.gap + length(x.m) as e, x.m as m)) as found))"""
    return F.expr(
        f"""case when {GUARDS[kind]} then transform(
              array(zip_with(slice(transform(split(text, {pattern}, -1), x -> length(x)), 1, size({found})), {found}, (gap, m) -> struct(gap, m))),
              z -> aggregate(sequence(0, cast((size(z) - 1) / {RUN} as int)), struct(0 as at, cast(array() as array<array<{spot}>>) as runs),
                (o, b) -> transform(array({run}), r -> struct(r.at as at, array_append(o.runs, r.found) as runs))[0],
                o -> flatten(o.runs)))[0]
            else cast(array() as array<{spot}>) end"""
    )


def _spans(kinds: tuple[str, ...]) -> Column:
    """The spans of the column ``text``: kind, start, end, score."""
    near = lambda x: F.lower(F.concat(F.substring(F.col("text"), F.greatest(x["s"] - NEAR, F.lit(0)) + 1, F.least(x["s"], F.lit(NEAR))), F.substring(F.col("text"), x["e"] + 1, F.lit(NEAR))))

    def found(kind: str) -> Column:
        kept = F.filter(_places(kind), lambda x: _valid(kind, x["m"]))
        score = lambda x: F.when(near(x).rlike(CONTEXT[kind]), PRIOR[kind] + 0.2).otherwise(PRIOR[kind])
        return F.transform(kept, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("start"), x["e"].alias("end"), score(x).alias("score")))

    return F.when(F.col("text").isNull(), F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:double>>)")).otherwise(F.concat(*map(found, kinds)))


def spans(docs: DataFrame, kinds: tuple[str, ...] = tuple(PATTERNS)) -> DataFrame:
    """``docs`` with a column ``spans``: kind, start, end, score of each span, by kind as listed, then start.

    A null text has none. A column named ``spans`` is replaced.
    """
    return docs.withColumn("spans", _spans(kinds))


def _joined(of: Column) -> Column:
    return F.array_join(F.transform(of, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base spans' counts and SHA-256, all spans, and their mean score (null: no spans).

    One row for every row of ``docs``, repeats and null doc_ids included; null and empty
    texts have no spans; an empty table gives no rows; other columns are ignored. A text of
    n characters with m matches costs n + m * m / ``RUN`` squared steps at most.
    """
    rows = spans(docs.select("doc_id", "text")).select("doc_id", "spans")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    total = F.aggregate("spans", F.lit(0.0), lambda a, x: a + x["score"])
    return rows.select("doc_id", *map(count, BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), F.when(F.size("spans") > 0, F.round(total / F.size("spans"), 6)).alias("mean_score"))


def mask(docs: DataFrame, least_score: float = 0.0) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans give one mask.

    The same columns in the same order, whatever their names; ``n_chars``, if there, is the
    new length. Null stays null; of spans that begin at one place the longest gives the mask.
    """
    name = "spans"
    while name in docs.columns:
        name = f"_{name}"
    ordered = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"])
    rows = docs.withColumn(name, F.array_sort(F.filter(_spans(tuple(PATTERNS)), lambda x: x["score"] >= least_score), ordered))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"])
        return F.when(x["start"] < acc["at"], F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(x["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("out"))
        )

    masked = F.aggregate(name, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    rows = rows.withColumn("text", F.when(F.size(name) > 0, masked).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return rows.select(*docs.columns)
