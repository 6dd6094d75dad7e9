"""Cleaning of place attributes as Column expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Word groups (canonical word first) and word lists of the cleaning rules.
STREET_WORDS = [("corner", "cnr"), ("street", "str"), ("road", "rd"), ("avenue", "av", "ave"), ("highway", "hwy"), ("floor", "fl", "flr"), ("boulevard", "blvd", "blv"), ("center", "centre"), ("drive", "dr"), ("ste", "suite"), ("square", "sq")]
NAME_WORDS = [("street", "str"), ("road", "rd"), ("mount", "mt"), ("saint", "st"), ("floor", "fl", "flr"), ("boulevard", "blvd", "blv"), ("centre", "center"), ("doctor", "dr"), ("suite", "ste"), ("motor", "motors"), ("highway", "hwy")]
STOP_WORDS = ["the", "of", "an", "and", "at", "no", "by", "in", "co", "for", "inc", "llc", "llp", "ltd", "on", "to", "as", "is"]
EMAIL_WORDS = [
    "info", "gmail", "admin", "customercare", "office", "reservations", "customerservices", "enquiries", "marketing", "visit", "bookings", "tourism", "events", "yahoo", "sales", "bookings",
    "customerservice", "sales", "customerrvices", "webmail", "hello", "contact", "hotmail", "support", "stay", "tourism", "mweb",
]
SYMBOLS = "\",:;'/-+&()!#$%*.|\\@`~^<>?[]{}_=\n"
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content"]
# Page names taken out of addresses, domain endings besides the countries', and endings in use that the standard list of countries lacks.
PAGES = r"home.html|index.html|home.shtml|index.shtml|.html|.shtml|\.com"
ENDINGS = ["asia", "edu", "gov", "jobs", "org"]
OTHER_COUNTRIES = ["ac", "an", "eu", "su", "tp", "uk"]


@cache
def url_parts() -> str:
    """The pattern of page names and domain endings; country codes come from the standard list that Java carries."""
    codes = [c.lower() for c in SparkContext._active_spark_context._jvm.java.util.Locale.getISOCountries()]
    return PAGES + "".join(rf"|\.{e}" for e in sorted({*codes, *OTHER_COUNTRIES, *ENDINGS}))


@cache
def _latin() -> tuple[str, str]:
    """Accented Latin letters and their base letters, from Unicode's decompositions."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if b.isascii() and b.isalpha()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(c: Column) -> Column:
    """Latin letters without their accents; the sharp s and ligatures by two letters."""
    for a, b in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L"), ("đ", "d"), ("Đ", "D")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.translate(c, *_latin())


def clean_text(c: Column) -> Column:
    """ASCII-folded, lower case, without a trailing ".0", symbols as blanks, blanks collapsed and trimmed."""
    c = F.regexp_replace(F.lower(fold(c)), r"\.0$", "")
    return F.trim(F.regexp_replace(F.translate(c, SYMBOLS, " " * len(SYMBOLS)), " +", " "))


def unique_tokens(c: Column) -> Column:
    """White-space tokens, each once, in order of first occurrence."""
    return F.array_join(F.filter(F.array_distinct(F.split(F.trim(c), r"\s+")), lambda x: x != ""), " ")


def _steps(c: Column, steps: list[tuple[int, str, str]]) -> Column:
    """Applies (where, word, replacement) in order: 0 in the middle, 1 at the start, 2 at the end.

    With a replacement, a hit at the start or end changes every place where the word is
    followed or preceded by a blank, as the rules ask; without one only that place is cut.
    """
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w"), F.lit(r).alias("r")) for k, w, r in steps])

    def step(acc: Column, x: Column) -> Column:
        w, r = x["w"], x["r"]
        head, tail = F.concat(w, F.lit(" ")), F.concat(F.lit(" "), w)
        return (
            F.when(x["k"] == 0, F.replace(acc, F.concat(tail, F.lit(" ")), F.when(r == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), r, F.lit(" ")))))
            .when((x["k"] == 1) & F.startswith(acc, head), F.when(r == "", F.substr(acc, F.length(head) + 1)).otherwise(F.replace(acc, head, F.concat(r, F.lit(" ")))))
            .when((x["k"] == 2) & F.endswith(acc, tail), F.when(r == "", F.substr(acc, F.lit(1), F.length(acc) - F.length(tail))).otherwise(F.replace(acc, tail, F.concat(F.lit(" "), r))))
            .otherwise(acc)
        )

    return F.aggregate(table, c, step)


def _swap(c: Column, groups: list[tuple[str, ...]]) -> Column:
    return _steps(c, [(k, w, g[0]) for g in groups for w in g[1:] for k in (0, 1, 2)])


def clean_streets(c: Column) -> Column:
    return _swap(c, STREET_WORDS)


def clean_name(c: Column) -> Column:
    return _swap(c, NAME_WORDS)


def remove_words(c: Column, words: list[str] = STOP_WORDS) -> Column:
    return _steps(c, [(k, w, "") for w in words for k in (0, 1, 2)])


def clean_email(c: Column) -> Column:
    return F.regexp_replace(remove_words(c, EMAIL_WORDS), r"\d+", " ")


def canonical_url(c: Column) -> Column:
    """Without tracking parameters, scheme, "www.", final slash, page names and domain endings."""
    c = F.regexp_replace(F.trim(c), "[?&](?:" + "|".join(TRACKING) + ")=[^&#]*", "")
    c = F.regexp_replace(F.regexp_replace(c, "^(?i:http://)", ""), "^(?i:https://)", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"^www\.", ""), "/$", ""), url_parts(), "")


def strip_brackets(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\[\]]+|[\[\]]+$", "")


def parse_list(c: Column) -> Column:
    """A list literal such as ``[a, "b"]`` as an array, in lower case; never evaluated."""
    return F.split(F.lower(F.regexp_replace(c, r'[\[\]"\\]', "")), ", ")


def parse_doubles(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.regexp_replace(c, r"[\[\] ]", ""), ","), lambda x: x.try_cast("double")), lambda x: x.isNotNull())


def combine_categories(*lists: Column) -> Column:
    """One list of all, each once, without empty and "unspecified" entries."""
    return F.filter(F.array_distinct(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])), lambda x: (x != "") & (x != "unspecified"))


def latin_select(values: Column, scripts: Column) -> Column:
    """Elements whose script is "latn"; all of them if none is."""
    kept = F.transform(F.filter(F.arrays_zip(values.alias("v"), scripts.alias("s")), lambda x: x["s"] == "latn"), lambda x: x["v"])
    return F.when(F.size(kept) > 0, kept).otherwise(values)


def extract_digits(c: Column) -> Column:
    """The last ten digits, zero-padded on the left."""
    return F.lpad(F.right(F.regexp_replace(c, r"\D", ""), F.lit(10)), 10, "0")


def process_phone(c: Column, compat: bool = False) -> Column:
    """Ten-digit numbers of a comma-separated list; "[]" is no number, and so is null unless ``compat``."""
    none = F.array(F.lit("0000000000")) if compat else F.array().cast("array<string>")
    return F.when(c.isNull(), none).when(c == "[]", F.array().cast("array<string>")).otherwise(F.transform(F.split(c, ","), extract_digits))


def first_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit(""))


def brands_text(c: Column) -> Column:
    return F.array_join(F.array_distinct(c), " ")


def blank_to_null(c: Column) -> Column:
    return F.when(c.rlike(r"^\s*$") | (c == "nan"), None).otherwise(c)


def drop_unspecified(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("unspecified")), None).otherwise(c)


def cell(c: Column, decimals: int) -> Column:
    """Integer grid key of a coordinate, rounded half to even."""
    return F.rint(c.cast("double") * 10**decimals).cast("int")


def embedding_text(*cols: Column) -> Column:
    """Columns joined by blanks, a null as nothing but with its blank."""
    return F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
