"""Scalar rules on cell and header text, as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# These word lists and patterns decide results.
MISSING = ("n/a", "na", "null", "nan", "none", "missing", "unknown")
DASHES = ("-", "--", "---")
CONTINUATION = "המשך"
TABLE_MARK = "לוח"
YEAR_WORDS = ("ממוצע [0-9]{4}", "סוף [0-9]{4}", "[0-9]{4}")
SYNONYMS = (("ושיעור", "ואחוז"), (r"(?U)\s+", " "), ("־", "-"))
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = " \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"  # Unicode's Zs: no tabs, no line ends
POINTS = "[֑-ׇ]"
NAME_MARKS = "״\"׳'\\-*()"
HEBREW = "[֐-׿]"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE))


def squeeze(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def is_missing(text: Column) -> Column:
    return F.coalesce(F.lower(strip(text)).isin("", *MISSING), F.lit(True))


def is_numeric(text: Column, stripped: bool = False) -> Column:
    """Decimals and grouped numbers by their beginning, whole numbers but digits and years, dashes."""
    bare = text if stripped else strip(text)
    whole = F.when(bare.rlike("^[0-9]+$"), F.regexp_replace(bare, "^0+(?=[0-9])", ""))
    ordinary = ~((F.length(whole) == 1) | ((F.length(whole) == 4) & whole.between("1900", "2030")))
    return F.coalesce(bare.rlike(r"^[0-9]+\.[0-9]+") | bare.rlike(r"^[0-9]{1,3}(,[0-9]{3})+") | bare.isin(*DASHES) | F.coalesce(ordinary, F.lit(False)), F.lit(False))


def strip_stars(text: Column, trailing_only: bool = False) -> Column:
    return F.regexp_replace(text, r"\*+$", "") if trailing_only else F.replace(text, F.lit("*"), F.lit(""))


@F.pandas_udf(StringType())
def compose(text: pd.Series) -> pd.Series:
    """Unicode composition, which has no built-in function."""
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def clean_header(text: Column, nfc: bool = True) -> Column:
    """A header without points, years, continuation and table marks. nfc: compose first (the only Python step); without it,
    a header in decomposed letters never equals the same one composed."""
    out = F.regexp_replace(compose(text) if nfc else text, POINTS, "")
    for pattern, instead in SYNONYMS:
        out = F.regexp_replace(out, pattern, instead)
    for pattern in (*YEAR_WORDS, rf"\({CONTINUATION}\)", rf"(?U){TABLE_MARK}:\s*[0-9]+\.[0-9]+"):
        out = F.regexp_replace(out, pattern, "")
    return squeeze(out)


def clean_text(text: Column, most: int = 200) -> Column:
    """A name without year ranges and table numbers, at most `most` characters, never empty."""
    out = F.regexp_replace(F.regexp_replace(text, "[0-9]{4}-[0-9]{4}", ""), rf"(?U){TABLE_MARK}\s+[0-9]+\.?[0-9]*", "")
    return F.coalesce(F.nullif(F.substring(squeeze(out), 1, most), F.lit("")), F.lit("unnamed"))


def plain_text(text: Column) -> Column:
    """Without the punctuation of names, with single spaces; what stood around a mark closes up."""
    return squeeze(F.regexp_replace(text, f"[{NAME_MARKS}]", ""))


def percent_text(share: Column, digits: int = 1) -> Column:
    """12.5 -> 12.5%"""
    return F.format_string(f"%.{digits}f%%", share.cast("double"))


def looks_repetitive(text: Column) -> Column:
    return (F.length(text) > 200) & (F.instr(F.substr(text, F.lit(51)), F.substring(text, 1, 50)) > 0)


def is_hebrew(text: Column) -> Column:
    return F.coalesce(text.rlike(HEBREW), F.lit(False))


def is_year(text: Column, first: int = 1900, last: int = 2024) -> Column:
    return F.coalesce(strip(text).try_cast("double").between(first, last), F.lit(False))


def edit_similarity(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(0.0)


def json_array(text: Column) -> Column:
    """From the first [ to the last ] of noisy text, fences and remarks around it dropped; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\[.*\]", 0), F.lit(""))


def json_object(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def text_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def sanitize_name(name: Column) -> Column:
    return F.translate(name, "- ", "__")


def truncate(text: Column, most: int, mark: str = "...") -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - len(mark)), F.lit(mark))).otherwise(text)


def representative_header(first: Column, second: Column) -> Column:
    """The first three distinct lines that are not blank, or the beginning of the text."""
    text = F.coalesce(F.nullif(first, F.lit("")), second, F.lit(""))
    bare = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)))  # a function of two arguments would get the line's place
    lines = F.slice(F.array_distinct(F.filter(bare, lambda x: x != "")), 1, 3)
    return F.when(F.size(lines) > 0, F.concat_ws(" | ", lines)).otherwise(F.substring(text, 1, 200))


def filename_key(name: Column) -> Column:
    """2023_03__04.png -> 4_3_2023: year, chapter and serial without empty parts and leading zeros."""
    parts = F.filter(F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "_"), lambda x: x != "")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("int").cast("string")
    return F.concat_ws("_", number(2), number(1), number(0))


# Buckets and decisions -------------------------------------------------------


def similarity_colour(sim: Column) -> Column:
    return F.when(sim >= 0.97, "green").when(sim >= 0.90, "amber").when(sim >= 0.85, "orange").otherwise("red")


def confidence(sim: Column, high: float = 0.97) -> Column:
    return F.when(sim >= high, "confident").otherwise("uncertain")


def match_class(score: Column, high: float = 0.85, medium: float = 0.5) -> Column:
    return F.when(score >= high, "high").when(score >= medium, "medium")


def default_judge(sim: Column) -> Column:
    """struct<decision, confidence> of the deterministic pair judge."""
    decision = F.when(sim >= 0.92, "accept").when(sim >= 0.88, "uncertain").otherwise("reject")
    return F.struct(decision.alias("decision"), F.when(sim >= 0.92, 0.9).when(sim >= 0.88, 0.6).otherwise(0.8).alias("confidence"))


def judge_action(decision: Column, sure: Column, least: float = 0.7) -> Column:
    return F.when((decision == "accept") & (sure >= least), "accept").when((decision == "reject") & (sure >= least), "reject").otherwise("manual")


def split_kind(targets: Column) -> Column:
    return F.when(targets == 2, "even_split").when(targets > 2, "fragmentation")


def model_order(rows: Column, limit: int = 30) -> Column:
    return F.when(rows > limit, "large").otherwise("small")


def year_route(year: Column) -> Column:
    """Which reader a year's documents need."""
    return F.when(year.isin(2017, 2018, 2020), "by_model").when(year.between(2001, 2016), "marked_tables").when(year.between(2019, 2024), "block_order").otherwise("invalid")


def known_year(year: Column, first: int = 2001, last: int = 2024) -> Column:
    """Whether the documents of a year can be read."""
    return year.between(first, last)
