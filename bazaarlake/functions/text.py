"""Text clean-up expressions. All built from JVM functions with code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A marker that cannot be typed, followed by the space that makes initcap start a new word.
_WORD_BREAK = "\u0001 "

# Title-cased contraction endings and how they are written.
CONTRACTIONS = [
    ("'T", "'t"),
    ("'S", "'s"),
    ("'D", "'d"),
    ("'M", "'m"),
    ("'Ll", "'ll"),
]

# Product ids that stand for "no product".
PLACEHOLDER_IDS = ["N/A", "NA", "UNKNOWN", "NULL", "INVALID", "NOT APPLICABLE"]


def title_case(text: Column) -> Column:
    """Capital after every non-alphanumeric character, lower case elsewhere ("O'Brien").

    ``initcap`` alone starts words only after a space, so a break is put after every other
    separator and taken out again.
    """
    broken = F.regexp_replace(F.lower(text), r"([^\p{L}\p{N}])", "$1" + _WORD_BREAK)
    return F.replace(F.initcap(broken), F.lit(_WORD_BREAK), F.lit(""))


def repair_contractions(text: Column) -> Column:
    for wrong, right in CONTRACTIONS:
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def present(text: Column) -> Column:
    """True when there is something besides spaces."""
    return text.isNotNull() & (F.trim(text) != "")


def known(text: Column) -> Column:
    """Trimmed text, NULL when blank or "nan" in any case."""
    trimmed = F.trim(text)
    return F.when((trimmed != "") & (F.lower(trimmed) != "nan"), trimmed)


def title_or_unknown(text: Column) -> Column:
    return F.coalesce(title_case(known(text)), F.lit("Unknown"))


def text_or_unknown(text: Column, default: str = "Unknown") -> Column:
    return F.coalesce(known(text), F.lit(default))


def lower_or_unknown(text: Column) -> Column:
    return F.coalesce(F.lower(known(text)), F.lit("unknown"))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def digits_int(text: Column) -> Column:
    """All digits of the text as an integer; NULL when there are none."""
    return digits(text).try_cast("int")


def discount_fraction(text: Column) -> Column:
    """"10%%", "20pct", "1" -> 0.10, 0.20, 0.01; no number -> 0."""
    number = F.regexp_replace(text, r"[^0-9.]+", "").try_cast("decimal(18,4)")
    percent = (number * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,6)")
    return F.coalesce(percent, F.lit(0).cast("decimal(20,6)"))


def phone_dashed(text: Column) -> Column:
    """Digits as ddd-ddd-d+; six or fewer digits stay as they are."""
    dashed = F.regexp_replace(digits(text), r"(\d{3})(\d{3})(\d+)", "$1-$2-$3")
    return F.when(present(text), F.btrim(dashed, F.lit("-"))).otherwise(F.lit("Unknown"))


def stamp_text(timestamp: Column) -> Column:
    """Timestamp as yyyy-MM-dd HH:mm:ss, '' when missing: the form used inside business keys."""
    return F.coalesce(F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def key_part(text: Column) -> Column:
    """Lower-cased trimmed text, '' when missing, so a key never becomes NULL."""
    return F.coalesce(F.lower(F.trim(text)), F.lit(""))


def business_key(*parts: Column) -> Column:
    return F.md5(F.concat_ws("_", *parts))


def attribute_hash(*columns: Column) -> Column:
    return F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def label(separator: str, *parts: Column) -> Column:
    """Join the non-missing parts; a missing part leaves its separator in place."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(separator))
        pieces.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.concat(*pieces)
