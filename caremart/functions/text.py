"""Text clean-up, pseudonyms, codes and label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens that mean "missing" when a delimited file is read.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The characters that count as white space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Age band labels with the first age that no longer belongs to the band.
AGE_BANDS = (("0-5 ans", 6), ("6-15 ans", 16), ("16-30 ans", 31), ("31-60 ans", 61))
AGE_BAND_ABOVE = "60 ans et +"
AGE_BAND_UNKNOWN = "Inconnu"

# Severity label by highest urgency level.
SEVERITY_CLASSES = (("Faible", 2), ("Modérée", 3))
SEVERITY_ABOVE = "Critique"


def as_missing(col: Column) -> Column:
    """NULL for the missing-value tokens of a delimited file; other text unchanged."""
    return F.when(~col.isin(*MISSING_TOKENS), col)


def strip(col: Column) -> Column:
    """Trim every kind of surrounding white space (``trim`` alone removes blanks only)."""
    return F.trim(col, F.lit(WHITE_SPACE))


def stripped(col: Column) -> Column:
    """``strip`` of a plain column, which is named several times.

    ``strip`` looks each character up among all white space. A text between two visible ASCII characters has none at its ends, which a few comparisons tell.
    """
    visible = lambda c: (c >= "!") & (c < "\x7f")
    return F.when(visible(col) & visible(F.substring(col, -1, 1)), col).otherwise(strip(col))


def pseudonymise(col: Column) -> Column:
    """SHA-256 hex of the trimmed text; NULL when missing or blank."""
    text = stripped(col)
    return F.when(text != "", F.sha2(text, 256))


def title_case(col: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others."""
    words = F.split(F.lower(col), r"(?<=[^\p{L}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), ""
    )


def prefixed_code(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number padded with zeros to ``width``, never cut."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", number.cast("long")))


def age_band(age: Column) -> Column:
    """Label of the band of the truncated age; missing and non-finite ages are unknown."""
    label = F.when(age.isNull() | F.isnan(age) | (F.abs(age) == float("inf")), AGE_BAND_UNKNOWN)
    for name, upper in AGE_BANDS:
        label = label.when(age < upper, name)
    return label.otherwise(AGE_BAND_ABOVE)


def severity_class(level: Column) -> Column:
    """Severity label of an urgency level."""
    first, *rest = SEVERITY_CLASSES
    label = F.when(level <= first[1], first[0])
    for name, upper in rest:
        label = label.when(level <= upper, name)
    return label.otherwise(SEVERITY_ABOVE)


def caesarean_flag(delivery_type: Column) -> Column:
    """1 for a caesarean, 0 for any other type and for a missing one."""
    return F.coalesce(F.lower(delivery_type) == "césarienne", F.lit(False)).cast("int")


def complication_flag(complication: Column) -> Column:
    """0 only for the explicit "aucune"; a missing type counts as a complication."""
    return (~F.lower(complication).eqNullSafe("aucune")).cast("int")
