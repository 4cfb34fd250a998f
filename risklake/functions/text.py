"""Text cleaning."""

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, functions as F

# The words pandas.read_csv documents as missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def na_to_null(text: Column) -> Column:
    """NULL for a missing-value word; the match is whole and case-sensitive, so ' NA ' stays."""
    return F.when(~text.isin(NA_TOKENS), text)


def code(text: Column) -> Column:
    """Trim spaces and upper-case ASCII letters; other letters keep their case."""
    return F.translate(F.trim(text), ascii_lowercase, ascii_uppercase)


def document_number(text: Column) -> Column:
    """Document number without its dots; the hyphen stays."""
    return F.replace(text, F.lit("."), F.lit(""))
