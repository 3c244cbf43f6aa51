"""Text normalisation and item documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word tokens of two or more characters.
WORD_PATTERN = r"\b\w\w+\b"


def normalize_text(value: Column) -> Column:
    """Lower case; everything but ``a-z0-9`` and white space becomes a space; white space collapsed."""
    spaced = F.regexp_replace(F.lower(value), r"[^a-z0-9\s]+", " ")
    return F.trim(F.regexp_replace(spaced, r"\s+", " "))


def prefixed_tokens(name: str, value: Column) -> Column:
    """Tokens of a text column, each prefixed with the column name; empty array for null or empty text."""
    words = F.filter(F.split(normalize_text(value), " "), lambda t: t != "")
    return F.coalesce(F.transform(words, lambda t: F.concat(F.lit(f"{name}_"), t)), F.array().cast("array<string>"))


def boolean_token(name: str, value: Column) -> Column:
    return F.when(value, F.lit(f"{name}_true")).when(~value, F.lit(f"{name}_false"))


def one_decimal(value: Column) -> Column:
    """A number as text with one decimal, correctly rounded from the exact binary value, ties to even.

    20·v is formed exactly as a sum and its rounding error, so the tie test is exact for every double.
    """
    v = value.cast("double")
    a, b = v * 16.0, v * 4.0
    s = a + b
    err = (a - (s - (s - a))) + (b - (s - a))
    low = F.floor(s / 2.0)
    rest = s - low * 2.0
    tenths = (
        F.when((rest > 1.0) | ((rest == 1.0) & (err > 0.0)), low + 1)
        .when((rest < 1.0) | (err < 0.0), low)
        .otherwise(low + F.pmod(low, F.lit(2)))
    )
    sign = F.when(tenths < 0, F.lit("-")).otherwise(F.lit(""))
    size = F.abs(tenths)
    return F.concat(sign, F.floor(size / 10).cast("string"), F.lit("."), F.pmod(size, F.lit(10)).cast("string"))


def numeric_token(name: str, value: Column) -> Column:
    v = value.cast("double")
    text = (
        F.when(F.isnan(v), F.lit(None).cast("string"))
        .when(v == float("inf"), F.lit("inf"))
        .when(v == float("-inf"), F.lit("-inf"))
        .otherwise(one_decimal(v))
    )
    return F.concat(F.lit(f"{name}_"), text)


def metadata_tokens(field: T.StructField) -> Column:
    """Typed tokens of one metadata column: booleans and numbers give one token, other types are text."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.BooleanType):
        single = boolean_token(field.name, value)
    elif isinstance(field.dataType, T.NumericType):
        single = numeric_token(field.name, value)
    else:
        return prefixed_tokens(field.name, value.cast("string"))
    return F.filter(F.array(single), lambda t: t.isNotNull())


def item_tokens(schema: T.StructType, item_col: str, text_cols: list[str], metadata_cols: list[str]) -> Column:
    """All tokens of an item, or one ``item_<id>`` token for an item without any."""
    parts = [prefixed_tokens(c, F.col(c).cast("string")) for c in text_cols]
    parts += [metadata_tokens(schema[c]) for c in metadata_cols]
    tokens = F.concat(*parts)
    fallback = F.array(F.concat(F.lit(f"{item_col}_"), F.col(item_col).cast("string")))
    return F.when(F.size(tokens) == 0, fallback).otherwise(tokens)


def words(document: Column) -> Column:
    return F.regexp_extract_all(F.lower(document), F.lit(WORD_PATTERN), 0)


def ngrams(word_list: Column, ngram_range: tuple[int, int] = (1, 1)) -> Column:
    """Runs of words joined by single spaces, for every length in the range; ``word_list`` should be a plain column.

    Longer runs append the next word to the shorter ones by zipping shifted arrays, so nothing is computed per start.
    """
    low, high = ngram_range
    runs, out = word_list, []
    for n in range(1, high + 1):
        if n > 1:
            rest = F.greatest(F.size(word_list) - (n - 1), F.lit(0))
            runs = F.zip_with(F.slice(runs, F.lit(1), rest), F.slice(word_list, F.lit(n), rest), lambda a, b: F.concat_ws(" ", a, b))
        if n >= low:
            out.append(runs)
    return F.concat(*out) if len(out) > 1 else out[0]


def display_name(term: Column) -> Column:
    """``field_value`` shown as ``field: value``, split at the first underscore."""
    return F.regexp_replace(term, r"^([^_]*)_(.*)$", "$1: $2")
