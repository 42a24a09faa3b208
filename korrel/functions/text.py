"""Normalizers and tokenizers, Column to Column. Two families: matching contracts designators, blocking removes or expands them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dictionaries as D

#: Everything that is no letter, number, underscore or white space.
PUNCTUATION = r"[^\p{L}\p{N}_\s]"


def lookup(table: dict[str, str]) -> Column:
    """A dictionary as a literal map."""
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def _collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def tokens(x: Column) -> Column:
    """Words of a cleaned text in order; none of an empty one."""
    return F.filter(F.split(x, " "), lambda t: t != "")


def _mapped(x: Column, table: dict[str, str]) -> Column:
    names = lookup(table)
    return F.array_join(F.transform(tokens(x), lambda t: F.coalesce(names[t], t)), " ")


def known(x: Column) -> Column:
    """Empty for a null and for words that stand for one."""
    return F.when(x.isNull() | F.lower(F.trim(x)).isin(*D.NULL_WORDS), "").otherwise(x)


def clean(x: Column) -> Column:
    """Lower case, ``&`` as a word, punctuation as space, white space collapsed."""
    return _collapse(F.regexp_replace(F.replace(F.lower(known(x)), F.lit("&"), F.lit(" and ")), PUNCTUATION, " "))


def first_words(x: Column, n: int) -> Column:
    """The first ``n`` words of the cleaned text. A long text is cut at its first places only, not cleaned as a whole."""
    # each piece but a leading empty one holds a word; the last one is the unread rest
    pieces = F.slice(F.split(F.lower(known(x)), r"[^\p{L}\p{N}_&]+", n + 2), 1, n + 1)
    joined = _collapse(F.replace(F.array_join(pieces, " "), F.lit("&"), F.lit(" and ")))
    return F.slice(tokens(joined), 1, n)


def name(x: Column) -> Column:
    """Business name with contracted designators."""
    return _mapped(clean(x), D.NAME_WORDS)


def root(canonical: Column) -> Column:
    """A canonical name without trailing legal suffixes; the whole name if it is nothing else."""
    bare = F.regexp_replace(canonical, "(?:(?:^| )(?:" + "|".join(D.ROOT_SUFFIXES) + "))+$", "")
    return F.when(bare == "", canonical).otherwise(bare)


def address(x: Column) -> Column:
    """Address with state codes (two-word names first) and contracted designators."""
    out = clean(x)
    for state, code in D.STATES.items():
        if state.count(" ") == 1:
            out = F.regexp_replace(out, f"(?<![^ ]){state}(?![^ ])", code)
    single = {s: c for s, c in D.STATES.items() if " " not in s}
    return _mapped(out, {**D.ADDRESS_WORDS, **single})


def numbers(x: Column) -> Column:
    """Runs of digits of a raw address, in order."""
    return F.filter(F.split(known(x), r"[^\p{L}\p{N}_]+"), lambda t: t.rlike(r"^\p{Nd}+$"))


def country(x: Column) -> Column:
    """Country code of a known name, else the cleaned name."""
    cleaned = clean(x)
    return F.coalesce(lookup(D.COUNTRIES)[cleaned], cleaned)


def words(x: Column) -> Column:
    """Distinct words of a cleaned text."""
    return F.array_distinct(tokens(x))


def ngrams(x: Column, n: int = 3) -> Column:
    """Distinct character n-grams of a text padded with one space on each side; none of an empty one."""
    padded = F.concat(F.lit(" "), x, F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(padded) - (n - 1), F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(n))))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(grams)


def given(x: Column) -> Column:
    """What blocking reads: null for the words that stand for one."""
    return F.when(~x.isin(*D.NA_WORDS), x)


def block_name(x: Column) -> Column:
    """Name for blocking: legal words removed wherever they stand."""
    spaced = _collapse(F.regexp_replace(F.lower(F.coalesce(given(x), F.lit(""))), PUNCTUATION, " "))
    return F.array_join(F.filter(tokens(spaced), lambda t: ~t.isin(*D.BLOCK_LEGAL)), " ")


def block_address(x: Column) -> Column:
    """Address for blocking: abbreviations expanded."""
    spaced = _collapse(F.regexp_replace(F.lower(F.coalesce(given(x), F.lit(""))), PUNCTUATION, " "))
    return _mapped(spaced, D.BLOCK_ADDRESS)
