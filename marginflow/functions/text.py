"""Text normalisation as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginflow.settings import NULL_TOKENS


# Every character that counts as white space
WHITE_SPACE = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())


def strip(c: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks, without a regex."""
    return F.btrim(c, F.lit(WHITE_SPACE))


# Lower-case characters that full case folding changes further, by a rule of Unicode: some
# become one other character, some several
_FOLDED = {ch: ch.casefold() for ch in map(chr, range(0x80, 0x110000))
           if ch.lower() == ch != ch.casefold()}


def casefold(c: Column) -> Column:
    """Full Unicode case folding: ``STRASSE`` and ``Straße`` agree, and so do all three sigmas.

    Text that is ASCII, as nearly all is, takes the plain lower case; the length in bytes tells.
    """
    full = F.lower(c)
    heads = {ch: form[0] for ch, form in _FOLDED.items()}
    for rest in sorted({form[1:] for form in _FOLDED.values()} - {""}):
        group = "".join(ch for ch, form in _FOLDED.items() if form[1:] == rest)
        full = F.regexp_replace(full, f"([{group}])", f"$1{rest}")
    full = F.translate(full, "".join(heads), "".join(heads.values()))
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(full)


def folded(c: Column) -> Column:
    """Case- and margin-insensitive comparison form."""
    return casefold(strip(c))


def folded_literal(text: str) -> str:
    """The same form of a fixed word."""
    return text.strip().casefold()


def enum_key(c: Column) -> Column:
    """Like ``folded``, with any run of white space or underscores written as one underscore."""
    return F.regexp_replace(folded(c), r"(?U)[\s_]+", "_")


def is_null_token(c: Column) -> Column:
    # nothing but letters of ASCII folds to a letter of these tokens
    return F.coalesce(F.lower(strip(c)).isin(*NULL_TOKENS), F.lit(False))


def column_token(c: Column) -> Column:
    """Lower-cased letters and digits of a column name."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def literal_lookup(key: Column, pairs: Iterable[tuple[str, object]]) -> Column:
    """Look ``key`` up in a short fixed list; NULL when it is not there."""
    entries = [F.lit(part) for pair in pairs for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def whole(c: Column) -> Column:
    """A rounded amount as text with one decimal, e.g. ``57.0``."""
    return F.concat(F.round(c, 0).cast("bigint").cast("string"), F.lit(".0"))
