"""Names, ranks and paths of clades."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import RANK_LETTERS, RANKS


def rank_title(letter: Column) -> Column:
    """Full name of a rank letter."""
    pairs = chain.from_iterable((F.lit(a), F.lit(b)) for a, b in zip(RANK_LETTERS, RANKS, strict=True))
    return F.create_map(*pairs)[letter]


def rank_level(rank: Column) -> Column:
    """Place of a rank from the top, from 0; null if it is none of them."""
    at = F.array_position(F.array(*map(F.lit, RANKS)), rank)
    return F.when(at > 0, (at - 1).cast("int"))


def next_letter(letter: Column) -> Column:
    """Letter of the rank below; strains stay strains."""
    below = F.lit(None).cast("string")
    for a, b in zip(RANK_LETTERS, [*RANK_LETTERS[1:], "t"], strict=True):
        below = F.when(letter == a, F.lit(b)).otherwise(below)
    return below


def path_parts(path: Column) -> Column:
    return F.split(path, r"\|")


def path_until(path: Column, depth: Column) -> Column:
    """The first ``depth`` parts of a path."""
    return F.array_join(F.slice(path_parts(path), F.lit(1), depth), "|")


def padded_taxids(taxids: Column, size: int = 8) -> Column:
    """An array of taxids filled up with empty ones."""
    return F.slice(F.concat(taxids, F.array_repeat(F.lit(""), size)), 1, size)


def clean_species(name: Column) -> Column:
    """Without a trailing parenthesis; underscores for spaces."""
    return F.regexp_replace(F.regexp_replace(name, r"\s+\(.+?\)$", ""), " ", "_")


def without_version(accession: Column) -> Column:
    return F.regexp_replace(accession, r"\.[0-9]+$", "")


def assembly_accession(text: Column) -> Column:
    return F.regexp_extract(text, r"(GC[AF]_[0-9]+\.[0-9])", 1)


def log10_or_null(value: Column) -> Column:
    return F.when(value > 0, F.log10(value))


def percent_rounded(value: Column) -> Column:
    return F.round(value * 100, 5)
