"""Predicates and measures of alignments as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNMAPPED, REVERSE, FIRST, SECOND, SECONDARY, PROPER, PAIRED = 0x4, 0x10, 0x40, 0x80, 0x100, 0x2, 0x1


def has(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) != 0


def is_header(line: Column) -> Column:
    return line.startswith("@")


def is_mapped(flag: Column) -> Column:
    return ~has(flag, UNMAPPED)


def is_primary(flag: Column) -> Column:
    """Secondary records go; supplementary ones stay."""
    return ~has(flag, SECONDARY)


def passes_mapq(mapq: Column, least: int = 5) -> Column:
    """A mapping quality over ``least``."""
    return mapq > F.lit(least)


def _sum_of(text: Column, pattern: str) -> Column:
    numbers = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))


def align_len(cigar: Column) -> Column:
    """Bases in matches and mismatches (M, =, X)."""
    return _sum_of(cigar, r"([0-9]+)[M=X]")


def identity(cigar: Column, md: Column) -> Column:
    """Matched bases of the MD tag over the CIGAR's M, =, X, I and D; 0 where there are none."""
    span = _sum_of(cigar, r"([0-9]+)[M=XID]")
    matched = _sum_of(F.coalesce(md, F.lit("")), r"([0-9]+)")
    return F.when(span > 0, matched / span).otherwise(F.lit(0.0))


def max_match_run(cigar: Column, xeq: bool = False) -> Column:
    """The longest single M run; with ``xeq`` runs of = and X count too."""
    runs = F.regexp_extract_all(cigar, F.lit(r"([0-9]+)[M=X]" if xeq else r"([0-9]+)M"), F.lit(1))
    return F.coalesce(F.array_max(F.transform(runs, lambda n: n.cast("long"))), F.lit(0).cast("long"))


def reference_span(cigar: Column) -> Column:
    """Bases of the reference that an alignment covers."""
    return _sum_of(cigar, r"([0-9]+)[M=XDN]")


def near_gene_end(flag: Column, pos: Column, read_len: Column, gene_len: Column, mean: float = 300, tolerance: float = 100) -> Column:
    """Whether the mate of a read that is mapped alone lies probably beyond the gene."""
    reverse = pos < F.lit(mean) - read_len + F.lit(tolerance)
    forward = (gene_len > 0) & (gene_len - pos < F.lit(mean) + F.lit(tolerance))
    return F.when(has(flag, REVERSE), reverse).otherwise(F.coalesce(forward, F.lit(False)))


def five_prime_insert(flag1: Column, pos1: Column, cigar1: Column, rname1: Column, flag2: Column, pos2: Column, cigar2: Column, rname2: Column) -> Column:
    """Signed distance of the 5' ends, both included; 0 if an end is unmapped or the references differ."""
    end = lambda flag, pos, cigar: F.when(has(flag, REVERSE), pos + reference_span(cigar) - 1).otherwise(pos)
    first, second = end(flag1, pos1, cigar1), end(flag2, pos2, cigar2)
    size = second - first + F.when(second >= first, 1).otherwise(-1)
    return F.when(is_mapped(flag1) & is_mapped(flag2) & (rname1 == rname2), size).otherwise(F.lit(0))


def without_mate_suffix(name: Column) -> Column:
    return F.regexp_replace(name, "/[12]$", "")


def sample_tag(read_group: Column) -> Column:
    from ..schemas import NO_SAMPLE

    return F.coalesce(read_group, F.lit(NO_SAMPLE))
