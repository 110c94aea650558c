"""GC content and the weight of a read by it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: the built-in model's coefficients (doi 10.1371/journal.pone.0165015).
BUILTIN = (0.812093, 49.34331, 8.886807, 6.829778, 0.2642576, -0.005291173, 3.188492e-5, -2.502158)
#: Fixed: the model's formula as its files name it.
FORMULA = "I(p1*exp(-0.5*((readGC-p2)/p3)^2)+p4)+I(p5*readGC)+I(p6*(readGC^2))+I(p7*(readGC^3))+I(p8*log(genomeGC))"

#: Fixed: how its files say that it was fitted.
CONTROL = "maxiter=50,tol=1e-05,minFactor=1/1024"


@dataclass(frozen=True)
class GcModel:
    """Coefficients for read GC in percent and genome GC as a fraction."""

    coefficients: tuple[float, ...] = BUILTIN
    control: str = CONTROL
    start: tuple[float, ...] = field(default=BUILTIN)


#: Models by name.
MODELS = {"builtin": GcModel()}


def model(name: str | None = None) -> GcModel:
    """The named model, by default the built-in one."""
    return MODELS.get(name or "builtin", MODELS["builtin"])


def gc_fraction(seq: Column) -> Column:
    """Share of G and C, 0 for an empty sequence."""
    kept = F.length(F.regexp_replace(seq, "[^GCgc]", ""))
    return F.when(F.length(seq) > 0, kept / F.length(seq)).otherwise(F.lit(0.0))


def gc_percent(seq: Column) -> Column:
    return gc_fraction(seq) * 100


def coverage(read_gc: Column, genome_gc: Column, p: tuple[float, ...] = BUILTIN) -> Column:
    """The model's normalised coverage."""
    bell = F.lit(p[0]) * F.exp(F.lit(-0.5) * F.pow((read_gc - p[1]) / p[2], F.lit(2.0))) + p[3]
    return bell + F.lit(p[4]) * read_gc + F.lit(p[5]) * F.pow(read_gc, F.lit(2.0)) + F.lit(p[6]) * F.pow(read_gc, F.lit(3.0)) + F.lit(p[7]) * F.ln(genome_gc)


def gc_weight(read_gc: Column, genome_gc: Column, p: tuple[float, ...] = BUILTIN, genome_unit: str = "fraction") -> Column:
    """One over the coverage, which is at least 0.1; 0 where the genome's GC is 0 or not known."""
    share = genome_gc / 100 if genome_unit == "percent" else genome_gc
    return F.when(share > 0, 1 / F.greatest(F.lit(0.1), coverage(read_gc, share, p))).otherwise(F.lit(0.0))


def pair_weight(read1_gc: Column, read2_gc: Column, genome_gc: Column, p: tuple[float, ...] = BUILTIN) -> Column:
    return gc_weight((read1_gc + read2_gc) / 2, genome_gc, p)
