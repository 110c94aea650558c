"""Preparation of reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import clean_species
from ..schemas import UNCLASSED


def sequence_stats(fasta: DataFrame, key: str = "name") -> DataFrame:
    """(key, length, gc) of sequences, plasmids left out; gc is a fraction."""
    kept = fasta.where(~F.lower("header").contains("plasmid")) if "header" in fasta.columns else fasta
    sums = kept.groupBy(key).agg(F.sum(F.length("seq")).alias("length"), F.sum(F.length(F.regexp_replace("seq", "[^GCgc]", ""))).alias("_gc"))
    return sums.select(key, "length", F.when(F.col("length") > 0, F.col("_gc") / F.col("length")).otherwise(F.lit(0.0)).alias("gc"))


def longest_prefix_match(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name, match, n_words): the longest beginning of a name, by words, that is a known name; none gives no row.

    Beginnings are exploded and equi-joined; ``known`` has name and source (a lower source comes first on equal length).
    """
    words = names.select("name", F.split(clean_species(F.col("name")), "_").alias("words"))
    starts = words.select("name", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("n_words"), "words").withColumn("match", F.expr("array_join(slice(words, 1, n_words), '_')"))
    hits = starts.join(known.select(F.col("name").alias("match"), "source"), "match")
    return hits.groupBy("name").agg(F.max_by("match", F.struct("n_words", (-F.col("source")).alias("source"))).alias("match"), F.max("n_words").alias("n_words"))


def strain_species(strains: DataFrame, species: DataFrame) -> DataFrame:
    """Adds the species of each accession, or the name for none."""
    return strains.join(species, "accession", "left").withColumn("species", F.coalesce("species", F.lit(UNCLASSED)))


def species_taxids(species: DataFrame, accessions: DataFrame, taxids: DataFrame) -> DataFrame:
    """(species, accession, taxid) by each species' first accession, "-1" where no taxid is known."""
    first = species.join(accessions, "species", "left").groupBy("species").agg(F.min("accession").alias("accession"))
    return first.join(taxids, "accession", "left").withColumn("taxid", F.coalesce(F.col("taxid").cast("string"), F.lit("-1")))


def first_paths(rows: DataFrame) -> DataFrame:
    """(accession, path): of several sources the first."""
    return rows.groupBy("accession").agg(F.min_by("path", "source_order").alias("path"))


def checked_taxids(profile: DataFrame, ids: DataFrame) -> DataFrame:
    """Adds taxid to accessions; one without a taxid is an error."""
    missing = profile.join(ids, "accession", "left_anti").select("accession").take(1)
    if missing:
        raise ValueError(f"no taxid is known for {missing[0]['accession']}")
    return profile.join(ids.select("accession", "taxid"), "accession")
