"""Schemas of the tables that operators take and give."""

from __future__ import annotations

#: Aligned reads, one row per record.
ALIGNMENTS = "qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, tags map<string,string>"
#: Reads of FASTQ files.
READS = "sample_id int, rg string, sm string, read_name string, mate int, seq string, qual string"
#: Genes (or markers of the gene catalogue) and genomes.
GENES = "gene_id int, gene string, length int, species string, gc double"
SPECIES_GENOMES = "species string, genome_len long, genome_gc double"
#: Clade markers and the taxonomy.
MARKERS = "marker string, clade string, len int, ext array<string>, score double, taxon string"
TAXONOMY = "lineage string, geno_len long, taxid string"
CLADES = "clade string, parent string, depth int, kingdom string, n_children long, has_sp boolean"
#: Profiles.
PROFILE = "sample string, cluster string, raw_count long, recal_count double, abundance double, rel_abun double"
CAMI = "taxid string, rank string, taxpath string, taxpathsn string, percentage double"

#: Fixed: ranks from the top, and the letter that marks each in a clade's name.
RANKS = ["superkingdom", "phylum", "class", "order", "family", "genus", "species", "strain"]
RANK_LETTERS = ["k", "p", "c", "o", "f", "g", "s", "t"]
#: Fixed: kingdoms whose abundances add up to the total.
KINGDOMS = ["k__Archaea", "k__Bacteria", "k__Eukaryota", "k__Viruses"]
#: Fixed: names for what isn't known.
UNCLASSED, UNKNOWN, NO_SAMPLE = "s__unclassed", "Unknown", "NOSMTAG"
