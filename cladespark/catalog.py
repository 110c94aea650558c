"""The queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bridge
from .functions import alignment as al
from .functions import gc, lineage
from .operators import counting, evaluate, gaps, gc_training, ncbi, pairs, prep, reports, statistics, taxonomy
from .sinks import reports as sinks
from .sources import fastq, references, sam
from .storage import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None = None, last: str | None = None, extra: dict[str, str] | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE_SQL[function.__name__] = sql if last is None and extra is None else bridge.with_views(sql, last, extra)
        return function

    return register


def _r(value: str | Column, digits: int = 6) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    out = F.round(column, digits)
    return out.alias(value) if isinstance(value, str) else out


# -- predicates ------------------------------------------------------------------------------------

_KEPT = "flag & 4 = 0 and flag & 256 = 0 and mapq > 5"
_KEPT_SQL = "(flag & 4) = 0 and (flag & 256) = 0 and mapq > 5"


@_query(f"select sample, qname, rname, pos, mapq from alignments where {_KEPT_SQL}", "alignments")
def alignment_filter(spark: SparkSession, d: str) -> DataFrame:
    return counting.filtered(bridge.alignments(spark, d)).select("sample", "qname", "rname", "pos", "mapq")


_DIGITS = "list_sum(list_transform(regexp_extract_all({0}, '{1}', 1), lambda x: cast(x as bigint)))"
_MATCHED, _SPAN = _DIGITS.format("md", "([0-9]+)"), _DIGITS.format("cigar", "([0-9]+)[M=XID]")


@_query(f"select sample, qname, rname, round({_MATCHED} / ({_SPAN})::double, 6) as identity from alignments where {_MATCHED} / ({_SPAN})::double >= 0.8", "alignments")
def identity_filter(spark: SparkSession, d: str) -> DataFrame:
    own = bridge.alignments(spark, d).withColumn("identity", al.identity(F.col("cigar"), F.col("md")))
    return own.where("identity >= 0.8").select("sample", "qname", "rname", _r("identity"))


@_query("select sample, qname, rname, cast(" + _DIGITS.format("cigar", "([0-9]+)[M=X]") + " as bigint) as align_len from alignments", "alignments")
def align_len_sum(spark: SparkSession, d: str) -> DataFrame:
    return bridge.alignments(spark, d).select("sample", "qname", "rname", al.align_len(F.col("cigar")).alias("align_len"))


@_query("select sample, qname, rname, coalesce(list_max(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: cast(x as bigint))), 0) as run, coalesce(list_max(list_transform(regexp_extract_all(cigar, '([0-9]+)[M=X]', 1), lambda x: cast(x as bigint))), 0) as run_xeq from alignments", "alignments")
def max_match_run(spark: SparkSession, d: str) -> DataFrame:
    run = lambda xeq: al.max_match_run(F.col("cigar"), xeq)
    return bridge.alignments(spark, d).select("sample", "qname", "rname", run(False).alias("run"), run(True).alias("run_xeq"))


@_query("select sample, qname, rname, pos from alignments join genes on gene = rname where case when (flag & 16) > 0 then pos < 40 - read_len + 100 else length > 0 and length - pos < 40 + 100 end", "genes")
def insert_size_overhang(spark: SparkSession, d: str) -> DataFrame:
    named = counting.with_gene(bridge.alignments(spark, d), bridge.genes(spark, d))
    near = al.near_gene_end(F.col("flag"), F.col("pos"), F.col("read_len"), F.col("gene_len"), 40, 100)
    return named.where(near).select("sample", "qname", "rname", "pos")


_SPAN_REF = "(cast(" + _DIGITS.format("{0}.cigar", "([0-9]+)[M=XDN]") + " as bigint))"
_END = "case when ({0}.flag & 16) > 0 then {0}.pos + " + _SPAN_REF + " - 1 else {0}.pos end"
_A, _B = _END.format("a"), _END.format("b")


@_query(
    f"""select sample, qname, cast(case when (a.flag & 4) = 0 and (b.flag & 4) = 0 and a.rname = b.rname then {_B} - ({_A}) + case when {_B} >= {_A} then 1 else -1 end else 0 end as bigint) as insert_size
    from (select sample, qname, max(case when (flag & 64) > 0 then struct_pack(rname := rname, flag := flag, pos := pos, cigar := cigar) end) as a, max(case when (flag & 128) > 0 then struct_pack(rname := rname, flag := flag, pos := pos, cigar := cigar) end) as b
    from alignments group by sample, qname having count(*) = 2 and count(*) filter (where (flag & 64) > 0) = 1 and count(*) filter (where (flag & 128) > 0) = 1) x""",
    "alignments",
)
def five_prime_insert(spark: SparkSession, d: str) -> DataFrame:
    merged = pairs.merged(bridge.alignments(spark, d), ["rname", "flag", "pos", "cigar"]).where("paired")
    end = lambda e: [F.col(f"{e}.{c}") for c in ("flag", "pos", "cigar", "rname")]
    return merged.select("sample", "qname", al.five_prime_insert(*end("r1"), *end("r2")).cast("long").alias("insert_size"))


@_query(f"select sample, rname, count(*) as n from alignments where {_KEPT_SQL} and cast(rname as bigint) % 5 <> 0 group by 1, 2", "alignments")
def exclude_markers(spark: SparkSession, d: str) -> DataFrame:
    excluded = bridge.genes(spark, d).where("cast(gene as bigint) % 5 = 0").select(F.col("gene").alias("marker"))
    kept = counting.without_markers(counting.filtered(bridge.alignments(spark, d)), excluded)
    return kept.groupBy("sample", "rname").agg(F.count("*").alias("n"))


# -- sources ---------------------------------------------------------------------------------------


@_query("select sample, qname, flag, rname, pos, mapq, cigar, md from alignments where (flag & 4) = 0", "alignments")
def sam_parse(spark: SparkSession, d: str) -> DataFrame:
    """Alignments written as SAM lines and parsed again."""
    fields = ["qname", "cast(flag as string)", "rname", "cast(pos as string)", "cast(mapq as string)", "cigar", "'*'", "'0'", "cast(tlen as string)", "'*'", "'*'", "concat('MD:Z:', md)", "concat('RG:Z:', sample)"]
    lines = bridge.alignments(spark, d).selectExpr(f"concat_ws('\\t', {', '.join(fields)}) as value")
    return sam.parsed_sam(lines).withColumn("sample", al.sample_tag(F.col("rg"))).select("sample", "qname", "flag", "rname", "pos", "mapq", "cigar", "md")


@_query("select o_orderkey as rec_no, concat('r', cast(o_orderkey as string)) as name, o_orderstatus as seq, o_orderpriority as qual from orders")
def fastq_records(spark: SparkSession, d: str) -> DataFrame:
    """Four numbered lines a record, put together again."""
    part = F.expr("array(concat('@r', cast(o_orderkey as string)), o_orderstatus, '+', o_orderpriority)")
    lines = bridge.table(spark, d, "orders").select("o_orderkey", F.posexplode(part).alias("k", "value")).select((F.col("o_orderkey") * 4 + F.col("k")).alias("line"), "value")
    return fastq.by_line_number(lines)


@_query("select cast(p_partkey as string) as marker, p_brand as clade, p_size as len, cast(p_partkey % 3 as int) as n_ext, concat('t__', p_type) as first_ext from part")
def marker_json_parse(spark: SparkSession, d: str) -> DataFrame:
    """Markers written as JSON objects and parsed again."""
    entry = "to_json(map(cast(p_partkey as string), named_struct('clade', p_brand, 'len', p_size, 'ext', array_repeat(p_type, cast(p_partkey % 3 as int)), 'score', 1.0D, 'taxon', p_type)))"
    parsed = references.parsed_markers(bridge.table(spark, d, "part").selectExpr(f"{entry} as value", "p_type"))
    named = parsed.select("marker", "clade", "len", F.size("ext").alias("n_ext"), F.concat(F.lit("t__"), "taxon").alias("first_ext"))
    return named


@_query("select cast(rname as string) as marker, count(*) as n_reads from (select sample, qname, arg_max(rname, line) as rname from alignments group by sample, qname) group by 1", "alignments")
def last_record_per_read(spark: SparkSession, d: str) -> DataFrame:
    return counting.deduplicated(bridge.alignments(spark, d)).groupBy(F.col("rname").alias("marker")).agg(F.count("*").alias("n_reads"))


@_query("select sample, cast(dense_rank() over (order by first, sample) - 1 as int) as sample_id from (select sample, min(line) as first from alignments group by sample)", "alignments")
def sample_ids(spark: SparkSession, d: str) -> DataFrame:
    return counting.sample_ids(bridge.alignments(spark, d), "line")


# -- genes and species -----------------------------------------------------------------------------

_NAMED_SQL = f"select a.*, coalesce(g.species, 's__unclassed') as species, coalesce(g.length, 0) as gene_len from alignments a left join (select * from genes where cast(gene as bigint) % 9 <> 0) g on g.gene = a.rname where {_KEPT_SQL}"
_NAMED = {"named": _NAMED_SQL}


def _named(spark: SparkSession, d: str) -> DataFrame:
    """Kept alignments with genes, of which each ninth isn't known."""
    return counting.with_gene(counting.filtered(bridge.alignments(spark, d)), bridge.genes(spark, d).where("cast(gene as bigint) % 9 <> 0"))


def _gene_views(*names: str) -> dict[str, str]:
    return {n: bridge.VIEWS[n] for n in ("alignments", "genes", "genomes")} | _NAMED


def _genes_sql(query: str, **more: str) -> str:
    views = _gene_views() | more
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in views.items()) + "\n" + query


_COUNTS = "select sample, species as cluster, count(*) as raw_count, cast(count(*) as double) as recal_count from named group by 1, 2"
_ABUNDANCE = "select c.*, case when g.genome_len > 0 then recal_count / g.genome_len else 0.0 end as abundance from counts c left join genomes g on g.species = c.cluster"


@_query(_genes_sql("select sample, qname, rname, species, gene_len from named"))
def gene_species_lookup(spark: SparkSession, d: str) -> DataFrame:
    return _named(spark, d).select("sample", "qname", "rname", "species", "gene_len")


@_query(_genes_sql("select sample, rname as cluster, count(*) as raw_count, cast(count(*) as double) as recal_count from named group by 1, 2"))
def gene_counts(spark: SparkSession, d: str) -> DataFrame:
    return counting.counted(_named(spark, d), "rname")


def _species_abundance(spark: SparkSession, d: str) -> DataFrame:
    lengths = bridge.genomes(spark, d).select(F.col("species").alias("cluster"), F.col("genome_len").alias("length"))
    return counting.with_abundance(counting.counted(_named(spark, d), "species"), lengths)


@_query(_genes_sql("select sample, cluster, raw_count, recal_count, round(abundance, 6) as abundance from abundances", counts=_COUNTS, abundances=_ABUNDANCE))
def species_abundance(spark: SparkSession, d: str) -> DataFrame:
    return _species_abundance(spark, d).select("sample", "cluster", "raw_count", "recal_count", _r("abundance"))


@_query(_genes_sql("select sample, cluster, raw_count, recal_count, round(abundance, 6) as abundance, round(abundance / sum(abundance) over (partition by sample) * 100, 6) as rel_abun from abundances", counts=_COUNTS, abundances=_ABUNDANCE))
def relative_abundance(spark: SparkSession, d: str) -> DataFrame:
    return counting.with_relative(_species_abundance(spark, d)).select("sample", "cluster", "raw_count", "recal_count", _r("abundance"), _r("rel_abun"))


_P = gc.BUILTIN
_CURVE = f"({_P[0]!r} * exp(-0.5 * power((read_gc - {_P[1]!r}) / {_P[2]!r}, 2)) + {_P[3]!r} + {_P[4]!r} * read_gc + ({_P[5]!r}) * power(read_gc, 2) + {_P[6]:.11f} * power(read_gc, 3) + ({_P[7]!r}) * ln(genome_gc))"


@_query(_genes_sql(f"select sample, n.species as cluster, count(*) as raw_count, round(sum(case when coalesce(genome_gc, 0) > 0 then 1 / greatest(0.1, {_CURVE}) else 0 end), 4) as recal_count from named n left join genomes g on g.species = n.species group by 1, 2"))
def gc_weighted_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = counting.gc_counted(counting.with_genome(_named(spark, d), bridge.genomes(spark, d)), "species")
    return counts.select("sample", "cluster", "raw_count", _r("recal_count", 4))


@_query(_genes_sql("select sample, species as cluster, string_agg(qname, ',' order by qname) as names from named group by 1, 2"))
def read_names(spark: SparkSession, d: str) -> DataFrame:
    return counting.read_names(_named(spark, d), "species").drop("part")


# -- pairs -----------------------------------------------------------------------------------------

_MERGED = """select sample, qname, count(*) as n, count(*) filter (where (flag & 64) > 0) as n1, count(*) filter (where (flag & 128) > 0) as n2, bool_and((flag & 2) > 0) as proper from alignments group by 1, 2"""


@_query(f"select sample, qname, n = 2 as paired, n = 2 and proper as proper from ({_MERGED}) where n = 1 or (n = 2 and n1 = 1 and n2 = 1)", "alignments")
def pair_merge(spark: SparkSession, d: str) -> DataFrame:
    return pairs.merged(bridge.alignments(spark, d), ["rname", "pos"]).select("sample", "qname", "paired", "proper")


_NEAR = "case when ({0}.flag & 16) > 0 then {0}.pos < 300 - 100 + 100 else {0}.gene_len > 0 and {0}.gene_len - {0}.pos < 400 end"


@_query(
    _genes_sql(
        f"""select sample, cluster, count(*) as n from (
        select sample, unnest(case when proper or a.species = b.species then [a.species] else list_filter([case when {_NEAR.format('a')} then a.species end, case when {_NEAR.format('b')} then b.species end], lambda x: x is not null) end) as cluster
        from (select sample, qname, bool_and((flag & 2) > 0) as proper, max(case when (flag & 64) > 0 then struct_pack(rname := rname, flag := flag, pos := pos, species := species, gene_len := gene_len) end) as a, max(case when (flag & 128) > 0 then struct_pack(rname := rname, flag := flag, pos := pos, species := species, gene_len := gene_len) end) as b
        from named group by sample, qname having count(*) = 2 and count(*) filter (where (flag & 64) > 0) = 1 and count(*) filter (where (flag & 128) > 0) = 1)) group by 1, 2"""
    )
)
def pair_counts(spark: SparkSession, d: str) -> DataFrame:
    merged = pairs.merged(_named(spark, d), ["rname", "flag", "pos", "species", "gene_len", "read_len"])
    return pairs.pair_clusters(merged).groupBy("sample", "cluster").agg(F.count("*").alias("n"))


@_query(
    """select abs(tlen) as insert_size, count(*) as n from (select sample, qname, max(case when (flag & 64) > 0 then struct_pack(rname := rname, tlen := tlen) end).tlen as tlen
    from alignments group by sample, qname having count(*) = 2 and count(*) filter (where (flag & 64) > 0) = 1 and count(*) filter (where (flag & 128) > 0) = 1 and bool_and((flag & 2) > 0)) group by 1""",
    "alignments",
)
def insert_size_hist(spark: SparkSession, d: str) -> DataFrame:
    return pairs.insert_sizes(pairs.merged(bridge.alignments(spark, d), ["rname", "tlen"]))


# -- taxonomy --------------------------------------------------------------------------------------


def _tree(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clades, where they lead, and the seeded cells."""
    clades = stored(taxonomy.clade_tree(bridge.taxonomy(spark, d)), "clades")
    placed = stored(taxonomy.terminals(clades), "placed")
    return clades, placed, stored(taxonomy.seeded(bridge.marker_reads(spark, d), bridge.markers(spark, d), placed), "cells")


def _used(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    clades, placed, cells = _tree(spark, d)
    return clades, taxonomy.refilled(taxonomy.with_discards(cells, clades, placed), clades)


def _rolled(spark: SparkSession, d: str, min_len: int) -> tuple[DataFrame, DataFrame]:
    clades, used = _used(spark, d)
    return clades, taxonomy.rolled_up(taxonomy.local_abundance(used, clades), clades, min_len)


@_query("select clade, parent, depth, kingdom, path, n_children, has_sp from clades", "clades")
def clade_tree(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.clade_tree(bridge.taxonomy(spark, d)).select("clade", "parent", "depth", "kingdom", "path", "n_children", "has_sp")


@_query("select clade, terminal from placed", "placed")
def marker_placement(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.terminals(taxonomy.clade_tree(bridge.taxonomy(spark, d)))


@_query("select sample, clade, marker, len, reads from cells", "cells")
def marker_zero_seed(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d)[2].select("sample", "clade", "marker", "len", "reads")


@_query("select sample, clade, n_markers, n_nonzero, round(ratio, 6) as ratio from ratios", "ratios")
def nonzero_ratio(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.nonzero_ratio(_tree(spark, d)[2]).select("sample", "clade", "n_markers", "n_nonzero", _r("ratio"))


@_query("select sample, clade, marker, discard from discards", "discards")
def quasi_marker_discard(spark: SparkSession, d: str) -> DataFrame:
    clades, placed, cells = _tree(spark, d)
    return taxonomy.with_discards(cells, clades, placed).select("sample", "clade", "marker", "discard")


@_query("select sample, clade, marker, reads, discard from used", "used")
def marker_refill(spark: SparkSession, d: str) -> DataFrame:
    return _used(spark, d)[1].select("sample", "clade", "marker", "reads", "discard")


def _statistic(name: str) -> None:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return statistics.clade_statistics(_used(spark, d)[1], ["sample", "clade"]).select("sample", "clade", _r(name))

    query.__name__ = f"stat_{name}"
    _query(f"select sample, clade, round({name}, 6) as {name} from stats", "stats")(query)


for _name in statistics.STATISTICS:
    _statistic(_name)


@_query("select sample, clade, round(local, 6) as local, len_sum, read_sum from locals", "locals")
def strain_gate(spark: SparkSession, d: str) -> DataFrame:
    clades, used = _used(spark, d)
    return taxonomy.local_abundance(used, clades).select("sample", "clade", _r("local"), "len_sum", "read_sum")


_ROLLED = "select sample, clade, depth, round(abundance, 6) as abundance, round(unclassified, 6) as unclassified, read_sum from rolled"


@_query(_ROLLED, extra=bridge.rolled_views(2000))
def clade_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _rolled(spark, d, 2000)[1].select("sample", "clade", "depth", _r("abundance"), _r("unclassified"), "read_sum")


@_query(_ROLLED, extra=bridge.rolled_views(10000))
def clade_rollup_min_10000(spark: SparkSession, d: str) -> DataFrame:
    return _rolled(spark, d, 10000)[1].select("sample", "clade", "depth", _r("abundance"), _r("unclassified"), "read_sum")


_EMITTED = bridge.rolled_views(2000) | {
    "totals": "select sample, sum(abundance) as total from rolled where clade in ('k__Archaea', 'k__Bacteria', 'k__Eukaryota', 'k__Viruses') group by sample having sum(abundance) > 0",
    "rows": "select r.*, c.path, t.total, (select min(substr(n.clade, 1, 3)) from nodes n where n.parent = r.clade) as child_prefix from rolled r join totals t using (sample) join clades c using (clade)",
    "emitted": """select sample, path as cluster, abundance, abundance / total * 100 as rel_abun from rows where abundance > 0
        union all select sample, concat(path, '|', child_prefix, substr(clade, 4), '_unclassified'), unclassified, unclassified / total * 100 from rows where unclassified > 0""",
}


@_query("select sample, cluster, round(abundance, 6) as abundance, round(rel_abun, 6) as rel_abun from emitted", extra=_EMITTED)
def unclassified_rows(spark: SparkSession, d: str) -> DataFrame:
    clades, rolled = _rolled(spark, d, 2000)
    return taxonomy.emitted(rolled, clades).select("sample", "cluster", _r("abundance"), _r("rel_abun"))


_SPECIES_ROWS = _EMITTED | {
    "species_rows": """select sample, path as cluster, abundance / total * 100 as rel_abun from rows where clade like 's\\_\\_%' escape '\\' and abundance > 0
        union all select sample, concat(path, '|', child_prefix, substr(clade, 4), '_unclassified'), unclassified / total * 100 from rows where clade like 's\\_\\_%' escape '\\' and unclassified > 0"""
}


@_query("select sample, cluster, round(rel_abun, 6) as rel_abun from species_rows union all select t.sample, 's__unclassified', round(100 - coalesce(sum(rel_abun), 0), 6) from totals t left join species_rows s on s.sample = t.sample group by t.sample", extra=_SPECIES_ROWS)
def single_rank_rows(spark: SparkSession, d: str) -> DataFrame:
    clades, rolled = _rolled(spark, d, 2000)
    rows = taxonomy.emitted(rolled, clades, "s")
    # a remainder of nothing may come out as a tiny number of either sign
    return rows.select("sample", "cluster", (F.round("rel_abun", 6) + F.lit(0.0)).alias("rel_abun"))


_LENGTHS = {
    "leaves": "select split_part(lineage, '|', 3) as clade, split_part(lineage, '|', 2) as parent, split_part(lineage, '|', 1) as kingdom, geno_len::double as geno_len from taxonomy",
    "species_len": "select parent as clade, kingdom, avg(geno_len) as geno_len from leaves group by 1, 2",
    "lengths": "select clade, geno_len from leaves union all select clade, geno_len from species_len union all select kingdom, avg(geno_len) from species_len group by kingdom",
}


@_query("select clade, round(geno_len, 4) as geno_len from lengths", extra=_LENGTHS)
def mean_genome_length(spark: SparkSession, d: str) -> DataFrame:
    lineages = bridge.taxonomy(spark, d)
    return taxonomy.genome_lengths(lineages, taxonomy.clade_tree(lineages)).select("clade", _r("geno_len", 4))


@_query("select r.sample, r.clade, round(r.abundance, 6) as abundance, round(l.geno_len, 4) as geno_len, cast(floor(r.abundance * l.geno_len) as bigint) as est_reads from rolled r join lengths l using (clade)", extra=bridge.rolled_views(2000) | _LENGTHS)
def read_stats(spark: SparkSession, d: str) -> DataFrame:
    clades, rolled = _rolled(spark, d, 2000)
    found = reports.with_read_stats(rolled, taxonomy.genome_lengths(bridge.taxonomy(spark, d), clades))
    return found.select("sample", "clade", _r("abundance"), _r("geno_len", 4), "est_reads")


_EST = {"species_reads": "select r.sample, r.clade, c.parent, cast(floor(r.abundance * l.geno_len) as bigint) as est_reads from rolled r join lengths l using (clade) join clades c using (clade) where c.depth = 2"}


@_query("select sample, clade, est_reads from species_reads union all select sample, parent, cast(sum(est_reads) as bigint) from species_reads group by 1, 2", extra=bridge.rolled_views(2000) | _LENGTHS | _EST)
def estimated_reads(spark: SparkSession, d: str) -> DataFrame:
    clades, rolled = _rolled(spark, d, 2000)
    return taxonomy.estimated_reads(rolled, clades, taxonomy.genome_lengths(bridge.taxonomy(spark, d), clades))


@_query("select sample, marker, 1 as present from cells where reads > 0 and reads * 1000 / len::double > 10", "cells")
def marker_presence(spark: SparkSession, d: str) -> DataFrame:
    return reports.marker_presence(_tree(spark, d)[2], 10)


@_query("select sample, marker, round(reads * 1000 / len::double, 6) as value from cells where reads > 0", "cells")
def marker_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.marker_counts(_tree(spark, d)[2], True).select("sample", "marker", _r("value"))


@_query("select sample, clade, marker, round(reads * 1000 / len::double, 6) as value from cells", "cells")
def clade_profiles(spark: SparkSession, d: str) -> DataFrame:
    return reports.clade_profiles(_tree(spark, d)[2]).select("sample", "clade", "marker", _r("value"))


@_query("select m.marker from markers m join clades c on c.clade = m.clade where c.kingdom not in ('k__Viruses', 'k__Archaea')", "clades")
def ignored_kingdoms(spark: SparkSession, d: str) -> DataFrame:
    clades = taxonomy.clade_tree(bridge.taxonomy(spark, d))
    return reports.without_kingdoms(bridge.markers(spark, d), clades, ["k__Viruses", "k__Archaea"]).select("marker")


# -- roll-ups by parent links ----------------------------------------------------------------------

_PROFILE = "select l_returnflag as sample, s_suppkey as taxid, sum(l_quantity) as abundance from lineitem join supplier on s_suppkey = l_suppkey group by 1, 2"


def _supplier_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers under nations under regions under a root, as parent links."""
    supplier = bridge.table(spark, d, "supplier").selectExpr("s_suppkey as taxid", "cast(-1000 - s_nationkey as bigint) as parent", "'species' as rank")
    nation = bridge.table(spark, d, "nation").selectExpr("cast(-1000 - n_nationkey as bigint) as taxid", "cast(-2000 - n_regionkey as bigint) as parent", "'no rank' as rank")
    region = bridge.table(spark, d, "region").selectExpr("cast(-2000 - r_regionkey as bigint) as taxid", "cast(-3000 as bigint) as parent", "'superkingdom' as rank")
    return supplier.unionByName(nation).unionByName(region).unionByName(spark.range(1).selectExpr("cast(-3000 as bigint) as taxid", "cast(-3000 as bigint) as parent", "'root' as rank"))


def _supplier_profile(spark: SparkSession, d: str) -> DataFrame:
    return bridge.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), F.col("l_suppkey").alias("taxid")).agg(F.sum("l_quantity").alias("abundance"))


@_query(f"select sample, taxid, 'species' as rank, abundance from ({_PROFILE}) union all select p.sample, cast(-2000 - n_regionkey as bigint), 'superkingdom', sum(p.abundance) from ({_PROFILE}) p join supplier on s_suppkey = p.taxid join nation on n_nationkey = s_nationkey group by 1, 2, 3")
def taxon_rollup(spark: SparkSession, d: str) -> DataFrame:
    nodes = _supplier_nodes(spark, d)
    paths = ncbi.lineages(nodes.where("rank = 'species'").select("taxid"), nodes)
    return ncbi.rolled_by_rank(_supplier_profile(spark, d), paths)


@_query("select s_suppkey as taxid, 0 as step, s_suppkey as ancestor from supplier union all select s_suppkey, 1, cast(-1000 - s_nationkey as bigint) from supplier union all select s_suppkey, 2, cast(-2000 - n_regionkey as bigint) from supplier join nation on n_nationkey = s_nationkey")
def lineage_to_root(spark: SparkSession, d: str) -> DataFrame:
    nodes = _supplier_nodes(spark, d)
    return ncbi.lineages(nodes.where("rank = 'species'").select("taxid"), nodes).select("taxid", "step", "ancestor")


@_query("select lineage, concat(split_part(lineage, '|', 1), '|', split_part(lineage, '|', 2)) as upper, 'strain' as rank, 's' as above from taxonomy", "taxonomy")
def lineage_path(spark: SparkSession, d: str) -> DataFrame:
    last = F.substring(F.element_at(lineage.path_parts(F.col("lineage")), -1), 1, 1)
    second = F.substring(lineage.path_parts(F.col("lineage"))[1], 1, 1)
    return bridge.taxonomy(spark, d).select("lineage", lineage.path_until(F.col("lineage"), F.lit(2)).alias("upper"), lineage.rank_title(last).alias("rank"), second.alias("above"))


@_query(
    """with x as (select l_orderkey as grp, l_suppkey as member, s_nationkey as nation, n_regionkey as region from lineitem join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey),
    g as (select grp, count(distinct region) as nr, count(distinct nation) as nn, count(distinct member) as nm, min(region) as region, min(nation) as nation, min(member) as member from x group by grp)
    select grp, 0 as level, cast(region as bigint) as taxid from g where nr = 1 union all select grp, 1, nation from g where nr = 1 and nn = 1 union all select grp, 2, member from g where nr = 1 and nn = 1 and nm = 1"""
)
def common_lineage(spark: SparkSession, d: str) -> DataFrame:
    rows = bridge.table(spark, d, "lineitem").join(bridge.table(spark, d, "supplier"), F.expr("s_suppkey = l_suppkey")).join(bridge.table(spark, d, "nation"), F.expr("n_nationkey = s_nationkey"))
    levels = F.expr("array(cast(n_regionkey as bigint), cast(s_nationkey as bigint), l_suppkey)")
    paths = rows.select(F.col("l_orderkey").alias("grp"), F.col("l_suppkey").alias("member"), F.posexplode(levels).alias("level", "taxid"))
    return ncbi.common_lineage(paths, "grp")


_CLUSTERS = "select sample, species as cluster, count(*) as abundance from named group by 1, 2"
_IDS = "select species as cluster, cast(genome_len as string) as taxid from genomes where genome_len % 3 <> 0"


@_query(_genes_sql(f"select sample, coalesce(i.taxid, '-1') as taxid, cast(sum(abundance) as bigint) as abundance from ({_CLUSTERS}) c left join ({_IDS}) i on i.cluster = c.cluster group by 1, 2"))
def taxid_sum(spark: SparkSession, d: str) -> DataFrame:
    profile = counting.counted(_named(spark, d), "species").select("sample", "cluster", F.col("raw_count").alias("abundance"))
    ids = bridge.genomes(spark, d).where("genome_len % 3 <> 0").selectExpr("species as cluster", "cast(genome_len as string) as taxid")
    return ncbi.summed_by_taxid(profile, ids)


@_query("select l_returnflag as sample, cast(case when l_suppkey % 10 = 0 then l_suppkey - 1 else l_suppkey end as bigint) as taxid, sum(l_quantity) as abundance from lineitem group by 1, 2")
def merged_taxids(spark: SparkSession, d: str) -> DataFrame:
    merged = bridge.table(spark, d, "supplier").where("s_suppkey % 10 = 0").selectExpr("s_suppkey as old", "s_suppkey - 1 as new")
    return ncbi.current_taxids(_supplier_profile(spark, d), merged).groupBy("sample", "taxid").agg(F.sum("abundance").alias("abundance"))


@_query(_genes_sql("select sample, p_type as taxon, count(*) as abundance from named join part on cast(p_partkey as string) = rname group by 1, 2"))
def annotation_rollup(spark: SparkSession, d: str) -> DataFrame:
    profile = counting.counted(_named(spark, d), "rname").select("sample", "cluster", F.col("raw_count").alias("abundance"))
    annotation = bridge.table(spark, d, "part").selectExpr("cast(p_partkey as string) as cluster", "p_type as species")
    return ncbi.rolled_by_annotation(profile, annotation, "species")


@_query("select c_mktsegment as name, 'species' as rank, min(c_nationkey) as taxid from customer group by 1 having count(distinct c_nationkey) = 1 union all select n_name, 'genus', n_nationkey from nation")
def guessed_taxids(spark: SparkSession, d: str) -> DataFrame:
    names = bridge.table(spark, d, "customer").selectExpr("c_mktsegment as name", "'species' as rank", "c_nationkey as taxid").unionByName(bridge.table(spark, d, "nation").selectExpr("n_name as name", "'genus' as rank", "n_nationkey as taxid"))
    return ncbi.guessed_taxids(names.select("name", "rank").distinct(), names)


_REPAIR = "select sample, cluster, raw_count, case when raw_count % 4 = 0 then raw_count / 50.0::double else raw_count / 100.0::double end as abundance from (select sample, rname as cluster, count(*) as raw_count from named group by 1, 2)"


@_query(_genes_sql("select sample, cluster, round(abundance, 6) as abundance, round(abundance / sum(abundance) over (partition by sample) * 100, 6) as rel_abun from repair", repair=_REPAIR))
def repaired_abundance(spark: SparkSession, d: str) -> DataFrame:
    """Each fourth count has an abundance of 0, which is computed again with a length of 50."""
    profile = counting.counted(_named(spark, d), "rname").withColumn("abundance", F.when(F.col("raw_count") % 4 == 0, 0.0).otherwise(F.col("raw_count") / 100)).withColumn("rel_abun", F.lit(0.0))
    lengths = profile.select("cluster").distinct().withColumn("length", F.lit(50.0))
    return ncbi.repaired(profile, lengths).select("sample", "cluster", _r("abundance"), _r("rel_abun"))


# -- evaluation ------------------------------------------------------------------------------------

_EVAL = """with o as (select l_returnflag as sample, l_partkey % 97 as cluster, count(*) as n from lineitem where l_quantity > 40 and l_partkey % 97 <> 5 group by 1, 2),
    e as (select l_returnflag as sample, l_partkey % 97 as cluster, count(*) as n from lineitem where l_partkey % 97 <> 11 group by 1, 2),
    op as (select sample, cluster, n / (sum(n) over (partition by sample))::double * 100 as a from o), ep as (select sample, cluster, n / (sum(n) over (partition by sample))::double * 100 as a from e),
    c as (select coalesce(op.sample, ep.sample) as sample, coalesce(op.cluster, ep.cluster) as cluster, coalesce(op.a, 0) as observed, coalesce(ep.a, 0) as expected from op full join ep on op.sample = ep.sample and op.cluster = ep.cluster)
    """


def _compared(spark: SparkSession, d: str) -> DataFrame:
    def profile(where: str) -> DataFrame:
        counts = bridge.table(spark, d, "lineitem").where(where).groupBy(F.col("l_returnflag").alias("sample"), (F.col("l_partkey") % 97).alias("cluster")).agg(F.count("*").alias("n"))
        return counting.with_relative(counts, "n").select("sample", "cluster", F.col("rel_abun").alias("abundance"))

    return evaluate.compared(profile("l_quantity > 40 and l_partkey % 97 <> 5"), profile("l_partkey % 97 <> 11"))


@_query(_EVAL + "select sample, cluster, round(observed, 6) as observed, round(expected, 6) as expected from c")
def profile_union(spark: SparkSession, d: str) -> DataFrame:
    return _compared(spark, d).select("sample", "cluster", _r("observed"), _r("expected"))


@_query(_EVAL + "select sample, round(sum(abs(observed - expected)), 6) as l1, round(1 - sum(abs(observed - expected)) / 200, 6) as proximity from c group by sample")
def profile_l1(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.scores(_compared(spark, d)).select("sample", _r("l1"), _r("proximity"))


_TP = "count(*) filter (where observed > 0 and expected > 0)"


@_query(_EVAL + f"select sample, round({_TP} / (count(*) filter (where observed > 0))::double, 6) as precision, round({_TP} / (count(*) filter (where expected > 0))::double, 6) as recall from c group by sample")
def precision_recall(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.scores(_compared(spark, d)).select("sample", _r("precision"), _r("recall"))


@_query(_EVAL + "select sample, cluster, case when observed > 0 and expected > 0 then 'common' when observed > 0 then 'observed' else 'expected' end as kind, round(case when observed > 0 then log10(observed) end, 6) as log_observed, round(case when expected > 0 then log10(expected) end, 6) as log_expected from c")
def common_log10(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.common_clusters(_compared(spark, d)).select("sample", "cluster", "kind", _r("log_observed"), _r("log_expected"))


@_query(_EVAL + "select sample, round(sum(abs(observed - expected)), 6) as l1_all, round(sum(case when observed > 0 and expected > 0 then abs(observed - expected) else 0 end), 6) as l1_common from c group by sample")
def common_l1(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.common_distance(_compared(spark, d)).select("sample", _r("l1_all"), _r("l1_common"))


@_query(_EVAL + "select sample, round(regr_slope(observed, expected), 5) as slope, round(regr_intercept(observed, expected), 5) as intercept from c group by sample")
def regression_line(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.regression_line(_compared(spark, d)).select("sample", _r("slope", 5), _r("intercept", 5))


@_query(_EVAL + "select ep.sample, round(sum(abs(ep.a - coalesce(op.a, 0))) / 100, 6) as l1 from ep left join op on op.sample = ep.sample and op.cluster = ep.cluster group by ep.sample")
def truth_l1(spark: SparkSession, d: str) -> DataFrame:
    both = _compared(spark, d)
    truth = both.where("expected > 0").select("sample", "cluster", (F.col("expected") / 100).alias("abundance"))
    return evaluate.truth_distance(both.where("observed > 0").select("sample", "cluster", F.col("observed").alias("abundance")), truth).select("sample", _r("l1"))


# -- gaps, sequences, reports ----------------------------------------------------------------------

def _hits(spark: SparkSession, d: str) -> DataFrame:
    return bridge.table(spark, d, "events").select("user_id", "event_id", F.expr("cast(floor(unix_micros(to_timestamp(ts)) / 1000000) as bigint)").alias("place"))


@_query("select user_id, place, place - lag(place) over (partition by user_id order by place) as gap from (select distinct user_id, cast(floor(epoch_us(ts) / 1000000) as bigint) as place from events)")
def position_gaps(spark: SparkSession, d: str) -> DataFrame:
    return gaps.position_gaps(_hits(spark, d).select("user_id", "place").distinct(), "user_id", "place")


@_query("with g as (select user_id, place - lag(place) over (partition by user_id order by place) as gap from (select distinct user_id, cast(floor(epoch_us(ts) / 1000000) as bigint) as place from events)) select user_id, count(*) as hits, round(avg(gap), 4) as mean_gap, round(var_samp(gap), 2) as var_gap, cast(sum(gap) as bigint) as span from g group by user_id")
def gap_statistics(spark: SparkSession, d: str) -> DataFrame:
    found = gaps.gap_statistics(gaps.position_gaps(_hits(spark, d).select("user_id", "place").distinct(), "user_id", "place"), "user_id")
    return found.select("user_id", "hits", _r("mean_gap", 4), _r("var_gap", 2), "span")


_LETTERS = "translate(regexp_replace(coalesce(text, ''), '[^A-Za-z]', ''{}), 'nN', 'aA')"


@_query(f"""with s as (select doc_id, lang, {_LETTERS.format(", 'g'")} as seq from documents), c as (select doc_id, lang, length(seq) as size, unnest(range(1, length(seq) + 1)) as i, seq from s),
    w as (select lang, i, size, sum(case when substr(seq, i, 1) in ('G', 'C', 'g', 'c') then 1 else 0 end) over (partition by doc_id order by i rows between current row and 99 following) as gc from c)
    select lang as species, cast(gc as int) as gc, count(*) as n from w where i < size - 100 group by 1, 2""")
def gc_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 100 over the letters of all texts, N's taken for A's."""
    own = bridge.table(spark, d, "documents").select(F.col("lang").alias("species"), F.expr(_LETTERS.format("")).alias("seq"))
    return gc_training.window_histogram(own)


@_query("select lang as name, cast(sum(length(text)) as bigint) as length, round(sum(length(regexp_replace(text, '[^GCgc]', '', 'g'))) / sum(length(text))::double, 6) as gc from documents group by lang")
def sequence_stats(spark: SparkSession, d: str) -> DataFrame:
    return prep.sequence_stats(bridge.table(spark, d, "documents").selectExpr("lang as name", "text as seq")).select("name", "length", _r("gc"))


@_query("select p_name as name, concat_ws('_', split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) as match, 2 as n_words from part where p_partkey % 3 = 0 and exists (select 1 from part q where q.p_partkey % 3 <> 0 and concat_ws('_', split_part(q.p_name, ' ', 1), split_part(q.p_name, ' ', 2)) = concat_ws('_', split_part(part.p_name, ' ', 1), split_part(part.p_name, ' ', 2))) group by 1, 2, 3")
def longest_prefix_match(spark: SparkSession, d: str) -> DataFrame:
    part = bridge.table(spark, d, "part")
    known = part.where("p_partkey % 3 <> 0").selectExpr("concat_ws('_', slice(split(p_name, ' '), 1, 2)) as name", "1 as source").distinct()
    return prep.longest_prefix_match(part.where("p_partkey % 3 = 0").selectExpr("p_name as name").distinct(), known)


@_query("select concat('u', cast(p_partkey as string)) as accession, case when p_partkey % 5 = 0 then 's__unclassed' else p_brand end as species from part")
def strain_species(spark: SparkSession, d: str) -> DataFrame:
    part = bridge.table(spark, d, "part").selectExpr("concat('u', cast(p_partkey as string)) as accession", "p_brand as species", "p_partkey")
    return prep.strain_species(part.select("accession"), part.where("p_partkey % 5 <> 0").select("accession", "species")).select("accession", "species")


@_query("select o_custkey as accession, o_orderpriority as path from (select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from orders) where rn = 1")
def first_writer_paths(spark: SparkSession, d: str) -> DataFrame:
    return prep.first_paths(bridge.table(spark, d, "orders").selectExpr("o_custkey as accession", "o_orderpriority as path", "o_orderkey as source_order"))


@_query(_genes_sql("select sample, concat(cluster, chr(9), cast(raw_count as string)) as line from (select sample, species as cluster, count(*) as raw_count from named group by 1, 2)"))
def profile_lines(spark: SparkSession, d: str) -> DataFrame:
    counts = counting.counted(_named(spark, d), "species").withColumn("rel_abun", F.col("raw_count"))
    return sinks.formatted(counts)


@_query("select l_returnflag as sample, concat(case when l_suppkey < 1 then '#' else '' end, cast(l_suppkey as string), chr(9), 'species', chr(9), 'p', chr(9), 'n', chr(9), printf('%.6f', sum(l_quantity))) as line from lineitem group by l_returnflag, l_suppkey")
def cami_rows(spark: SparkSession, d: str) -> DataFrame:
    profile = _supplier_profile(spark, d).select("sample", F.col("taxid").cast("string").alias("taxid"), F.lit("species").alias("rank"), F.lit("p").alias("taxpath"), F.lit("n").alias("taxpathsn"), F.col("abundance").alias("percentage"))
    return sinks.cami_rows(profile).select("sample", "line")


# -- further operators -----------------------------------------------------------------------------


@_query("select sample, qname, any_value(rname) as rname from alignments group by 1, 2 having count(*) = 1", "alignments")
def single_records(spark: SparkSession, d: str) -> DataFrame:
    return pairs.singles(bridge.alignments(spark, d)).select("sample", "qname", "rname")


@_query(
    """select read_name, seq1, seq2 from (select cast(l_orderkey as string) as read_name, count(*) filter (where l_linenumber = 1) as n1, count(*) filter (where l_linenumber = 2) as n2,
    max(case when l_linenumber = 1 then cast(l_partkey as string) end) as seq1, max(case when l_linenumber = 2 then cast(l_partkey as string) end) as seq2
    from lineitem where l_linenumber <= 2 group by 1) where n1 <= 1 and n2 <= 1"""
)
def mate_join(spark: SparkSession, d: str) -> DataFrame:
    """Mates by name; orphans stay, names with a mate twice go."""
    reads = bridge.table(spark, d, "lineitem").where("l_linenumber <= 2").selectExpr("0 as sample_id", "'g' as rg", "'s' as sm", "cast(l_orderkey as string) as read_name", "l_linenumber as mate", "cast(l_partkey as string) as seq", "'I' as qual")
    return pairs.mated_reads(reads).select("read_name", "seq1", "seq2")


@_query("select b.species, b.accession, coalesce(cast(s.taxid as string), '-1') as taxid from (select p_brand as species, concat('A', cast(min(p_partkey) as string)) as accession from part group by 1) b left join (select concat('A', cast(p_partkey as string)) as accession, p_size as taxid from part where p_partkey % 2 = 0) s on s.accession = b.accession")
def species_first_accession(spark: SparkSession, d: str) -> DataFrame:
    part = bridge.table(spark, d, "part")
    first = part.groupBy(F.col("p_brand").alias("species")).agg(F.concat(F.lit("A"), F.min("p_partkey").cast("string")).alias("accession"))
    taxids = part.where("p_partkey % 2 = 0").selectExpr("concat('A', cast(p_partkey as string)) as accession", "p_size as taxid")
    return prep.species_taxids(first.select("species"), first, taxids).select("species", "accession", "taxid")


@_query("select c_mktsegment as name, 'species' as rank, count(distinct c_nationkey) as n from customer group by 1 having count(distinct c_nationkey) > 1")
def ambiguous_names(spark: SparkSession, d: str) -> DataFrame:
    names = bridge.table(spark, d, "customer").selectExpr("c_mktsegment as name", "'species' as rank", "c_nationkey as taxid")
    return ncbi.ambiguous_names(names.select("name", "rank").distinct(), names)


@_query("select sample, path as cluster, round(abundance, 6) as abundance from rows where abundance > 0 and depth = 3 union all select sample, concat(path, '|', child_prefix, substr(clade, 4), '_unclassified'), round(unclassified, 6) from rows where unclassified > 0", extra=_EMITTED)
def profile_tips(spark: SparkSession, d: str) -> DataFrame:
    clades, rolled = _rolled(spark, d, 2000)
    return reports.biom_tips(taxonomy.emitted(rolled, clades)).select("sample", "cluster", _r("abundance"))
