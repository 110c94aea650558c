"""Queries of sources, sinks, GC training and gaps: rows are written as files and read back, or trained and tested, beside their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bridge
from .catalog import _EMITTED, _KEPT_SQL, _MATCHED, _SPAN, _genes_sql, _named, _query, _r, _rolled, _supplier_nodes, _supplier_profile, _tree
from .functions import alignment as al
from .functions import gc, lineage
from .operators import align, counting, evaluate, gaps, gc_training, pairs, prep, reports, statistics, taxonomy
from .plans import profile as plans
from .sinks import reports as sinks
from .sources import fastq, references, sam
from .storage import new_path


def _written(rows: DataFrame, name: str) -> str:
    """Lines (one column) as text files in the shared folder."""
    path = new_path(rows.sparkSession, name)
    rows.write.text(path)
    return path


def _lines(spark: SparkSession, d: str, table: str, line: str, where: str = "true") -> DataFrame:
    return bridge.table(spark, d, table).where(where).selectExpr(f"{line} as value")


# -- sequences and samples -------------------------------------------------------------------------


@_query("select concat('r', cast(o_orderkey as string)) as read_name, cast(1 + o_orderkey % 2 as int) as mate, concat(o_orderstatus, 'ACGT') as seq, concat('@', o_orderpriority) as qual from orders")
def fastq_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Records written as FASTQ, with qualities that begin like a header, and read again."""
    record = "concat('@r', cast(o_orderkey as string), '/', cast(1 + o_orderkey % 2 as string), '\\n', o_orderstatus, 'ACGT\\n+\\n@', o_orderpriority)"
    return fastq.read_fastq(spark, [_written(_lines(spark, d, "orders", record), "fastq")]).select("read_name", "mate", "seq", "qual")


@_query("select concat('c', cast(c_custkey as string), '_1_', c_mktsegment) as read_name, cast(null as int) as mate, 'ACGT' as seq, 'IIII' as qual from customer")
def fastq_singles(spark: SparkSession, d: str) -> DataFrame:
    record = "concat('@@c', cast(c_custkey as string), ' 1 ', c_mktsegment, '\\nACGT\\n+\\nIIII')"
    return fastq.read_fastq(spark, [_written(_lines(spark, d, "customer", record), "fastq")], paired=False).select("read_name", "mate", "seq", "qual")


@_query("select c_name as read_name, cast(coalesce(r_regionkey, -1) as int) as sample_id, coalesce('rg' || cast(r_regionkey as string), concat('f5_', cast(1 + c_custkey % 2 as string))) as rg, coalesce(r_name, concat('f5_', cast(1 + c_custkey % 2 as string))) as sm, case when r_regionkey is not null then cast(1 + c_custkey % 2 as int) end as mate from customer left join region on r_regionkey = c_nationkey % 6")
def fastq_samples(spark: SparkSession, d: str) -> DataFrame:
    """A sample list written and read; reads of a file that isn't in it are a sample of their own."""
    entry = "concat_ws('\\t', concat('rg', cast(r_regionkey as string)), r_name, concat('in/f', cast(r_regionkey as string), '_1.fq'), concat('in/f', cast(r_regionkey as string), '_2.fq'))"
    listed = bridge.table(spark, d, "region").orderBy("r_regionkey").coalesce(1).selectExpr(f"{entry} as value")
    samples = fastq.fastq_samples(spark, _written(listed.unionByName(spark.createDataFrame([("too\tfew",)], "value string")).coalesce(1), "samples"))
    reads = bridge.table(spark, d, "customer").selectExpr("concat('/data/f', cast(c_nationkey % 6 as string), '_', cast(1 + c_custkey % 2 as string), '.fq') as file", "c_name as read_name", "cast(null as int) as mate", "'A' as seq", "'I' as qual")
    return fastq.with_samples(reads, samples).select("read_name", "sample_id", "rg", "sm", "mate")


_RECORDS = "select o_orderkey as rec_no, o_orderstatus as seq, o_orderpriority as qual from orders"


@_query(f"select a.rec_no, concat('m', cast(a.rec_no as string)) as name, a.seq as seq1, a.qual as qual1, b.seq as seq2, b.qual as qual2 from ({_RECORDS}) a join ({_RECORDS} where o_orderkey % 4 <> 0) b on a.rec_no = b.rec_no")
def mates_by_number(spark: SparkSession, d: str) -> DataFrame:
    """Numbered lines of two files, of which the second lacks each fourth record, joined and sorted by record."""

    def file(where: str) -> DataFrame:
        part = F.expr("array(concat('@m', cast(o_orderkey as string)), o_orderstatus, '+', o_orderpriority)")
        lines = bridge.table(spark, d, "orders").where(where).select("o_orderkey", F.posexplode(part).alias("k", "value"))
        return fastq.by_line_number(lines.select((F.col("o_orderkey") * 4 + F.col("k")).alias("line"), "value"))

    return fastq.joined_by_record(file("true"), file("o_orderkey % 4 <> 0"), ordered=True)


@_query("select sample, qname, rname, cast(dense_rank() over (order by sample) - 1 as int) as sample_id from (select * from alignments where sample <> 'NO' and (flag & 4) = 0)", "alignments")
def listed_samples(spark: SparkSession, d: str) -> DataFrame:
    """Alignments of files, by a written list of samples that lacks one file."""
    own = bridge.alignments(spark, d).where("flag & 4 = 0").withColumn("file", F.concat(F.lit("/in/"), "sample", F.lit(".sam"))).withColumnRenamed("sample", "tag")
    names = own.select("tag").distinct().where("tag <> 'NO'").orderBy("tag").coalesce(1)
    listed = names.selectExpr("concat_ws('\\t', 'rg', tag, concat('/other/', tag, '.sam')) as value")
    return sam.with_listed_sample(own, sam.sam_samples(spark, _written(listed, "samples"))).select("sample", "qname", "rname", "sample_id")


@_query("select concat('rg', cast(n_nationkey as string)) as rg, n_name as sm, concat('/x/', n_name) as path from nation")
def sam_list_files(spark: SparkSession, d: str) -> DataFrame:
    """A list of SAM files written by the sink and read by the source."""
    rows = bridge.table(spark, d, "nation").selectExpr("concat('rg', cast(n_nationkey as string)) as rg", "n_name as sm", "concat('/x/', n_name) as path")
    return sam.sam_samples(spark, sinks.write_sam_list(rows, new_path(spark, "sam-list"))).select("rg", "sm", "path")


@_query("select concat('@SQ', chr(9), 'SN:', gene, chr(9), 'LN:', cast(length as string)) as value from genes", "genes")
def sam_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return sam.dictionary(bridge.genes(spark, d))


# -- reference tables ------------------------------------------------------------------------------


@_query("select cast(p_partkey as int) as gene_id, p_name as gene, p_size as length, case when p_size % 3 <> 0 then p_brand end as species, case when p_partkey % 2 = 0 then p_size / 100.0::double end as gc from part where p_partkey % 7 <> 0")
def gene_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Genes in four or five columns; rows of three columns go, an empty species is none."""
    line = "concat_ws('\\t', cast(p_partkey as string), p_name, cast(p_size as string), if(p_partkey % 7 = 0, null, if(p_size % 3 <> 0, p_brand, '')), if(p_partkey % 2 = 0 and p_partkey % 7 <> 0, cast(p_size / 100D as string), null))"
    return references.read_genes(spark, _written(_lines(spark, d, "part", line), "genes"))


@_query("select species, genome_len, round(genome_gc, 6) as genome_gc from genomes", "genomes")
def species_genomes(spark: SparkSession, d: str) -> DataFrame:
    """Genomes whose GC is written in percent."""
    line = "concat_ws('\\t', species, cast(genome_len as string), cast(genome_gc * 100 as string), 'other')"
    path = _written(bridge.genomes(spark, d).selectExpr(f"{line} as value"), "genomes")
    return references.read_species_genomes(spark, path, "percent").select("species", "genome_len", _r("genome_gc"))


@_query("select lineage, geno_len, case when geno_len % 2 = 0 then concat('1|2|', cast(geno_len as string)) end as taxid from taxonomy", "taxonomy")
def taxonomy_json(spark: SparkSession, d: str) -> DataFrame:
    """Lineages written as one JSON object each, of the layout with taxids and that without."""
    entry = "to_json(map(lineage, named_struct('genoLen', geno_len, 'taxid', if(geno_len % 2 = 0, concat('1|2|', cast(geno_len as string)), null)))) as value"
    return references.parsed_taxonomy(bridge.taxonomy(spark, d).selectExpr(entry))


@_query("select cast(p_partkey as string) as marker from part where p_partkey % 5 <> 0")
def excluded_list(spark: SparkSession, d: str) -> DataFrame:
    """A list with empty lines and repeated names, taken from the markers."""
    names = _lines(spark, d, "part", "concat(' ', cast(p_partkey as string))", "p_partkey % 5 = 0")
    path = _written(names.unionByName(names).unionByName(spark.createDataFrame([("",), (" ",)], "value string")), "excluded")
    return bridge.markers(spark, d).select("marker").join(references.read_excluded(spark, path), "marker", "left_anti")


@_query("select concat('g', cast(p_partkey as string)) as name, concat('g', cast(p_partkey as string), ' a>b ', p_name) as header, concat(replace(p_name, ' ', ''), 'ACGT', p_type) as seq from part")
def fasta_records(spark: SparkSession, d: str) -> DataFrame:
    """Sequences on several lines, under headers that hold a > themselves."""
    record = "concat('>g', cast(p_partkey as string), ' a>b ', p_name, '\\n', replace(p_name, ' ', ''), '\\nACGT\\r\\n', p_type)"
    return references.read_fasta(spark, _written(_lines(spark, d, "part", record), "fasta"))


@_query("select concat('GCF_', cast(s_suppkey as string)) as accession, 'c4' as category, cast(s_suppkey as string) as taxid, 'c6' as species_taxid, s_name as organism, 'c8' as strain, 'c17' as paired_accession, 'c19' as ftp_path from supplier")
def assembly_summary(spark: SparkSession, d: str) -> DataFrame:
    columns = ["concat('GCF_', cast(s_suppkey as string))", *[f"'c{k}'" for k in range(1, 5)], "cast(s_suppkey as string)", "'c6'", "s_name", *[f"'c{k}'" for k in range(8, 21)]]
    lines = _lines(spark, d, "supplier", f"concat_ws('\\t', {', '.join(columns)})").unionByName(spark.createDataFrame([("# a header",), ("too\tfew",)], "value string"))
    return references.read_assemblies(spark, _written(lines, "assemblies"))


@_query("select cast(s_suppkey as bigint) as taxid, cast(s_nationkey as bigint) as parent, 'species' as rank from supplier")
def ncbi_nodes(spark: SparkSession, d: str) -> DataFrame:
    line = "concat_ws('\\t|\\t', cast(s_suppkey as string), cast(s_nationkey as string), 'species', 'XX\\t|')"
    return references.read_nodes(spark, _written(_lines(spark, d, "supplier", line), "nodes"))


@_query("select cast(s_suppkey as bigint) as taxid, s_name as name from supplier where s_suppkey % 2 = 0")
def ncbi_names(spark: SparkSession, d: str) -> DataFrame:
    """Each second name is a synonym."""
    line = "concat_ws('\\t|\\t', cast(s_suppkey as string), s_name, '', if(s_suppkey % 2 = 0, 'scientific name\\t|', 'synonym\\t|'))"
    return references.read_names(spark, _written(_lines(spark, d, "supplier", line), "names"))


@_query("select cast(s_suppkey as bigint) as old, cast(s_nationkey as bigint) as new from supplier")
def ncbi_merged(spark: SparkSession, d: str) -> DataFrame:
    line = "concat(cast(s_suppkey as string), '\\t|\\t', cast(s_nationkey as string), '\\t|')"
    return references.read_merged(spark, _written(_lines(spark, d, "supplier", line), "merged"))


@_query("select cast(c_custkey as string) as taxid, 'species' as rank, '1|2' as taxpath, c_name as taxpathsn, c_acctbal as percentage from customer where c_custkey % 2 = 0")
def cami_profile(spark: SparkSession, d: str) -> DataFrame:
    """Rows at one rank of a profile with header lines."""
    line = "concat_ws('\\t', cast(c_custkey as string), if(c_custkey % 2 = 0, 'species', 'genus'), '1|2', c_name, cast(c_acctbal as string))"
    lines = _lines(spark, d, "customer", line).unionByName(spark.createDataFrame([("@SampleID:s",), ("",), ("#x\ty",), ("@@TAXID\tRANK\tTAXPATH\tTAXPATHSN\tPERCENTAGE",)], "value string"))
    return references.read_cami(spark, _written(lines, "cami"), "species")


@_query("select c_name as cluster, c_acctbal as abundance from customer")
def abundance_file(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(spark, d, "customer", "concat_ws('\\t', c_name, 'between', cast(c_acctbal as string))").unionByName(spark.createDataFrame([("#SampleID\ts",), ("alone",)], "value string"))
    return references.read_abundances(spark, _written(lines, "abundances"))


@_query("select concat('A', cast(s_suppkey as string), '.1') as accession, cast(s_nationkey as bigint) as taxid from supplier")
def xml_accessions(spark: SparkSession, d: str) -> DataFrame:
    """Batches of summaries, one for each nation."""
    one = "concat('<DocSum><Item Name=\"AccessionVersion\" Type=\"String\">A', cast(s_suppkey as string), '.1</Item><Item Name=\"TaxId\">', cast(s_nationkey as string), '</Item></DocSum>')"
    batches = bridge.table(spark, d, "supplier").selectExpr("s_nationkey", f"{one} as x").groupBy("s_nationkey").agg(F.concat(F.lit("<R>"), F.array_join(F.collect_list("x"), ""), F.lit("</R>")).alias("value"))
    return references.parsed_accessions(batches.select("value"))


@_query("select concat('A', cast(o_custkey as string)) as accession, count(*) as n, cast(o_custkey % 7 as bigint) as taxid from orders group by o_custkey")
def checked_accessions(spark: SparkSession, d: str) -> DataFrame:
    """Accessions with taxids, none of which is missing."""
    orders = bridge.table(spark, d, "orders")
    counts = orders.groupBy(F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("accession")).agg(F.count("*").alias("n"))
    ids = orders.selectExpr("concat('A', cast(o_custkey as string)) as accession", "cast(o_custkey % 7 as bigint) as taxid").distinct()
    return prep.checked_taxids(counts, ids).select("accession", "n", "taxid")


# -- reports ---------------------------------------------------------------------------------------

_WHOLE = "select sample, species as cluster, count(*) as raw_count from named group by 1, 2"


@_query(_genes_sql(f"select sample, concat_ws(chr(9), cluster, cast(raw_count as string), cast(raw_count * 2 as string), cast(raw_count + 1 as string), cast(raw_count % 10 as string)) as line from ({_WHOLE})"))
def profile_files(spark: SparkSession, d: str) -> DataFrame:
    """Detailed reports written by sample and read back."""
    counts = counting.counted(_named(spark, d), "species").select("sample", "cluster", "raw_count", (F.col("raw_count") * 2).alias("recal_count"), (F.col("raw_count") + 1).alias("abundance"), (F.col("raw_count") % 10).alias("rel_abun"))
    path = sinks.write_profiles(counts, new_path(spark, "profiles"), "detailed")
    return spark.read.schema("line string, sample string").text(path).select("sample", "line")


@_query(_genes_sql(f"select distinct sample, '#cluster' || chr(9) || 'rel_abun' as line from named union all select sample, concat(cluster, chr(9), cast(raw_count as string)) from ({_WHOLE})"))
def headed_files(spark: SparkSession, d: str) -> DataFrame:
    """Reports under a header, one file a sample under the name that readers look for."""
    counts = counting.counted(_named(spark, d), "species").withColumn("rel_abun", F.col("raw_count"))
    path = sinks.write_profiles(counts, new_path(spark, "profiles"), header=True, parts=1)
    files = sinks.named_files(spark, path, "app")
    named = spark.read.text(files).select(F.regexp_extract(F.col("_metadata.file_path"), "app-Profiling-SAMPLE_(.*)\\.abundance$", 1).alias("sample"), F.col("value").alias("line"))
    return named


_CAMI_SQL = """select line from (values ('@SampleID:A'), ('@Version:0.9.1'), ('@Ranks:superkingdom|species'), (''), ('@@TAXID' || chr(9) || 'RANK' || chr(9) || 'TAXPATH' || chr(9) || 'TAXPATHSN' || chr(9) || 'PERCENTAGE')) h(line)
    union all select concat(case when l_suppkey < 1 then '#' else '' end, cast(l_suppkey as string), chr(9), 'species', chr(9), 'p', chr(9), 'n', chr(9), printf('%.6f', sum(l_quantity))) from lineitem where l_returnflag = 'A' group by l_suppkey"""


@_query(_CAMI_SQL)
def cami_report(spark: SparkSession, d: str) -> DataFrame:
    """One sample's report with its header, written and read back."""
    rows = _supplier_profile(spark, d).select("sample", F.col("taxid").cast("string").alias("taxid"), F.lit("species").alias("rank"), F.lit("p").alias("taxpath"), F.lit("n").alias("taxpathsn"), F.col("abundance").alias("percentage"))
    return spark.read.text(sinks.write_cami(rows, new_path(spark, "cami"), "A", ["superkingdom", "species"])).withColumnRenamed("value", "line")


@_query("select cast(l_suppkey as bigint) as taxid, cast(sum(l_quantity) as bigint) as abundance from lineitem where l_returnflag = 'A' group by 1")
def taxid_abundances(spark: SparkSession, d: str) -> DataFrame:
    rows = _supplier_profile(spark, d).where("sample = 'A'").withColumn("abundance", F.col("abundance").cast("long"))
    return spark.read.csv(sinks.write_taxid_abundances(rows, new_path(spark, "taxids")), sep="\t", schema="taxid long, abundance long")


@_query(_genes_sql("select sample, species as cluster, cast(('0x' || substr(md5(qname), 1, 6))::int % 8 as int) as part, string_agg(qname, ',' order by qname) as names from named group by 1, 2, 3"))
def read_name_parts(spark: SparkSession, d: str) -> DataFrame:
    """All names, with each cluster's dealt to eight lists."""
    return counting.read_names(_named(spark, d), "species", 8)


_READS = "select a.sample, qname, c.clade from alignments a join cells c on c.sample = a.sample and c.marker = a.rname where " + _KEPT_SQL


@_query(_READS, "cells")
def reads_map(spark: SparkSession, d: str) -> DataFrame:
    return reports.reads_of_clades(_tree(spark, d)[2], counting.filtered(bridge.alignments(spark, d)))


@_query(
    """select sample, marker, cast(reads * 1000 / len::double > 40 as int) as present from cells where clade like '%Brand1%' and sample not in (
    select sample from (select sample, c.clade, sum(reads) / (sum(sum(reads)) over (partition by sample))::double * 100 as rel from cells c group by sample, c.clade) where clade like '%Brand1' and rel < 0.3)""",
    "cells",
)
def strain_markers(spark: SparkSession, d: str) -> DataFrame:
    cells = _tree(spark, d)[2]
    sums = cells.groupBy("sample", "clade").agg(F.sum("reads").alias("reads"))
    return reports.strain_tracker(cells, counting.with_relative(sums, "reads"), "Brand1", 40, 0.3)


_TAXIDS = """ids as (select lineage, concat('1|', cast(10 + geno_len % 7 as string), '|', cast(geno_len as string)) as taxid from taxonomy),
    paths as (select split_part(lineage, '|', 1) as cluster, min(split_part(taxid, '|', 1)) as taxpath, min(split_part(taxid, '|', 1)) as taxid, 'superkingdom' as rank from ids group by 1
    union all select concat(split_part(lineage, '|', 1), '|', split_part(lineage, '|', 2)), min(concat(split_part(taxid, '|', 1), '|', split_part(taxid, '|', 2))), min(split_part(taxid, '|', 2)), 'phylum' from ids group by 1),
    reads as (select sample, c.path as cluster, sum(r.reads) as read_sum from cells r join clades c on c.clade = r.clade group by 1, 2),
    known_rows as (select sample, split_part(cluster, '|', 1) as cluster, sum(read_sum) as read_sum from reads group by 1, 2 union all select sample, concat(split_part(cluster, '|', 1), '|', split_part(cluster, '|', 2)), sum(read_sum) from reads group by 1, 2),
    totals as (select sample, count(*) as total from alignments group by sample)"""


@_query(
    bridge.with_views("", "cells").rstrip() + ",\n" + _TAXIDS + """
    select sample, p.taxid, p.rank, p.taxpath, regexp_replace(o.cluster, '[kpcofgs]__', '', 'g') as taxpathsn, cast(read_sum as double) as percentage from known_rows o join paths p on p.cluster = o.cluster
    union all select t.sample, '-1', null, '-1', 'UNKNOWN', round((total - known) / total::double * 100, 6) from totals t join (select sample, sum(read_sum) as known from known_rows where cluster not like '%|%' group by sample) k on k.sample = t.sample where total > known"""
)
def cami_taxids(spark: SparkSession, d: str) -> DataFrame:
    """Clades with paths of taxids, strains left out, and a row for the reads that no clade explains."""
    clades, _, cells = _tree(spark, d)
    reads = cells.join(clades.select("clade", "path"), "clade").select("sample", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("path", r"\|"))), lambda k: F.array_join(F.slice(F.split("path", r"\|"), 1, k), "|"))).alias("cluster"), "reads")
    profile = reads.groupBy("sample", "cluster").agg(F.sum("reads").cast("double").alias("read_sum")).withColumn("rel_abun", F.col("read_sum"))
    lineages = bridge.taxonomy(spark, d).withColumn("taxid", F.expr("concat('1|', cast(10 + geno_len % 7 as string), '|', cast(geno_len as string))"))
    total = bridge.alignments(spark, d).groupBy("sample").agg(F.count("*").alias("total"))
    return plans.with_taxids(profile, lineages, total).select("sample", "taxid", "rank", "taxpath", "taxpathsn", _r("percentage"))


# -- alignments ------------------------------------------------------------------------------------

_GOOD = f"round({_MATCHED} / ({_SPAN})::double, 9) >= 0.85"


@_query(
    f"""select sample, qname, r1, r2, paired and r1 and r2 as paired, proper and r1 and r2 as proper from (
    select sample, qname, bool_or((n = 1 or (flag & 64) > 0) and good) as r1, bool_or(n = 2 and (flag & 128) > 0 and good) as r2, max(n) = 2 as paired, max(n) = 2 and bool_and((flag & 2) > 0) as proper
    from (select *, {_GOOD} as good, count(*) over w as n, count(*) filter (where (flag & 64) > 0) over w as n1, count(*) filter (where (flag & 128) > 0) over w as n2 from alignments window w as (partition by sample, qname))
    where n = 1 or (n = 2 and n1 = 1 and n2 = 1) group by sample, qname) where r1 or r2""",
    "alignments",
)
def good_ends(spark: SparkSession, d: str) -> DataFrame:
    merged = pairs.merged(bridge.alignments(spark, d), ["rname", "flag", "pos", "cigar", "md"])
    found = pairs.with_good_ends(merged, 0.85, 30)
    return found.select("sample", "qname", F.col("r1").isNotNull().alias("r1"), F.col("r2").isNotNull().alias("r2"), "paired", "proper")


_TRAINED = f"(flag & 4) = 0 and {_MATCHED} / ({_SPAN})::double >= 0.87"


@_query(f"select sample, qname, rname, pos from alignments where {_TRAINED}", "alignments")
def training_reads(spark: SparkSession, d: str) -> DataFrame:
    return gc_training.training_reads(bridge.alignments(spark, d), 0.87).select("sample", "qname", "rname", "pos")


@_query("select qname as name, count(*) as n from alignments group by 1", "alignments")
def mate_suffixes(spark: SparkSession, d: str) -> DataFrame:
    """Names written with the suffix of their mate."""
    named = bridge.alignments(spark, d).select(F.concat("qname", F.lit("/"), F.when(al.has(F.col("flag"), al.FIRST), "1").otherwise("2")).alias("written"))
    return named.groupBy(al.without_mate_suffix(F.col("written")).alias("name")).agg(F.count("*").alias("n"))


@_query("select read_name, concat_ws(chr(9), read_name, seq1, 'I', seq2, case when seq2 is not null then 'I' end) as line from (select cast(l_orderkey as string) as read_name, max(case when l_linenumber = 1 then cast(l_partkey as string) end) as a, max(case when l_linenumber = 2 then cast(l_partkey as string) end) as b, coalesce(a, b) as seq1, case when a is not null then b end as seq2 from lineitem where l_linenumber <= 2 group by 1 having count(*) filter (where l_linenumber = 1) <= 1 and count(*) filter (where l_linenumber = 2) <= 1)")
def tab5_rows(spark: SparkSession, d: str) -> DataFrame:
    """Mates put together as the rows that an aligner reads."""
    reads = bridge.table(spark, d, "lineitem").where("l_linenumber <= 2").selectExpr("0 as sample_id", "'g' as rg", "'s' as sm", "cast(l_orderkey as string) as read_name", "l_linenumber as mate", "cast(l_partkey as string) as seq", "'I' as qual")
    return align.tab5(pairs.mated_reads(reads)).select(F.split("line", "\t")[0].alias("read_name"), "line")


@_query("select 'rg' as rg, 's' || cast(r_regionkey as string) as sm, concat(cast(c_custkey as string), chr(9), 'ACGT') as line from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey")
def aligner_lines(spark: SparkSession, d: str) -> DataFrame:
    """Reads handed to an aligner that says their names and sequences, three parts a sample."""
    own = bridge.table(spark, d, "customer").join(bridge.table(spark, d, "nation"), F.expr("n_nationkey = c_nationkey"))
    reads = own.selectExpr("'rg' as rg", "concat('s', cast(n_regionkey as string)) as sm", "cast(c_custkey as string) as read_name", "'ACGT' as seq1", "'IIII' as qual1", "cast(null as string) as seq2", "cast(null as string) as qual2")
    return align.aligned(reads, lambda rows, rg, sm: (f"{r[0]}\t{r[1]}" for r in rows), 3)


@_query(
    _genes_sql(
        """select sample, cluster, cast(case when nothing then 0 else coalesce(sum(reads) filter (where kept), 0) end as bigint) as raw_count, round(case when nothing or coalesce(sum(len) filter (where kept), 0) = 0 then 0.0 else sum(reads) filter (where kept) / (sum(len) filter (where kept))::double end, 6) as abundance
        from (select *, place >= floor(0.1::double * n) and place < n - floor(0.1::double * n) as kept, (cluster like 't%' or contains(cluster, '_sp')) and nonzero < 0.7::double * n as nothing
          from (select sample, cluster, len, reads, count(*) over w as n, count(*) filter (where reads > 0) over w as nonzero, row_number() over (partition by sample, cluster order by reads / len::double, gene) - 1 as place from genes_of window w as (partition by sample, cluster)))
        group by sample, cluster, nothing""",
        genes_of="select sample, concat(case when species = 'Brand#3' then 't__' else '' end, species) as cluster, rname as gene, max(gene_len) as len, case when cast(rname as bigint) % 3 = 0 then 0 else count(*) end as reads from named where gene_len > 0 group by 1, 2, 3",
    )
)
def gene_trimmed_average(spark: SparkSession, d: str) -> DataFrame:
    """Species by their genes; each third gene has no reads, which one species may not have."""
    named = _named(spark, d).where("gene_len > 0").withColumn("cluster", F.expr("concat(if(species = 'Brand#3', 't__', ''), species)"))
    genes = named.groupBy("sample", "cluster", F.col("rname").alias("gene")).agg(F.max("gene_len").alias("len"), F.count("*").alias("reads")).withColumn("reads", F.expr("if(cast(gene as bigint) % 3 = 0, 0L, reads)"))
    found = statistics.gene_trimmed_average(genes.withColumn("weight", F.col("reads").cast("double")))
    return found.select("sample", "cluster", "raw_count", _r("abundance"))


@_query(
    """with rows_ as (select c_custkey as row_id, cast(c_nationkey as string) as taxid, concat('1|', cast(c_custkey % 40 as string)) as taxpath, concat('a|', c_mktsegment) as taxpathsn from customer),
    truth as (select cast(n_nationkey as string) as taxid, case when n_nationkey = 6 then 'BUILDING' when n_nationkey = 9 then 'MACHINERY' else n_name end as species from nation where n_nationkey % 3 = 0)
    select row_id, coalesce(t.taxid, (select min(p.taxid) from truth p where list_contains(string_split(r.taxpath, '|'), p.taxid)), (select min(p.taxid) from truth p where list_contains(string_split(r.taxpathsn, '|'), p.species))) as truth_id from rows_ r left join truth t on t.taxid = r.taxid"""
)
def truth_by_path(spark: SparkSession, d: str) -> DataFrame:
    """Truth species by taxid, else by the taxid path, else by the name path."""
    rows = bridge.table(spark, d, "customer").selectExpr("c_custkey as row_id", "cast(c_nationkey as string) as taxid", "concat('1|', cast(c_custkey % 40 as string)) as taxpath", "concat('a|', c_mktsegment) as taxpathsn")
    truth = bridge.table(spark, d, "nation").where("n_nationkey % 3 = 0").selectExpr("cast(n_nationkey as string) as taxid", "case when n_nationkey = 6 then 'BUILDING' when n_nationkey = 9 then 'MACHINERY' else n_name end as species")
    return evaluate.truth_species(rows, truth).select("row_id", "truth_id")


# -- names and GC ----------------------------------------------------------------------------------


@_query(
    """select p_partkey, case p_type when 'ECONOMY' then 5 when 'PROMO' then 6 end as level, case when p_partkey % 3 = 0 then 's' when p_partkey % 3 = 1 then 't' end as below, concat(p_brand, ',', p_type, ',') as ids,
    replace(p_name, ' ', '_') as species, concat('AB', cast(p_partkey as string)) as accession, concat('GCF_', cast(p_partkey as string), '.', cast(p_partkey % 10 as string)) as assembly, round(round(p_size / 7.0::double * 100, 5), 4) as percent from part"""
)
def clade_names(spark: SparkSession, d: str) -> DataFrame:
    own = bridge.table(spark, d, "part")
    key = F.col("p_partkey").cast("string")
    rank = F.expr("case p_type when 'ECONOMY' then 'genus' when 'PROMO' then 'species' else 'no rank' end")
    letter = F.expr("case p_partkey % 3 when 0 then 'g' when 1 then 't' else 'x' end")
    return own.select(
        "p_partkey", lineage.rank_level(rank).alias("level"), lineage.next_letter(letter).alias("below"),
        F.array_join(lineage.padded_taxids(F.array("p_brand", "p_type"), 3), ",").alias("ids"),
        lineage.clean_species(F.concat("p_name", F.lit(" (old name)"))).alias("species"), lineage.without_version(F.concat(F.lit("AB"), key, F.lit(".12"))).alias("accession"),
        lineage.assembly_accession(F.concat(F.lit("x/GCF_"), key, F.lit("."), (F.col("p_partkey") % 10).cast("string"), F.lit("_y"))).alias("assembly"), F.round(lineage.percent_rounded(F.col("p_size") / 7.0), 4).alias("percent"),
    )


@_query("select p_partkey, round(length(regexp_replace(p_name, '[^GCgc]', '', 'g')) * 100.0::double / length(p_name), 6) as read_gc from part")
def read_gc(spark: SparkSession, d: str) -> DataFrame:
    return bridge.table(spark, d, "part").select("p_partkey", F.round(gc.gc_percent(F.col("p_name")), 6).alias("read_gc"))


_SPAN_LEN = "list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[M=XDN]', 1), lambda x: cast(x as bigint)))"
_START = f"case when (flag & 16) > 0 then pos + {_SPAN_LEN} - 1 - 20 else pos end"


@_query(f"select qname, rname, cast({_START} as bigint) as start from alignments", "alignments")
def read_windows(spark: SparkSession, d: str) -> DataFrame:
    own = bridge.alignments(spark, d)
    return own.select("qname", "rname", gc_training.read_start(F.col("flag"), F.col("pos"), F.col("cigar"), 20).cast("long").alias("start"))


#: Each part's letters as a sequence of 300, without N.
_SEQ = "substr(repeat(concat(upper(replace(p_name, ' ', '')), p_type, 'GCA', cast(p_partkey as string)), 30), 1, 300)"
_SEQUENCES = f"select cast(p_partkey as string) as species, translate({_SEQ}, 'N', case when p_partkey % 11 = 0 then 'N' else 'A' end) as seq from part"
_WINDOWS = f"""seqs as ({_SEQUENCES}), spots as (select species, seq, unnest(range(1, 280)) as start from seqs),
    windows as (select species, start, case when length(regexp_replace(substr(seq, start, 20), '[^N]', '', 'g')) > 4 then -1 else cast(length(regexp_replace(substr(seq, start, 20), '[^GC]', '', 'g')) * 5 as int) end as gc from spots)"""


def _sequences(spark: SparkSession, d: str) -> DataFrame:
    return bridge.table(spark, d, "part").selectExpr("cast(p_partkey as string) as species", f"translate({_SEQ}, 'N', if(p_partkey % 11 = 0, 'N', 'A')) as seq")


@_query(f"with {_WINDOWS} select species, start, gc from windows")
def gc_windows(spark: SparkSession, d: str) -> DataFrame:
    return gc_training.window_gc(_sequences(spark, d), 20)


@_query(f"with {_WINDOWS} select species, gc, count(*) as n from windows where gc >= 0 group by 1, 2")
def gc_window_histogram(spark: SparkSession, d: str) -> DataFrame:
    return gc_training.window_histogram(_sequences(spark, d), 20)


_POINTS = f"""hits as (select rname as species, gc, count(*) as reads from (select rname, {_START} as start from alignments where {_TRAINED}) a join windows w on w.species = a.rname and w.start = a.start where gc >= 0 and a.start > 0 group by 1, 2),
    n as (select species, gc, count(*) as n from windows where gc >= 0 group by 1, 2),
    of_species as (select n.species, sum(n.n) as windows, coalesce(sum(h.reads), 0) as own from n left join hits h on h.species = n.species and h.gc = n.gc group by 1),
    overall as (select sum(own) / count(*)::double as per_species from of_species),
    points as (select n.species, n.gc, coalesce(h.reads, 0) / n.n::double / (per_species / windows::double) as coverage from n left join hits h on h.species = n.species and h.gc = n.gc join of_species s on s.species = n.species cross join overall)"""


@_query(bridge.with_views("", "alignments").rstrip() + f",\n{_WINDOWS}, {_POINTS} select species, gc, 0.4::double as genome_gc, round(coverage, 6) as coverage from points")
def gc_training_points(spark: SparkSession, d: str) -> DataFrame:
    """Points written as the table that a fit elsewhere reads, and read back."""
    genomes = _sequences(spark, d).selectExpr("species", "0.4D as genome_gc")
    reads = gc_training.training_reads(bridge.alignments(spark, d), 0.87).withColumn("species", F.col("rname"))
    points = gc_training.training_points(reads, _sequences(spark, d), genomes, 20)
    path = sinks.write_table(points, new_path(spark, "points"))
    return spark.read.csv(path, sep="\t", schema="species string, gc int, genome_gc double, coverage double").select("species", "gc", "genome_gc", _r("coverage"))


@_query()
def gc_trained_model(spark: SparkSession, d: str) -> DataFrame:
    """The whole training run; the coefficients, as its file has them, a row each."""
    genomes = _sequences(spark, d).selectExpr("species", "0.3D + cast(species as int) % 40 / 100D as genome_gc")
    _, model = gc_training.train(bridge.alignments(spark, d), _sequences(spark, d), genomes, 20, 0.87)
    found = sinks.model_from_json(sinks.model_json(model))
    return spark.createDataFrame([(k + 1, float(x)) for k, x in enumerate(found.coefficients)], "coefficient int, value double")


# -- gaps ------------------------------------------------------------------------------------------

_LEN = 86_400
_PLACES = "select user_id, cast(floor(epoch_us(ts) / 1000000) as bigint) as place from events"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return bridge.table(spark, d, "events").select("user_id", F.expr("cast(floor(unix_micros(to_timestamp(ts)) / 1000000) as bigint)").alias("place"))


_DISTANCE = f"""p as (select user_id, place % {_LEN} as x, row_number() over (partition by user_id order by place) as k from ({_PLACES})),
    distance as (select a.user_id, avg(least(abs(a.x - b.x), {_LEN} - abs(a.x - b.x))) as mean_distance from p a join p b on a.user_id = b.user_id and a.k < b.k group by 1),
    h as (select user_id, count(*) as hits from p group by 1)"""


@_query(f"with {_DISTANCE} select h.user_id, hits, round(mean_distance, 4) as mean_distance, round(4 * mean_distance, 3) as size, round(hits / (hits + 2 * sqrt(hits)) * 4 * mean_distance, 3) as low, round(case when hits > 4 then hits / (hits - 2 * sqrt(hits)) * 4 * mean_distance end, 3) as high from h left join distance d on d.user_id = h.user_id")
def genome_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Mean distance of hits on a circle of a day, and the size that it speaks for."""
    found = gaps.mean_circular_distance(_events(spark, d).withColumn("size", F.lit(_LEN)), "user_id", "place", "size")
    return found.join(gaps.genome_sizes(found, "user_id"), "user_id").select("user_id", "hits", _r("mean_distance", 4), _r("size", 3), _r("low", 3), _r("high", 3))


#: Student's two-sided p-value for whole degrees of freedom, as a finite sum.
_STUDENT = """case when df % 2 = 0 then 1 - sin(th) * list_sum(list_transform(range(0, df // 2), lambda k: exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1.0) + 2 * k * ln(cos(th)))))
    else 1 - 2 / pi() * (th + case when df > 1 then sin(th) * list_sum(list_transform(range(0, (df - 1) // 2), lambda k: exp(0.5 * ln(pi()) - ln(2.0) + lgamma(k + 1.0) - lgamma(k + 1.5) + (2 * k + 1) * ln(cos(th))))) else 0 end) end"""
_DAYS = 30 * _LEN


@_query(
    f"""with g as (select user_id, place, place - lag(place) over (partition by user_id order by place) as gap from ({_PLACES})),
    s as (select user_id, count(*) as hits, avg(gap) as mean_gap, var_samp(gap) as var_gap, count(*) filter (where gap < 10) / count(*)::double as close_share from g group by 1),
    x as (select *, {_DAYS} * (0.5 + user_id % 10 / 10.0::double) as genome_len, {_DAYS} * (user_id % 7) / 5.0::double as high from s),
    t as (select *, cast(hits - 2 as bigint) as df, atan(abs(mean_gap - genome_len / hits) / sqrt(var_gap / (hits - 1)) / sqrt(hits - 2)) as th from x),
    v as (select *, {_STUDENT} as p from t)
    select user_id, hits, round(p, 6) as p_value, case when hits < 5 then 'few' when hits > 5000 then 'keep' when p < 0.01 then 'uneven' when high / genome_len < 0.1 then 'island' when hits <= 200 and close_share > 0.75 then 'clustered' when high / genome_len < 0.5 then 'questionable' else 'keep' end as verdict from v"""
)
def island_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Gaps of events against what an even spread over spans of several lengths would show."""
    found = gaps.gap_statistics(gaps.position_gaps(_events(spark, d), "user_id", "place"), "user_id")
    found = found.withColumn("high", F.expr(f"{_DAYS} * (user_id % 7) / 5D"))
    lengths = found.select("user_id", F.expr(f"{_DAYS} * (0.5D + user_id % 10 / 10D)").alias("genome_len"))
    return gaps.island_filter(found, lengths, "user_id").select("user_id", "hits", _r("p_value"), "verdict")


@_query(_genes_sql("select n.species, count(*) as reads, round(sum(1 / (0.5 + read_gc / 100)), 4) as normalised, round(sum(1 / (0.5 + read_gc / 100)) * 1e6 / genome_len) as per_mb from named n join genomes g on g.species = n.species group by n.species, genome_len having count(*) >= 5"))
def reads_per_megabase(spark: SparkSession, d: str) -> DataFrame:
    hits = _named(spark, d).select("species", (0.5 + F.col("read_gc") / 100).alias("coverage"))
    return gaps.gc_normalised(hits, bridge.genomes(spark, d)).select("species", "reads", _r("normalised", 4), "per_mb")


# -- roll-up of species ----------------------------------------------------------------------------

#: Reads of each sample, by the user's word.
_TOTAL_READS = 20_000


@_query(
    f"""select e.sample, cluster, round(rel_abun * least(1.0::double, coalesce(mapped, 0) / {_TOTAL_READS}::double), 6) as rel_abun from emitted e left join mapped m on m.sample = e.sample
    union all select t.sample, 'UNKNOWN', round((1 - least(1.0::double, coalesce(mapped, 0) / {_TOTAL_READS}::double)) * 100, 6) from totals t left join mapped m on m.sample = t.sample""",
    extra=_EMITTED | {"mapped": "select sample, sum(read_sum) as mapped from rolled where clade like 's%' group by sample"},
)
def unknown_rows(spark: SparkSession, d: str) -> DataFrame:
    """Clades as shares of all reads, with a row for those that no species explains."""
    clades, rolled = _rolled(spark, d, 2000)
    return plans.with_unknown(taxonomy.emitted(rolled, clades), rolled, _TOTAL_READS).select("sample", "cluster", _r("rel_abun"))


@_query()
def sorted_rows(spark: SparkSession, d: str) -> DataFrame:
    """The report of all clades in its order: by depth, then by falling abundance."""
    clades, rolled = _rolled(spark, d, 2000)
    return reports.sorted_report(taxonomy.emitted(rolled, clades)).select("sample", "cluster", _r("rel_abun"))
