"""The driver's tables seen as alignments, genes, markers and taxonomies.

The expressions are the same text for Spark and for DuckDB, so both sides of a check start from the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.counting import filtered

_MISMATCHES = "cast(round(l_discount * 100) as int)"
ALIGNMENT = {
    "sample": "concat(l_returnflag, l_linestatus)",
    "qname": "concat('r', cast(l_orderkey as string))",
    "flag": "cast(1 + case when l_orderkey % 11 = 0 then 4 else 0 end + case when l_suppkey % 2 = 0 then 16 else 0 end + case when l_linenumber % 2 = 1 then 64 else 128 end + case when l_linenumber = 7 then 256 else 0 end + case when l_discount < 0.05 then 2 else 0 end as int)",
    "rname": "cast(l_partkey as string)",
    "pos": "cast(cast(floor(l_extendedprice) as bigint) % 97 + 1 as int)",
    "mapq": "cast(floor(l_quantity) as int)",
    "cigar": "case when l_linenumber % 3 = 0 then '100M' when l_linenumber % 3 = 1 then '40M2I58M5S' else '30=1X10D59M' end",
    "md": f"concat(cast(60 - {_MISMATCHES} as string), repeat('A0', {_MISMATCHES}), 'C30')",
    "tlen": "cast(cast(floor(l_extendedprice) as bigint) % 500 * (case when l_suppkey % 2 = 0 then -1 else 1 end) as int)",
    "read_len": "cast(100 as int)",
    "read_gc": "cast(20 + l_orderkey % 61 as double)",
    "line": "l_orderkey * 10000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber",
}
GENE = {"gene": "cast(p_partkey as string)", "length": "p_size * 10", "species": "p_brand", "gc": "cast(30 + p_partkey % 41 as double) / 100"}
_KINGDOM = "case cast(substr(p_brand, 7) as int) % 4 when 0 then 'k__Archaea' when 1 then 'k__Bacteria' when 2 then 'k__Eukaryota' else 'k__Viruses' end"
_SPECIES = "concat('s__', replace(p_brand, '#', ''))"
_STRAIN = "concat('t__', replace(p_brand, '#', ''), '_', p_type)"
LINEAGE = f"concat({_KINGDOM}, '|', {_SPECIES}, '|', {_STRAIN})"
MARKER = {"marker": "cast(p_partkey as string)", "clade": f"case when p_partkey % 2 = 1 then {_STRAIN} else {_SPECIES} end", "len": "p_size * 10"}
#: Records that are placed on markers: those that pass the operators' own filter.
KEPT_SQL = "(flag & 4) = 0 and (flag & 256) = 0 and mapq > 5"


def _select(expressions: dict[str, str]) -> list[str]:
    return [f"{e} as {n}" for n, e in expressions.items()]


def sql_select(expressions: dict[str, str], table: str) -> str:
    return f"select {', '.join(_select(expressions))} from {table}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_select(ALIGNMENT))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*_select(GENE))


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("species")).agg(F.sum("p_size").alias("genome_len"), ((30 + F.count("*") % 41) / 100).alias("genome_gc"))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr(f"{LINEAGE} as lineage", "p_size")
    return rows.groupBy("lineage").agg((F.sum("p_size") * 100).alias("geno_len"))


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each seventh marker occurs also in the strain of the part after it."""
    part = table(spark, sf_dir, "part")
    own = part.selectExpr("p_partkey", *_select(MARKER))
    other = part.selectExpr("p_partkey - 1 as p_partkey", f"{_STRAIN} as strain").where("p_partkey % 7 = 0")
    return own.join(other, "p_partkey", "left").selectExpr("marker", "clade", "len", "if(strain is null, cast(array() as array<string>), array(strain)) as ext")


def marker_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered(alignments(spark, sf_dir)).groupBy("sample", F.col("rname").alias("marker")).agg(F.count("*").alias("reads"))


#: The same tables in SQL, by name; each may use those before it.
VIEWS = {
    "alignments": sql_select(ALIGNMENT, "lineitem"),
    "genes": sql_select(GENE, "part"),
    "genomes": "select p_brand as species, cast(sum(p_size) as bigint) as genome_len, (30 + count(*) % 41) / 100.0 as genome_gc from part group by p_brand",
    "taxonomy": f"select {LINEAGE} as lineage, cast(sum(p_size) * 100 as bigint) as geno_len from part group by 1",
    "markers": f"""select {MARKER['marker']} as marker, {MARKER['clade']} as clade, {MARKER['len']} as len,
        case when p.p_partkey % 7 = 0 then o.strain end as ext
        from part p left join (select p_partkey - 1 as k, {_STRAIN} as strain from part) o on o.k = p.p_partkey""",
    "marker_reads": f"select sample, rname as marker, count(*) as reads from alignments where {KEPT_SQL} group by 1, 2",
    "nodes": """select distinct clade, parent, depth, kingdom, path from (
        select split_part(lineage, '|', 1) as clade, null as parent, 1 as depth, split_part(lineage, '|', 1) as kingdom, split_part(lineage, '|', 1) as path from taxonomy
        union all select split_part(lineage, '|', 2), split_part(lineage, '|', 1), 2, split_part(lineage, '|', 1), concat(split_part(lineage, '|', 1), '|', split_part(lineage, '|', 2)) from taxonomy
        union all select split_part(lineage, '|', 3), split_part(lineage, '|', 2), 3, split_part(lineage, '|', 1), lineage from taxonomy)""",
    "clades": "select n.*, coalesce(c.n_children, 0) as n_children, n.clade like '%\\_sp%' escape '\\' as has_sp from nodes n left join (select parent, count(*) as n_children from nodes where parent is not null group by parent) c on c.parent = n.clade",
    "step1": "select c.clade, coalesce(ch.clade, c.clade) as terminal from clades c left join nodes ch on ch.parent = c.clade and c.n_children = 1",
    "placed": "select s.clade, coalesce(ch.clade, s.terminal) as terminal from step1 s join clades c on c.clade = s.terminal left join nodes ch on ch.parent = c.clade and c.n_children = 1",
    "own": "select m.marker, p.terminal as clade, m.len, m.ext from markers m join placed p on p.clade = m.clade",
    "cells": """select h.sample, o.clade, o.marker, o.len, o.ext, coalesce(r.reads, 0) as reads
        from (select distinct r.sample, o.clade from marker_reads r join own o on o.marker = r.marker) h
        join own o on o.clade = h.clade left join marker_reads r on r.sample = h.sample and r.marker = o.marker""",
    "ratios": "select sample, clade, count(*) as n_markers, count(*) filter (where reads > 0) as n_nonzero, count(*) filter (where reads > 0) / count(*)::double as ratio from cells group by sample, clade",
    "flagged": """select distinct c.sample, c.marker from cells c join nodes n on n.clade = c.ext join placed p on p.clade = n.parent
        join ratios r on r.sample = c.sample and r.clade = p.terminal and r.ratio > 0.33""",
    "discards": "select c.*, f.marker is not null as discard from cells c left join flagged f on f.sample = c.sample and f.marker = c.marker",
    "ranked": """select d.*, case when cl.n_children = 0 or cl.kingdom = 'k__Viruses' then 0 else 10 end as need,
        count(*) filter (where not discard) over (partition by sample, d.clade) as n_kept,
        row_number() over (partition by sample, d.clade, discard order by marker) as rn
        from discards d join clades cl on cl.clade = d.clade""",
    "used": "select sample, clade, marker, len, reads, discard from ranked where not discard or rn <= need - n_kept",
    "ordered": """select sample, clade, len::double as len, reads::double as reads, reads::double / len as ratio,
        count(*) over (partition by sample, clade) as n,
        row_number() over (partition by sample, clade order by reads::double / len, marker) - 1 as br,
        row_number() over (partition by sample, clade order by reads, marker) - 1 as bc from used""",
    "cut": "select *, cast(floor(0.1::double * n) as int) as l, n - cast(floor(0.1::double * n) as int) - 1 as r from ordered",
    "stats": """select sample, clade, max(n) as n, max(l) as l, sum(len) as len_sum, sum(reads) as read_sum, count(*) filter (where reads > 0) as nonzero,
        sum(reads) / sum(len) as avg_g, avg(ratio) as avg_l,
        case when max(l) = 0 then sum(reads) / sum(len) else sum(reads) filter (where br between l and r) / sum(len) filter (where br between l and r) end as tavg_g,
        case when max(l) = 0 then avg(ratio) else avg(ratio) filter (where br between l and r) end as tavg_l,
        case when max(l) = 0 then sum(reads) / sum(len) else (max(l) * max(reads) filter (where bc = l) + max(l) * max(reads) filter (where bc = r) + sum(reads) filter (where bc between l and r)) / sum(len) end as wavg_g,
        case when max(l) = 0 then avg(ratio) else (max(l) * max(ratio) filter (where br = l) + max(l) * max(ratio) filter (where br = r) + sum(ratio) filter (where br between l and r)) / max(n) end as wavg_l,
        median(ratio) filter (where br between l and r) as med
        from cut group by sample, clade""",
    "locals": """select s.sample, s.clade, case when s.clade like 't%' and (coalesce(p.n_children, 0) > 1 or coalesce(p.has_sp, false) or c.kingdom = 'k__Viruses') and s.nonzero / s.n::double < 0.7 then 0.0 else s.tavg_g end as local, s.len_sum, s.read_sum
        from stats s join clades c on c.clade = s.clade left join clades p on p.clade = c.parent""",
}


def rolled_views(min_len: int) -> dict[str, str]:
    """Three levels of the roll-up."""
    level = lambda d, below: f"""select sample, clade, {d} as depth, n_children, coalesce(local, 0) as local, coalesce(len_sum, 0) as len_sum, coalesce(read_sum, 0) as read_sum, coalesce(child_sum, 0) as child_sum,
        case when n_children = 0 then coalesce(local, 0) when coalesce(len_sum, 0) < {min_len} then coalesce(child_sum, 0) else greatest(coalesce(local, 0), coalesce(child_sum, 0)) end as abundance, parent
        from (select coalesce(o.sample, k.sample) as sample, coalesce(o.clade, k.clade) as clade, local, len_sum, read_sum, child_sum
          from (select l.* from locals l join clades c on c.clade = l.clade and c.depth = {d}) o
          full join ({below}) k on k.sample = o.sample and k.clade = o.clade) x join clades c using (clade)"""  # noqa: E731
    none = "select sample, clade, 0.0 as child_sum from locals where false"
    sums = lambda t: f"select sample, parent as clade, sum(abundance) as child_sum from {t} where parent is not null group by sample, parent"
    columns = "sample, clade, depth, n_children, abundance, child_sum, case when n_children > 0 and abundance > child_sum then abundance - child_sum else 0.0 end as unclassified, read_sum"
    return {"level3": level(3, none), "level2": level(2, sums("level3")), "level1": level(1, sums("level2")), "rolled": " union all ".join(f"select {columns} from level{d}" for d in (3, 2, 1))}


def with_views(query: str, last: str | None = None, extra: dict[str, str] | None = None) -> str:
    """A query over the views up to ``last`` (all if there are extra ones)."""
    names = list(VIEWS)
    chosen = {n: VIEWS[n] for n in (names if last is None else names[: names.index(last) + 1])} | (extra or {})
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in chosen.items()) + "\n" + query
