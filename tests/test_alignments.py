"""Sources and predicates on hand-made SAM and FASTQ text."""

import gzip

import pytest
from pyspark.sql import functions as F

from cladespark.functions import alignment as al
from cladespark.functions import gc, lineage
from cladespark.operators import align, counting, pairs
from cladespark.plans import profile
from cladespark.plans.options import Layout, Level, Options, Pipeline, SequencingMode, parse
from cladespark.sinks import reports
from cladespark.sources import fastq, references, sam


def line(qname, flag, rname, pos=10, mapq=30, cigar="100M", tlen=0, md="100", rg="s1", seq="ACGT"):
    return "\t".join([qname, str(flag), rname, str(pos), str(mapq), cigar, "*", "0", str(tlen), seq, "*", f"RG:Z:{rg}", f"MD:Z:{md}"])


def parsed(spark, lines, **more):
    return sam.parsed_sam(spark.createDataFrame([(x,) for x in lines], "value string"), **more).withColumn("sample", al.sample_tag(F.col("rg")))


def test_sam_lines(spark):
    rows = parsed(spark, ["@HD\tVN:1.6", line("a", 0, "g1"), line("b", 4, "g1"), "short\tline", line("c", "x", "g1"), line("d", 2048, "g2", rg="s2")]).collect()
    assert {(r["qname"], r["sample"], r["md"], r["flag"]) for r in rows} == {("a", "s1", "100", 0), ("d", "s2", "100", 2048)}
    assert parsed(spark, ["@x"]).count() == 0


def test_filters(spark):
    lines = [line("ok", 0, "g"), line("low", 0, "g", mapq=5), line("edge", 0, "g", mapq=6), line("second", 256, "g"), line("supp", 2048, "g")]
    assert {r["qname"] for r in counting.filtered(parsed(spark, lines)).collect()} == {"ok", "edge", "supp"}


@pytest.mark.parametrize(
    ("cigar", "md", "identity", "length", "run", "run_xeq"),
    [
        ("100M", "100", 1.0, 100, 100, 100), ("10S40M2I58M", "50A47", 0.97, 98, 58, 58), ("*", None, 0.0, 0, 0, 0),
        ("30=1X10D59M", "30A59", 0.89, 90, 59, 59), ("100M", None, 0.0, 100, 100, 100), ("50=", "50", 1.0, 50, 0, 50), ("100M", "80T0", 0.8, 100, 100, 100),
    ],
)
def test_measures(spark, cigar, md, identity, length, run, run_xeq):
    row = spark.createDataFrame([(cigar, md)], "cigar string, md string").select(
        al.identity(F.col("cigar"), F.col("md")).alias("i"), al.align_len(F.col("cigar")).alias("l"), al.max_match_run(F.col("cigar")).alias("r"), al.max_match_run(F.col("cigar"), True).alias("x")
    ).first()
    assert (round(row["i"], 9), row["l"], row["r"], row["x"]) == (identity, length, run, run_xeq)


def test_pairs(spark):
    lines = [
        line("p", 1 | 2 | 64, "g1", tlen=300), line("p", 1 | 2 | 128, "g1", tlen=-300), line("alone", 1 | 64, "g1"),
        line("three", 1 | 64, "g1"), line("three", 1 | 128, "g1"), line("three", 1 | 128, "g2"), line("twice", 1 | 64, "g1"), line("twice", 1 | 64, "g2"),
        line("far", 1 | 64, "g1"), line("far", 1 | 128, "g3"),
    ]
    merged = pairs.merged(parsed(spark, lines), ["rname", "flag", "pos", "cigar", "md", "tlen"])
    assert {(r["qname"], r["paired"], r["proper"]) for r in merged.collect()} == {("p", True, True), ("alone", False, False), ("far", True, False)}
    assert [tuple(r) for r in pairs.insert_sizes(merged).collect()] == [(300, 1)]
    assert pairs.fitted_insert_size(pairs.insert_sizes(merged)) == (300, 2)
    assert {r["qname"] for r in pairs.singles(parsed(spark, lines)).collect()} == {"alone"}


def test_pair_counting(spark):
    genes = spark.createDataFrame([(1, "g1", 1000, "s__A", 0.5), (2, "g2", 1000, "s__A", 0.5), (3, "g3", 1000, "s__B", 0.5)], "gene_id int, gene string, length int, species string, gc double")
    lines = [
        line("proper", 1 | 2 | 64, "g1"), line("proper", 1 | 2 | 128, "g1"),
        line("within", 1 | 64, "g1"), line("within", 1 | 128, "g2"),
        line("across", 1 | 64, "g1", pos=900), line("across", 1 | 128, "g3", pos=10), line("alone", 1 | 64, "g1"),
    ]
    named = counting.with_gene(parsed(spark, lines), genes).withColumn("read_len", F.lit(100))
    merged = pairs.merged(named, ["rname", "flag", "pos", "cigar", "md", "species", "gene_len", "read_len"])
    by_species = {r["cluster"]: r["n"] for r in pairs.pair_clusters(merged).groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    assert by_species == {"s__A": 3}  # proper, within, and the end of "across" that lies near its gene's end
    by_gene = {r["cluster"]: r["n"] for r in pairs.pair_clusters(merged, "markers").groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    assert by_gene == {"g1": 2}


def test_unknown_genes(spark):
    genes = spark.createDataFrame([(1, "g1", 500, None, 0.5)], "gene_id int, gene string, length int, species string, gc double")
    rows = counting.with_gene(parsed(spark, [line("a", 0, "g1"), line("b", 0, "none")]), genes).select("qname", "species", "gene_len").collect()
    assert {tuple(r) for r in rows} == {("a", "Unknown", 500), ("b", "s__unclassed", 0)}
    counts = counting.with_relative(counting.with_abundance(counting.counted(counting.with_gene(parsed(spark, [line("b", 0, "none")]), genes), "species"), genes.selectExpr("species as cluster", "length")))
    assert [(r["abundance"], r["rel_abun"]) for r in counts.collect()] == [(0.0, 0.0)]


def test_gc_weight(spark):
    import math

    p = gc.BUILTIN
    for read, genome in ((50.0, 0.4), (20.0, 0.99), (70.0, 0.0)):
        c = p[0] * math.exp(-0.5 * ((read - p[1]) / p[2]) ** 2) + p[3] + p[4] * read + p[5] * read**2 + p[6] * read**3 + p[7] * (math.log(genome) if genome else 0)
        expected = 1 / max(0.1, c) if genome else 0.0
        assert spark.range(1).select(gc.gc_weight(F.lit(read), F.lit(genome))).first()[0] == pytest.approx(expected)
    assert spark.range(1).select(gc.gc_percent(F.lit("GgCcAATT"))).first()[0] == 50.0
    assert reports.model_from_json(reports.model_json(gc.GcModel())) == gc.GcModel()


def test_fastq_sources(spark, tmp_path):
    text = "@r1/1\nACGT\n+\nIIII\n@r2 2:N:0\nGGGG\n+\n@III\n@cut\nAC\n"
    (tmp_path / "a.fq").write_text(text)
    with gzip.open(tmp_path / "b.fq.gz", "wt") as file:
        file.write("@@r3/2\nTTTT\n+\nIIII\n")
    rows = fastq.read_fastq(spark, [str(tmp_path / "a.fq"), str(tmp_path / "b.fq.gz")]).collect()
    assert {(r["read_name"], r["mate"], r["seq"], r["qual"]) for r in rows} == {("r1", 1, "ACGT", "IIII"), ("r2", 2, "GGGG", "@III"), ("r3", 2, "TTTT", "IIII")}
    (tmp_path / "list.tsv").write_text(f"g1\tS1\t{tmp_path}/a.fq\nbad\ng2\tS2\tx.fq\t{tmp_path}/b.fq.gz\n")
    samples = fastq.fastq_samples(spark, str(tmp_path / "list.tsv"))
    found = fastq.with_samples(fastq.read_fastq(spark, [str(tmp_path / "a.fq"), str(tmp_path / "b.fq.gz")]), samples)
    assert {(r["read_name"], r["sm"], r["sample_id"]) for r in found.collect()} == {("r1", "S1", 0), ("r2", "S1", 0), ("r3", "S2", 1)}


@pytest.mark.parametrize("split", [7, 31, 64, 1000])
def test_fastq_splits(spark, tmp_path, split):
    records = [(f"@read{i}", "ACGT" * (i % 5 + 1), "@+I#" * (i % 5 + 1)) for i in range(40)]
    (tmp_path / "x.fq").write_text("".join(f"{h}\n{s}\n+\n{q}\n" for h, s, q in records))
    spark.dataSource.register(fastq.FastqSource)
    rows = spark.read.format("fastq").option("paths", str(tmp_path / "x.fq")).option("splitBytes", split).load().collect()
    assert sorted((r["head"], r["seq"], r["qual"]) for r in rows) == sorted(records)


def test_references(spark, tmp_path):
    (tmp_path / "genes.tsv").write_text("1\tg1\t900\tsp one\t0.4\n2\tg2\t800\tsp two\nbad\tline\n")
    assert [(r["gene"], r["length"], r["gc"]) for r in references.read_genes(spark, str(tmp_path / "genes.tsv")).orderBy("gene").collect()] == [("g1", 900, 0.4), ("g2", 800, None)]
    (tmp_path / "m.json").write_text('{"m1": {"clade": "s__A", "len": 10, "ext": ["X"], "score": 1.0}, "m2": {"len": 5}}')
    assert [tuple(r) for r in references.read_markers(spark, str(tmp_path / "m.json")).select("marker", "clade", "len", "ext").collect()] == [("m1", "s__A", 10, ["t__X"])]
    (tmp_path / "f.fa").write_text(">one first\nACGT\nGG\n>two plasmid\nTTTT\n")
    assert {(r["name"], r["seq"]) for r in references.read_fasta(spark, str(tmp_path / "f.fa")).collect()} == {("one", "ACGTGG"), ("two", "TTTT")}
    (tmp_path / "names.dmp").write_text("1\t|\troot\t|\t\t|\tscientific name\t|\n1\t|\tall\t|\t\t|\tsynonym\t|\n")
    assert [tuple(r) for r in references.read_names(spark, str(tmp_path / "names.dmp")).collect()] == [(1, "root")]
    xml = '<r><DocSum><Item Name="AccessionVersion">A1</Item><Item Name="TaxId">9</Item></DocSum></r>'
    assert [tuple(r) for r in references.parsed_accessions(spark.createDataFrame([(xml,)], "value string")).collect()] == [("A1", 9)]
    assert sam.split_paths("a,b{1,2},c") == ["a", "b{1,2}", "c"]


def test_profile_files(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "c1", 60.0), ("s1", "c2", 40.0), ("s2", "c1", 100.0)], "sample string, cluster string, rel_abun double")
    path = reports.write_profiles(rows, str(tmp_path / "out"))
    rows = spark.read.text(path).select("value", "sample").collect()
    assert {(r["sample"], r["value"]) for r in rows} == {("s1", "c1\t60.0"), ("s1", "c2\t40.0"), ("s2", "c1\t100.0")}


def test_options():
    assert parse(["-s", "l", "-o", "out", "-r", "m", "-g", "g", "--level", "marker"]).level is Level.MARKERS
    found = Options(output="o", sam_list="s", pipeline=Pipeline.MEPH, layout=Layout.CAMI, marker_json="m", taxonomy_json="t").resolved()
    assert found.pipeline is Pipeline.MEPHN and found.mode is SequencingMode.SINGLE
    for bad in (Options(), Options(output="o"), Options(output="o", sam_list="s"), Options(output="o", sam_list="s", fastq_list="f")):
        with pytest.raises(ValueError):
            bad.resolved()


def test_aligner(spark):
    assert align.aligner_arguments("-N 1 -x own --rg-id=q --very-fast -p 9", "idx", "r.tab5", "o.sam", "g", "s") == ["-N", "1", "--very-fast", "-x", "idx", "-p", "1", "--no-hd", "--rg-id", "g", "--rg", "SM:s", "--tab5", "r.tab5", "-S", "o.sam"]
    reads = spark.createDataFrame([(0, "g", "s", f"r{i}", "ACGT", "IIII", None, None) for i in range(5)], "sample_id int, rg string, sm string, read_name string, seq1 string, qual1 string, seq2 string, qual2 string")
    lines = align.aligned(reads, lambda rows, rg, sm: (f"{r[0]}\t{r[1]}" for r in rows)).collect()
    assert {r["line"] for r in lines} == {f"r{i}\tACGT" for i in range(5)}
    gene = "ACGTACCGTTAGGCTAACGGATCCATTG"
    hits = align.seed_alignments(spark.createDataFrame([("r", gene[5:25])], "read_name string, seq string"), spark.createDataFrame([("g", gene), ("h", "T" * 40)], "gene string, seq string"), 12).collect()
    assert [(r["gene"], r["pos"]) for r in hits] == [("g", 6)]


def test_fastq_run(spark, tmp_path):
    """From a FASTQ list by a program that reads tab5 rows to reports, for one paired and one single sample list."""
    program = tmp_path / "aligner"
    program.write_text("""#!/usr/bin/env python3
import sys
rg = sys.argv[sys.argv.index("--rg-id") + 1]
print("@HD")
for row in sys.stdin:
    name, *rest = row.rstrip("\\n").split("\\t")
    for k in range(0, len(rest), 2):
        flag = 0 if len(rest) == 2 else 1 + 2 + (64 if k == 0 else 128)
        print("\\t".join([name, str(flag), "g1" if rest[k].startswith("A") else "g2", "5", "30", "4M", "*", "0", "0", rest[k], "*", "MD:Z:4", "RG:Z:" + rg]))
""")
    program.chmod(0o755)
    files = [tmp_path / f"x{k}.fq" for k in (1, 2)]
    for k, file in enumerate(files):
        file.write_text("".join(f"@r{i}/{k + 1}\n{'ACGT' if i % 3 else 'CCGT'}\n+\nIIII\n" for i in range(9)))
    (tmp_path / "list").write_text(f"rg1\tsample1\t{files[0]}\t{files[1]}\n")
    (tmp_path / "genes").write_text("1\tg1\t100\ts__a\t0.5\n2\tg2\t50\ts__b\t0.5\n")
    (tmp_path / "genomes").write_text("s__a\t100\t0.5\ns__b\t100\t0.4\n")
    own = align.process_aligner(str(program), "index")
    options = Options(output=str(tmp_path / "out"), fastq_list=str(tmp_path / "list"), reference_matrix=str(tmp_path / "genes"), species_genomes=str(tmp_path / "genomes"), min_align_len=4, parts_per_sample=2, aligner_index="index")
    where = profile.run(spark, options, own)
    rows = {tuple(r["value"].split("\t")) for r in spark.read.text(where).collect()}
    assert {(c, round(float(x), 6)) for c, x in rows} == {("s__a", round(600 / 9, 6)), ("s__b", round(300 / 9, 6))}
    assert spark.read.text(f"{tmp_path}/out/sam_list").first()["value"].split("\t")[:2] == ["rg1", "sample1"]
    names = reports.named_files(spark, where, "app")
    assert names and all("/app-Profiling-SAMPLE_sample1.abundance" in n for n in names) and spark.read.text(names).count() == 2
    single = Options(output=str(tmp_path / "one"), fastq_list=str(tmp_path / "list"), reference_matrix=str(tmp_path / "genes"), species_genomes=str(tmp_path / "genomes"), min_align_len=4, mode=SequencingMode.SINGLE, skip_profiling=True)
    assert profile.run(spark, single, own) == f"{tmp_path}/one" and spark.read.text(f"{tmp_path}/one/sam").count() == 18
    with pytest.raises(Exception, match="ended with"):
        list(align.process_aligner("false", "i")([("r", "A", "I", None, None)], "g", "s"))


def test_recalibrated_pairs(spark):
    lines = [line(f"p{i}", 1 | 2 | k, "g1", seq="GGCC" if k == 64 else "ATAT") for i in range(3) for k in (64, 128)]
    genes = spark.createDataFrame([("g1", 100, "s__a", 0.5)], "gene string, length int, species string, gc double")
    genomes = spark.createDataFrame([("s__a", 1000, 0.5)], "species string, genome_len int, genome_gc double")
    options = Options(output="o", gc_recalibration=True, min_align_len=10)
    row = profile.profile_pairs(parsed(spark, lines), genes, genomes, options).first()
    weight = spark.range(1).select(gc.gc_weight(F.lit(50.0), F.lit(0.5))).first()[0]
    assert row["raw_count"] == 3 and row["recal_count"] == pytest.approx(3 * weight)
    plain = profile.profile_pairs(parsed(spark, lines), genes, genomes, Options(output="o", min_align_len=10)).first()
    assert plain["recal_count"] == 3.0


def test_database_versions():
    import bz2
    import json
    import pickle

    pack = lambda taxonomy: bz2.compress(pickle.dumps({"markers": {"m1": {"clade": "s__a", "ext": {"b", "a"}, "len": 5}}, "taxonomy": taxonomy}))
    markers, taxonomy = references.database_tables(pack({"k__x": 7}), "2018", {"m1": "new"})
    assert json.loads(markers) == {"new": {"clade": "s__a", "ext": ["a", "b"], "len": 5}} and json.loads(taxonomy) == {"k__x": {"genoLen": 7}}
    assert json.loads(references.database_tables(pack({"k__x": 7}), "0000")[0]).keys() == {"m1"}
    assert json.loads(references.database_tables(pack({"k__x": ("2", 7)}), "2019")[1]) == {"k__x": {"taxid": "2", "genoLen": 7}}
    with pytest.raises(ValueError):
        references.database_tables(pack({}), "1999")
    with pytest.raises(KeyError):
        references.database_tables(pack({}), "2018", {})


def test_names(spark):
    row = spark.range(1).select(lineage.clean_species(F.lit("Bacillus subtilis (old)")), lineage.without_version(F.lit("AB.12")), lineage.assembly_accession(F.lit("x/GCF_0001.2_y")), lineage.rank_level(F.lit("genus")), lineage.next_letter(F.lit("g")), F.size(lineage.padded_taxids(F.array(F.lit("1"))))).first()
    assert tuple(row) == ("Bacillus_subtilis", "AB", "GCF_0001.2", 5, "s", 8)
