"""Tree rules against a plain recursive version, and hand-made cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cladespark.operators import gaps, gc_training, ncbi, prep, statistics, taxonomy
from cladespark.streaming import live_counts
from cladespark.operators import evaluate
from cladespark.plans import profile
from cladespark.plans.options import Options, Pipeline


def plain_statistic(name, markers):
    """(len, reads, marker) rows to a statistic."""
    n = len(markers)
    total = sum(m[0] for m in markers)
    if not total:
        return 0.0
    cut = int(math.floor(0.1 * n))
    by_ratio = sorted(markers, key=lambda m: (m[1] / m[0], m[2]))
    by_reads = sorted(markers, key=lambda m: (m[1], m[2]))
    ratios = [m[1] / m[0] for m in by_ratio]
    inner, inner_ratios = by_ratio[cut : n - cut], ratios[cut : n - cut]
    plain = {"avg_g": sum(m[1] for m in markers) / total, "avg_l": sum(ratios) / n}
    if name in plain:
        return plain[name]
    if name == "med":
        k = len(inner_ratios)
        return inner_ratios[k // 2] if k % 2 else (inner_ratios[k // 2] + inner_ratios[k // 2 - 1]) / 2
    if not cut:
        return plain["avg_g" if name.endswith("g") else "avg_l"]
    if name == "tavg_g":
        return sum(m[1] for m in inner) / sum(m[0] for m in inner)
    if name == "tavg_l":
        return sum(inner_ratios) / len(inner_ratios)
    if name == "wavg_g":
        reads = [m[1] for m in by_reads[cut : n - cut]]
        return (reads[0] * cut + reads[-1] * cut + sum(reads)) / total
    return (inner_ratios[0] * cut + inner_ratios[-1] * cut + sum(inner_ratios)) / n


def plain_tree(lineages, markers, counts, statistic="tavg_g", min_len=2000):
    """Abundance and what is unclassified of each clade, by recursion."""
    parent, children, kingdom = {}, {}, {}
    for text in lineages:
        parts = text.split("|")
        for i, clade in enumerate(parts):
            children.setdefault(clade, [])
            kingdom[clade] = parts[0]
            if i and clade not in parent:
                parent[clade] = parts[i - 1]
                children[parts[i - 1]].append(clade)

    def terminal(clade):
        while len(children[clade]) == 1:
            clade = children[clade][0]
        return clade

    own = {c: {} for c in children}
    for name, (clade, length, ext) in markers.items():
        own[terminal(clade)][name] = (length, counts.get(name, 0), ext)
    out = {}

    def visit(clade):
        below = sum(visit(c) for c in children[clade])
        kept, gone = [], []
        for name, (length, reads, ext) in sorted(own[clade].items()):
            hit = False
            for strain in ext:
                other = own[terminal(parent[strain])].values()
                hit = hit or (len(other) > 0 and sum(m[1] > 0 for m in other) / len(other) > 0.33)
            (gone if hit else kept).append((length, reads, name))
        if gone:
            need = 0 if not children[clade] or kingdom[clade] == "k__Viruses" else 10
            kept += gone[: max(0, min(need - len(kept), len(gone)))]
        local = plain_statistic(statistic, kept) if kept else 0.0
        if clade.startswith("t") and (len(children[parent[clade]]) > 1 or "_sp" in parent[clade] or kingdom[clade] == "k__Viruses"):
            if not kept or sum(m[1] > 0 for m in kept) / len(kept) < 0.7:
                local = 0.0
        value = local
        if children[clade]:
            value = below if sum(m[0] for m in kept) < min_len else max(local, below)
        out[clade] = (value, value - below if children[clade] and value > below else 0.0)
        return value

    for top in sorted({x.split("|")[0] for x in lineages}):
        visit(top)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_against_recursion(spark, seed):
    rng = random.Random(seed)
    lineages = []
    for g in range(4):
        kingdom = ["k__Bacteria", "k__Viruses"][g % 2]
        for s in range(rng.choice([1, 3])):
            for t in range(rng.choice([1, 1, 3])):
                name = f"s__S{g}{s}" + ("_sp" if s == 2 else "")
                lineages.append(f"{kingdom}|g__G{g}|{name}|t__T{g}{s}{t}")
    strains = [x.split("|")[3] for x in lineages]
    clades = sorted({c for x in lineages for c in x.split("|")[1:]})
    markers = {f"m{i:03d}": (rng.choice(clades), rng.randrange(50, 400), rng.sample(strains, 1) if rng.random() < 0.3 else []) for i in range(220)}
    counts = {m: rng.randrange(1, 30) for m in markers if rng.random() < 0.5}
    tree = taxonomy.clade_tree(spark.createDataFrame([(x,) for x in lineages], "lineage string"))
    frame = spark.createDataFrame([(m, c, n, e) for m, (c, n, e) in markers.items()], "marker string, clade string, len int, ext array<string>")
    reads = spark.createDataFrame([("s", m, n) for m, n in counts.items()], "sample string, marker string, reads long")
    placed = taxonomy.terminals(tree)
    cells = taxonomy.seeded(reads, frame, placed)
    used = taxonomy.refilled(taxonomy.with_discards(cells, tree, placed), tree)
    rolled = taxonomy.rolled_up(taxonomy.local_abundance(used, tree), tree, 1500)
    found = {r["clade"]: (r["abundance"], r["unclassified"]) for r in rolled.collect()}
    for clade, (value, rest) in plain_tree(lineages, markers, counts, min_len=1500).items():
        have = found.get(clade, (0.0, 0.0))
        assert have == pytest.approx((value, rest), abs=1e-9), clade


def test_statistics(spark):
    rng = random.Random(5)
    groups = {n: [(rng.randrange(1, 9) * 10, rng.randrange(0, 5), f"m{i:02d}") for i in range(n)] for n in (1, 2, 9, 10, 25)}
    rows = [(str(n), m, size, reads) for n, markers in groups.items() for size, reads, m in markers]
    found = statistics.clade_statistics(spark.createDataFrame(rows, "g string, marker string, len int, reads long"), ["g"]).collect()
    for row in found:
        for name in statistics.STATISTICS:
            assert row[name] == pytest.approx(plain_statistic(name, groups[int(row["g"])])), (row["g"], name)


def test_empty_tree(spark):
    tree = taxonomy.clade_tree(spark.createDataFrame([("k__Bacteria|s__A",)], "lineage string"))
    frame = spark.createDataFrame([("m", "s__A", 100, [])], "marker string, clade string, len int, ext array<string>")
    reads = spark.createDataFrame([], "sample string, marker string, reads long")
    assert taxonomy.seeded(reads, frame, taxonomy.terminals(tree)).count() == 0


def test_window_gc(spark):
    seq = "GC" * 30 + "AT" * 30 + "N" * 5 + "G" * 60
    rows = {r["start"]: r["gc"] for r in gc_training.window_gc(spark.createDataFrame([("s", seq), ("short", "ACG"), ("none", None)], "species string, seq string"), 20).collect()}
    assert sorted(rows) == list(range(1, len(seq) - 20))
    for start, value in rows.items():
        window = seq[start - 1 : start + 19]
        assert value == (-1 if window.count("N") > 4 else 100 * sum(c in "GC" for c in window) // 20)


def test_training_points_by_pieces(spark, tmp_path, monkeypatch):
    """Reads meet the windows of their species piece by piece, and neither side is broadcast, however small the planner takes it for."""
    monkeypatch.setattr(gc_training, "BLOCK", 16)
    window = 20
    seqs = {"a": "GC" * 30 + "AT" * 30 + "N" * 8 + "G" * 60, "b": "ACGT" * 20, "c": "ACG"}
    spark.createDataFrame(list(seqs.items()), "species string, seq string").write.parquet(f"{tmp_path}/seqs")
    sequences = spark.read.parquet(f"{tmp_path}/seqs")
    starts = [("a", k % 170 + 1) for k in range(400)] + [("a", 1), ("a", 16), ("a", 17), ("a", 10_000), ("b", 3), ("b", 59), ("c", 1), ("d", 1)]
    reads = spark.createDataFrame([(s, 0, p, "20M") for s, p in starts], "species string, flag int, pos int, cigar string")
    wanted = {}
    for species, seq in seqs.items():
        for k in range(max(0, len(seq) - window - 1)):
            part = seq[k : k + window]
            if part.count("N") <= 4:
                cell = wanted.setdefault((species, 100 * sum(c in "GC" for c in part) // window), [0, 0])
                cell[0] += 1
                cell[1] += starts.count((species, k + 1))
    cells = gc_training.window_cells(reads, sequences, window)
    assert "Broadcast" not in cells._jdf.queryExecution().executedPlan().toString()
    assert {(r["species"], r["gc"]): [r["n"], r["reads"]] for r in cells.collect()} == wanted
    genomes = spark.createDataFrame([("a", 0.4), ("b", 0.5)], "species string, genome_gc double")
    points = gc_training.training_points(reads, sequences, genomes, window).collect()
    own = {s: [sum(v[k] for (t, _), v in wanted.items() if t == s) for k in (0, 1)] for s in "ab"}
    mean = (own["a"][1] + own["b"][1]) / 2
    assert {(r["species"], r["gc"]): r["coverage"] for r in points} == {k: pytest.approx(v[1] / v[0] / (mean / own[k[0]][0])) for k, v in wanted.items()}


def test_training_keeps_no_windows(spark, monkeypatch):
    """A training run writes sums by species and GC, not a row for each window."""
    written = {}
    monkeypatch.setattr(gc_training, "stored", lambda frame, name, write=gc_training.stored: written.setdefault(name, write(frame, name)))
    sequences = spark.createDataFrame([("a", "ACGT" * 500)], "species string, seq string")
    reads = spark.createDataFrame([("a", 0, k, "20M", "20") for k in range(1, 50)], "rname string, flag int, pos int, cigar string, md string")
    points, _ = gc_training.train(reads, sequences, spark.createDataFrame([("a", 0.5)], "species string, genome_gc double"), 20)
    assert [r["gc"] for r in points.collect()] == [50]
    assert written["cells"].count() == 1 and "windows" not in written


def test_gc_fit(spark):
    from cladespark.functions.gc import BUILTIN, coverage

    rows = spark.range(20, 80).selectExpr("cast(id as int) as gc").crossJoin(spark.createDataFrame([(0.3,), (0.5,), (0.6,)], "genome_gc double")).selectExpr("'s' as species", "gc", "genome_gc")
    wanted = (1.2, *BUILTIN[1:])
    points = rows.withColumn("coverage", coverage(F.col("gc").cast("double"), F.col("genome_gc"), wanted))
    assert gc_training.fit(points).coefficients[0] == pytest.approx(1.2, rel=1e-3)


def test_lineages(spark):
    nodes = spark.createDataFrame([(1, 1, "root"), (2, 1, "superkingdom"), (3, 2, "clade"), (4, 3, "genus"), (5, 4, "species")], "taxid long, parent long, rank string")
    paths = ncbi.lineages(spark.createDataFrame([(5,)], "taxid long"), nodes)
    assert [(r["step"], r["ancestor"]) for r in paths.orderBy("step").collect()] == [(0, 5), (1, 4), (2, 3), (3, 2)]
    assert [r["ancestor"] for r in ncbi.ranked_lineages(paths).orderBy("step").collect()] == [5, 4, 2]


def test_island_and_sizes(spark):
    hits = spark.createDataFrame([("r", p, 1000) for p in (10, 20, 300, 800)], "ref string, place int, size int")
    row = gaps.mean_circular_distance(hits, "ref", "place", "size").first()
    places, wanted = [10, 20, 300, 800], []
    for i, a in enumerate(places):
        wanted += [min(abs(a - b), 1000 - abs(a - b)) for b in places[:i]]
    assert row["hits"] == 4 and row["mean_distance"] == pytest.approx(sum(wanted) / len(wanted))


def test_circular_distance_over_ranges(spark):
    """Hits in many ranges, at one place and half a circle apart, against pairs."""
    import random

    rng = random.Random(2)
    size = 400_000
    places = [rng.randrange(3 * size) for _ in range(150)] + [7, 7, 7 + size // 2, 65_536, 131_072]
    hits = spark.createDataFrame([("r", p, size) for p in places] + [("one", 5, 10), ("none", None, 10)], "ref string, place int, size int")
    rows = {r["ref"]: r for r in gaps.mean_circular_distance(hits, "ref", "place", "size").collect()}
    folded = [p % size for p in places]
    wanted = [min(abs(a - b), size - abs(a - b)) for i, a in enumerate(folded) for b in folded[:i]]
    assert rows["r"]["hits"] == len(places) and rows["r"]["mean_distance"] == pytest.approx(sum(wanted) / len(wanted))
    assert rows["one"]["mean_distance"] is None and "none" not in rows
    found = sorted((r["place"], r["gap"]) for r in gaps.position_gaps(hits.where("ref = 'r'"), "ref", "place").collect() if r["gap"] is not None)
    ordered = sorted(places)
    assert found == sorted((b, b - a) for a, b in zip(ordered, ordered[1:]))


def test_t_test():
    """p-values from a table of Student's law, and limits that aren't those of the normal law."""
    t, df = [2.776, 4.604, 2.576, 0.0, 1.0, 63.657, 12.706, 0.2], [4, 4, 100000, 7, 1, 1, 1, 30]
    wanted = [0.05, 0.01, 0.01, 1.0, 0.5, 0.01, 0.05, 0.8428]
    assert gaps.t_two_sided(gaps.np.array(t), gaps.np.array(df, float)) == pytest.approx(wanted, abs=2e-4)


def test_verdicts(spark):
    rows = [("few", 4, 9.0, 1.0, 0.0, 900.0), ("many", 6000, 1.0, 1.0, 1.0, 1.0), ("uneven", 5, 20.0, 100.0, 0.0, 900.0), ("even", 5, 120.0, 9000.0, 0.0, 900.0), ("equal", 10, 1.0, 0.0, 0.0, 900.0), ("island", 50, 19.0, 400.0, 0.0, 90.0), ("clustered", 100, 10.0, 25.0, 0.8, 900.0), ("questionable", 100, 10.0, 25.0, 0.7, 499.0)]
    found = gaps.island_filter(spark.createDataFrame(rows, "reference string, hits long, mean_gap double, var_gap double, close_share double, high double"), spark.createDataFrame([(r[0], 1000) for r in rows], "reference string, genome_len int"))
    got = {r["reference"]: r["verdict"] for r in found.collect()}
    assert got == {r[0]: {"many": "keep", "even": "keep", "equal": "keep"}.get(r[0], r[0]) for r in rows}


def test_deep_trees(spark):
    """Lineages of a hundred levels are followed to their ends; a circle of parents is an error."""
    n = 100
    lineage = "k__X|" + "|".join(f"c{i}__{i}" for i in range(n))
    tree = taxonomy.clade_tree(spark.createDataFrame([(lineage, 7.0)], "lineage string, geno_len double"))
    assert {r["terminal"] for r in taxonomy.terminals(tree).collect()} == {f"c{n - 1}__{n - 1}"}
    nodes = spark.createDataFrame([(1, 1, "root")] + [(i + 1, i, "clade") for i in range(1, 70)], "taxid long, parent long, rank string")
    assert ncbi.lineages(spark.createDataFrame([(70,)], "taxid long"), nodes).count() == 69
    short = "k__Bacteria|a__1|b__1|c__1|d__1|e__1|f__1|g__1|h__1|i__1|j__1"
    tree = taxonomy.clade_tree(spark.createDataFrame([(short, 7.0)], "lineage string, geno_len double"))
    lengths = taxonomy.genome_lengths(spark.createDataFrame([(short, 7.0)], "lineage string, geno_len double"), tree)
    assert {r["geno_len"] for r in lengths.collect()} == {7.0} and lengths.count() == 11
    local = spark.createDataFrame([("s", "j__1", 2.0, 5000.0, 10.0)], "sample string, clade string, local double, len_sum double, read_sum double")
    assert {(r["depth"], r["abundance"]) for r in taxonomy.rolled_up(local, tree).collect()} == {(k, 2.0) for k in range(1, 12)}
    ring = spark.createDataFrame([(1, 2, "x"), (2, 1, "x")], "taxid long, parent long, rank string")
    with pytest.raises(ValueError):
        ncbi.lineages(spark.createDataFrame([(1,)], "taxid long"), ring)


def test_prefix_match(spark):
    names = spark.createDataFrame([("Bacillus subtilis str 168",), ("Nothing known",)], "name string")
    known = spark.createDataFrame([("Bacillus", 1), ("Bacillus_subtilis", 2), ("Bacillus_subtilis_str_9", 1)], "name string, source int")
    assert [(r["match"], r["n_words"]) for r in prep.longest_prefix_match(names, known).collect()] == [("Bacillus_subtilis", 2)]
    with pytest.raises(ValueError):
        prep.checked_taxids(spark.createDataFrame([("x",)], "accession string"), spark.createDataFrame([("y", 1)], "accession string, taxid long"))


def test_unknown_share(spark):
    """Half of the reads known; more known than given; a sample without reads of species; one rank."""
    rolled = spark.createDataFrame([("a", "s__A", 50.0), ("a", "t__A", 9.0), ("a", "g__A", 9.0), ("b", "s__A", 300.0), ("c", "g__A", 5.0)], "sample string, clade string, read_sum double")
    columns = "sample string, cluster string, read_sum double, abundance double, rel_abun double"
    own = spark.createDataFrame([(x, "k__Bacteria", 0.0, 2.0, 100.0) for x in "abc"], columns)
    got = {(r["sample"], r["cluster"]): (r["read_sum"], r["rel_abun"]) for r in profile.with_unknown(own, rolled, 100).collect()}
    assert got == {
        ("a", "k__Bacteria"): (0.0, 50.0), ("b", "k__Bacteria"): (0.0, 100.0), ("c", "k__Bacteria"): (0.0, 0.0),
        ("a", "UNKNOWN"): (50.0, 50.0), ("b", "UNKNOWN"): (-200.0, 0.0), ("c", "UNKNOWN"): (100.0, 100.0),
    }
    assert profile.with_unknown(own, rolled, 100, named=False).count() == 3
    rows = spark.createDataFrame([("a", "s__A", 50.0, 2.0, 80.0), ("a", "s__unclassified", 0.0, 0.0, 20.0)], columns)
    assert {r["cluster"]: r["rel_abun"] for r in profile.with_unknown(rows, rolled, 100, "s").collect()} == {"s__A": 40.0, "s__unclassified": 60.0}
    assert profile.with_unknown(own.limit(0), rolled, 100).count() == 0
    with pytest.raises(ValueError):
        Options(output="o", sam_list="l", marker_json="m", taxonomy_json="t", pipeline=Pipeline.MEPHN, unknown=True).resolved()


def test_truth_species(spark):
    rows = spark.createDataFrame([(1, "7", "1|7", "a|b"), (2, "9", "1|7|9", "a|b|c"), (3, "8", "1|8", "a|Known one"), (4, "5", "1|5", "x")], "row_id int, taxid string, taxpath string, taxpathsn string")
    truth = spark.createDataFrame([("7", "b"), ("70", "Known one")], "taxid string, species string")
    assert {r["row_id"]: r["truth_id"] for r in evaluate.truth_species(rows, truth).collect()} == {1: "7", 2: "7", 3: "70", 4: None}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.sam").write_text("".join(f"r{i}\t0\tg{i % 2}\t1\t30\t4M\t*\t0\t0\tACGT\t*\tRG:Z:s\n" for i in range(6)))
    query = live_counts.live_counts(live_counts.sam_stream(spark, str(tmp_path / "in"))).writeStream.outputMode("complete").format("memory").queryName("live").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert {(r["cluster"], r["raw_count"]) for r in spark.table("live").collect()} == {("g0", 3), ("g1", 3)}
