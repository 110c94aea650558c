"""The alignment stage: reads to an external aligner, and a plain k-mer aligner as a stand-in."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed: user options that the stage sets itself, with the number of values each takes.
OWN_OPTIONS = {"-x": 1, "-S": 1, "-1": 1, "-2": 1, "-U": 1, "--tab5": 1, "--tab6": 1, "--interleaved": 1, "-b": 1, "-s": 1, "-p": 1, "--threads": 1, "--rg-id": 1, "--rg": 1, "--no-hd": 0, "--no-sq": 0}

#: An aligner takes rows of one sample (name, seq1, qual1, seq2, qual2), its read group and its name, and gives SAM lines.
Aligner = Callable[[list[tuple], str, str], Iterator[str]]


def aligner_arguments(user: str, index: str, reads: str, output: str, rg: str, sm: str, threads: int = 1) -> list[str]:
    """Arguments for a command-line aligner: the user's without those that the stage sets, then the stage's."""
    kept, words = [], iter(user.split())
    for word in words:
        name = word.partition("=")[0]
        if name in OWN_OPTIONS:
            if "=" not in word:
                for _ in range(OWN_OPTIONS[name]):
                    next(words, None)
        else:
            kept.append(word)
    return [*kept, "-x", index, "-p", str(threads), "--no-hd", "--rg-id", rg, "--rg", f"SM:{sm}", "--tab5", reads, "-S", output]


def process_aligner(program: str, index: str, user: str = "", threads: int = 1) -> Aligner:
    """An aligner that is a program on every machine: reads go to its standard input as tab5 rows, SAM lines come from its output.

    Nothing is written to a machine's disk; what the program says on its error output is the message if it fails.
    """

    def run(rows: list[tuple], rg: str, sm: str) -> Iterator[str]:
        lines = []
        for name, seq1, qual1, seq2, qual2 in rows:
            one, two = [x for x in (seq1, qual1) if x is not None], [x for x in (seq2, qual2) if x is not None]
            lines.append("\t".join([name, *one, *two]))
        arguments = aligner_arguments(user, index, "-", "-", rg, sm, threads)
        found = subprocess.run([program, *arguments], input="\n".join(lines) + "\n", capture_output=True, text=True, check=False)
        if found.returncode:
            raise RuntimeError(f"{program} ended with {found.returncode}: {found.stderr[-2000:]}")
        yield from (line for line in found.stdout.splitlines() if not line.startswith("@"))

    return run


def tab5(reads: DataFrame) -> DataFrame:
    """(sample_id, rg, sm, line): name, sequence and quality of one or both mates, tab-separated."""
    own = F.concat_ws("\t", "read_name", F.coalesce("seq1", "seq2"), F.coalesce("qual1", "qual2"))
    both = F.concat_ws("\t", "read_name", "seq1", "qual1", "seq2", "qual2")
    return reads.select("sample_id", "rg", "sm", F.when(F.col("seq1").isNotNull() & F.col("seq2").isNotNull(), both).otherwise(own).alias("line"))


def aligned(reads: DataFrame, aligner: Aligner, parts_per_sample: int = 2) -> DataFrame:
    """(rg, sm, line): SAM lines of each sample's reads, which are dealt to so many parts by name.

    A task may get parts of several samples; each is handed to the aligner by itself.
    """
    columns = ["read_name", "seq1", "qual1", "seq2", "qual2"]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rows = list(frame[columns].itertuples(index=False, name=None))
        return pd.DataFrame({"rg": key[0], "sm": key[1], "line": list(aligner(rows, key[0], key[1]))})

    part = F.pmod(F.xxhash64("read_name"), F.lit(parts_per_sample)).alias("_part")
    return reads.groupBy("rg", "sm", part).applyInPandas(lambda key, frame: run(key, frame), "rg string, sm string, line string")


def seed_alignments(reads: DataFrame, genes: DataFrame, k: int = 16) -> DataFrame:
    """(read_name, gene, pos, seeds): the gene and place that most of a read's k-mers agree on; ties go to the first gene.

    K-mers are exploded on both sides and joined; no read is compared with a gene it shares none with.
    """
    mers = lambda frame, key: frame.select(key, F.col("seq"), F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("seq") - k + 1))).alias("at")).select(key, "at", F.expr(f"substring(seq, at, {k})").alias("mer")).where(F.length("mer") == k)
    hits = mers(reads, "read_name").withColumnRenamed("at", "read_at").join(mers(genes, "gene").withColumnRenamed("at", "gene_at"), "mer")
    votes = hits.groupBy("read_name", "gene", (F.col("gene_at") - F.col("read_at") + 1).alias("pos")).agg(F.count("*").alias("seeds"))
    best = votes.groupBy("read_name").agg(F.min(F.struct((-F.col("seeds")).alias("less"), "gene", "pos")).alias("b"))
    return best.select("read_name", "b.gene", "b.pos", (-F.col("b.less")).alias("seeds"))
