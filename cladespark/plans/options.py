"""Options of a profiling run, and their command line."""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from enum import Enum

from ..operators.statistics import STATISTICS


class Pipeline(Enum):
    COMG = "comg"
    MEPH = "meph"
    MEPHN = "mephn"


class Level(Enum):
    SPECIES = "species"
    MARKERS = "markers"

    @classmethod
    def _missing_(cls, value):
        text = str(value).lower()
        return cls.MARKERS if text in ("marker", "markers") else cls.SPECIES if text == "species" else None


class SequencingMode(Enum):
    PAIRED = "pe"
    SINGLE = "se"


class Layout(Enum):
    DEFAULT = "default"
    DETAILED = "detailed"
    CAMI = "cami"


@dataclass
class Options:
    """What a run does. ``resolved`` checks and completes it."""

    output: str = ""
    fastq_list: str | None = None
    sam_list: str | None = None
    reference_matrix: str | None = None
    species_genomes: str | None = None
    marker_json: str | None = None
    taxonomy_json: str | None = None
    excluded_markers: str | None = None
    aligner_index: str | None = None
    pipeline: Pipeline = Pipeline.COMG
    level: Level = Level.SPECIES
    mode: SequencingMode = SequencingMode.PAIRED
    layout: Layout = Layout.DEFAULT
    min_identity: float = 0.8
    min_align_len: int = 30
    min_mapq: int = 5
    insert_size: int = 300
    gc_recalibration: bool = False
    gc_model: str | None = None
    skip_alignment: bool = False
    skip_profiling: bool = False
    taxa_level: str = "a"
    statistic: str = "tavg_g"
    disambiguate: bool = True
    min_marker_len: int = 2000
    dedup_reads: bool = False
    xeq: bool = False
    parts_per_sample: int = 10
    unknown: bool = False
    total_reads: int | None = None

    def resolved(self) -> Options:
        if bool(self.fastq_list) == bool(self.sam_list):
            raise ValueError("give either a FASTQ list or a SAM list")
        if not self.output:
            raise ValueError("give an output path")
        if self.layout is Layout.CAMI and self.pipeline is Pipeline.MEPH:
            self.pipeline = Pipeline.MEPHN
        if self.pipeline is not Pipeline.COMG:
            self.mode = SequencingMode.SINGLE
        if not self.skip_profiling:
            if self.pipeline is Pipeline.COMG:
                if not self.reference_matrix:
                    raise ValueError("comg needs a reference matrix")
                if self.level is Level.SPECIES and not self.species_genomes:
                    raise ValueError("comg by species needs the species' genomes")
            elif not (self.marker_json and self.taxonomy_json):
                raise ValueError("meph needs markers and taxonomy as JSON")
        if self.unknown and (self.pipeline is not Pipeline.MEPHN or not self.total_reads or self.total_reads < 0):
            raise ValueError("unknown shares need mephn and the number of all reads")
        if self.statistic not in STATISTICS:
            raise ValueError(f"no such statistic: {self.statistic}")
        return self


def parse(arguments: list[str]) -> Options:
    parser = argparse.ArgumentParser(description="Metagenome profiling")
    text = {"-i": "fastq_list", "-s": "sam_list", "-o": "output", "-r": "reference_matrix", "-g": "species_genomes", "-x": "aligner_index", "--marker-json": "marker_json", "--taxonomy-json": "taxonomy_json", "--exclude-markers": "excluded_markers", "--gc-model": "gc_model", "--taxa-level": "taxa_level"}
    for flag, name in text.items():
        parser.add_argument(flag, dest=name, default=getattr(Options, name))
    for name, kind in (("min_identity", float), ("min_align_len", int), ("min_mapq", int), ("insert_size", int), ("min_marker_len", int), ("parts_per_sample", int), ("total_reads", int)):
        parser.add_argument(f"--{name.replace('_', '-')}", dest=name, type=kind, default=getattr(Options, name))
    parser.add_argument("--statistic", choices=STATISTICS, default=Options.statistic)
    parser.add_argument("--pipeline", type=Pipeline, default=Options.pipeline)
    parser.add_argument("--level", type=Level, default=Options.level)
    parser.add_argument("--mode", type=SequencingMode, default=Options.mode)
    parser.add_argument("--layout", type=Layout, default=Options.layout)
    for name in ("gc_recalibration", "skip_alignment", "skip_profiling", "dedup_reads", "xeq", "unknown"):
        parser.add_argument(f"--{name.replace('_', '-')}", dest=name, action="store_true")
    parser.add_argument("--no-disqm", dest="disambiguate", action="store_false")
    return Options(**vars(parser.parse_args(arguments))).resolved()
