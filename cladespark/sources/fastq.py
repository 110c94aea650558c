"""FASTQ files: whole small files by built-in functions, large ones by a data source that splits them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import NO_SAMPLE
from ..sizes import small


def fastq_samples(spark: SparkSession, path: str) -> DataFrame:
    """(rg, sm, fastq1, fastq2, sample_id) of a list of three or four columns; other widths are skipped."""
    rows = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).withColumn("_f", F.split("value", "\t")).where(F.size("_f").isin(3, 4))
    named = rows.select(F.col("_f")[0].alias("rg"), F.col("_f")[1].alias("sm"), F.col("_f")[2].alias("fastq1"), F.when(F.size("_f") == 4, F.col("_f")[3]).alias("fastq2"), "line")
    return named.select("rg", "sm", "fastq1", "fastq2", F.expr("cast(row_number() over (order by line) - 1 as int)").alias("sample_id"))


def _header(line, paired: bool):
    """(read_name, mate) of a header line without its @."""
    text = F.regexp_replace(F.expr(f"substring({line}, 2)"), "^@", "")
    if not paired:
        return F.translate(text, " ", "_"), F.lit(None).cast("int")
    first, second = F.split(text, " ")[0], F.expr("try_element_at(split(" + f"regexp_replace(substring({line}, 2), '^@', '')" + ", ' '), 2)")
    mate = F.when(first.rlike("/[12]$"), F.right(first, F.lit(1))).when(second.rlike("^[12]"), F.left(second, F.lit(1)))
    return F.regexp_replace(first, "/[12]$", ""), F.expr("cast(null as int)") if mate is None else mate.cast("int")


def parsed_fastq(files: DataFrame, paired: bool = True) -> DataFrame:
    """(file, read_name, mate, seq, qual) of whole files (columns file, value): records of four lines.

    Lines before the first that begins with @ and a last record that isn't whole are left out.
    """
    lines = files.select("file", F.split(F.regexp_replace("value", "\r", ""), "\n").alias("lines"))
    lines = lines.withColumn("_at", F.expr("aggregate(sequence(0, size(lines) - 1), -1, (a, i) -> if(a < 0 and startswith(lines[i], '@'), i, a))")).where("_at >= 0")
    records = lines.select("file", F.explode(F.expr("transform(filter(sequence(0, greatest(0, (size(lines) - _at) div 4 - 1)), i -> _at + 4 * i + 3 < size(lines)), i -> struct(lines[_at + 4 * i] as head, lines[_at + 4 * i + 1] as seq, lines[_at + 4 * i + 3] as qual))")).alias("r"))
    records = records.select("file", F.col("r.head").alias("head"), F.col("r.seq").alias("seq"), F.col("r.qual").alias("qual")).where("startswith(head, '@')")
    name, mate = _header("head", paired)
    return records.select("file", name.alias("read_name"), mate.alias("mate"), "seq", "qual")


def read_fastq(spark: SparkSession, paths: list[str], paired: bool = True) -> DataFrame:
    """Records of files that fit in memory one by one, compressed ones included."""
    return parsed_fastq(spark.read.text(paths, wholetext=True).withColumn("file", F.col("_metadata.file_path")), paired)


def with_samples(reads: DataFrame, samples: DataFrame) -> DataFrame:
    """(sample_id, rg, sm, read_name, mate, seq, qual): samples by file name; the file's place gives the mate where the header doesn't.

    A file that isn't listed is a sample of its own.
    """
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    one = samples.select("sample_id", "rg", "sm", base(F.col("fastq1")).alias("_base"), F.lit(1).alias("_mate"))
    two = samples.where("fastq2 is not null").select("sample_id", "rg", "sm", base(F.col("fastq2")).alias("_base"), F.lit(2).alias("_mate"))
    joined = reads.withColumn("_base", base(F.col("file"))).join(small(one.unionByName(two)), "_base", "left")
    stem = F.regexp_replace("_base", r"\.(fastq|fq)(\.gz)?$", "")
    return joined.select(F.coalesce("sample_id", F.lit(-1)).alias("sample_id"), F.coalesce("rg", F.when(F.col("mate").isNull(), stem).otherwise(F.lit(NO_SAMPLE))).alias("rg"), F.coalesce("sm", F.when(F.col("mate").isNull(), stem).otherwise(F.lit(NO_SAMPLE))).alias("sm"), "read_name", F.coalesce("mate", "_mate").alias("mate"), "seq", "qual")


def by_line_number(lines: DataFrame) -> DataFrame:
    """(rec_no, name, seq, qual) from numbered lines (columns line from 0, value); a record that isn't whole goes."""
    at = lambda k: F.max(F.when(F.col("line") % 4 == k, F.col("value")))
    records = lines.groupBy(F.floor(F.col("line") / 4).cast("long").alias("rec_no")).agg(F.count("*").alias("n"), at(0).alias("head"), at(1).alias("seq"), at(2).alias("plus"), at(3).alias("qual"))
    return records.where("n = 4 and startswith(head, '@') and startswith(plus, '+')").select("rec_no", F.expr("substring(head, 2)").alias("name"), "seq", "qual")


def joined_by_record(first: DataFrame, second: DataFrame, ordered: bool = False) -> DataFrame:
    """(rec_no, name, seq1, qual1, seq2, qual2): mates of two numbered files by their record number, in this order if asked for.

    A record that one file lacks goes; the name is the first file's.
    """
    two = second.select("rec_no", F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    both = first.select("rec_no", "name", F.col("seq").alias("seq1"), F.col("qual").alias("qual1")).join(two, "rec_no")
    return both.orderBy("rec_no") if ordered else both


class _Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int) -> None:
        self.path, self.start, self.stop = path, start, stop


class FastqSource(DataSource):
    """``spark.read.format("fastq").option("paths", "a,b")``: uncompressed files are split by bytes.

    A split begins at the first record header in it: a line that begins with @ and has one that begins with +
    two lines on (a quality line may begin with @, but isn't followed so).
    """

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "file string, head string, seq string, qual string"

    def reader(self, schema) -> DataSourceReader:
        return _FastqReader(self.options)


class _FastqReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options.get("paths", "").split(",") if p]
        self.split = int(options.get("splitBytes", 128 << 20))

    def partitions(self) -> list[_Range]:
        from pyarrow import fs

        out = []
        for path in self.paths:
            system, place = fs.FileSystem.from_uri(path)
            size = system.get_file_info(place).size
            step = size if path.endswith(".gz") else self.split
            out += [_Range(path, a, min(a + step, size)) for a in range(0, size, step or 1)]
        return out

    def read(self, partition: _Range) -> Iterator[tuple]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(partition.path)
        packed = partition.path.endswith(".gz")
        with system.open_input_stream(place) if packed else system.open_input_file(place) as file:
            yield from _records(file, partition.path, 0 if packed else partition.start, (1 << 62) if packed else partition.stop, packed)


def _records(file, path: str, start: int, stop: int, whole: bool) -> Iterator[tuple]:
    """Records whose header begins in [start, stop)."""
    if not whole:
        file.seek(max(0, start - 1))
    at, buffer = (start if whole else max(0, start - 1)), b""

    def lines() -> Iterator[tuple[int, bytes]]:
        nonlocal at, buffer
        while True:
            end = buffer.find(b"\n")
            while end < 0:
                more = file.read(1 << 20)
                if not more:
                    if buffer:
                        yield at, buffer
                    return
                buffer += more
                end = buffer.find(b"\n")
            line, buffer = buffer[:end], buffer[end + 1 :]
            here, at = at, at + end + 1
            yield here, line.rstrip(b"\r")

    source = lines()
    window: list[tuple[int, bytes]] = []
    if not whole and start > 0:
        next(source, None)  # what is left of the line that a split cuts
    for item in source:
        window.append(item)
        if len(window) == 3 and not (window[0][1].startswith(b"@") and window[2][1].startswith(b"+")):
            window.pop(0)
        elif len(window) == 4:
            if window[0][0] >= stop:
                return
            yield path, window[0][1].decode(), window[1][1].decode(), window[3][1].decode()
            window = []
        elif window[0][0] >= stop and window[0][1].startswith(b"@") is False:
            return
