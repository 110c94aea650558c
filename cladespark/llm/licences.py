"""Licence scan by canonical digest: whole texts, normalised, hashed and joined to known digests.

Normalising lower-cases ASCII, removes copyright lines, turns punctuation and white space into single
spaces and replaces spellings that mean the same.  The SHA-256 of the result is joined with the
digests of known licence texts, which went through the same expressions.  Everything is built-in
column functions; the known texts are an argument, by default a fixed table of short texts and of full
licences (``licence_files``), some hundred kilobytes; their digests are broadcast.

Defined results: a null text counts as empty; texts without a known digest have a null licence;
if two known texts had one digest, the first name by order is taken; repeated rows give equal
rows; an empty table gives an empty table.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .licence_texts import KNOWN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that states a copyright: the word or sign with a year, a sign or a placeholder after it.
COPYRIGHT_LINE = r"(?m)^[\t #*/;.-]*(copyright|\(c\)|©)[\t ]*(\(c\)|©|[0-9]{4}|<year>|\[year\]|by )[^\n]*$|^[\t #*/;.-]*all rights reserved[^\n]*$"
#: White space, ASCII punctuation and typographic signs; letters of all languages stay.
SEPARATORS = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f‘’“”–—•·©]+"
#: Fixed: spellings that the licence matching guidelines hold to be equal; words stand between single spaces.
EQUIVALENTS = [
    ("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("organisation", "organization"), ("authorisation", "authorization"), ("favour", "favor"), ("whilst", "while"),
    ("wilful", "willful"), ("acknowledgement", "acknowledgment"), ("copyright owner", "copyright holder"), (" https ", " http "),
]


def normalised(text: Column) -> Column:
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, " ")
    out = F.regexp_replace(out, SEPARATORS, " ")
    for spelling, same in EQUIVALENTS:
        out = F.replace(out, F.lit(spelling), F.lit(same))
    return F.trim(out)


def _texts(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("licence_id"), F.lit(text).alias("text")) for name, text in texts.items()])).alias("known")
    return spark.range(1).select(rows).select("known.*")


def known_texts(spark: SparkSession) -> DataFrame:
    """(licence_id, text): the short texts and the full licences. The driver reads the files."""
    return _texts(spark, KNOWN | {file.stem: file.read_text(encoding="utf-8") for file in sorted((Path(__file__).parent / "licence_files").glob("*.txt"))})


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """(digest, licence_id) of known texts, by default the short ones."""
    texts = _texts(spark, KNOWN) if known is None else known
    return texts.groupBy(F.sha2(normalised(F.col("text")), 256).alias("digest")).agg(F.min("licence_id").alias("licence_id"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", known: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, licence_id) of whole texts, by the (licence_id, text) of ``known``. No shuffle of documents."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_column).alias("doc_id"), F.sha2(normalised(F.col(text_column)), 256).alias("digest"))
    digests = known_digests(spark, known_texts(spark) if known is None else known)
    return own.join(F.broadcast(digests), "digest", "left").select("doc_id", "digest", "licence_id")


def _sql_string(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_normalised(text: str) -> str:
    """The same expression for DuckDB."""
    out = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    out = f"regexp_replace({out}, {_sql_string(COPYRIGHT_LINE)}, ' ', 'g')"
    out = f"regexp_replace({out}, {_sql_string(SEPARATORS)}, ' ', 'g')"
    for spelling, same in EQUIVALENTS:
        out = f"replace({out}, {_sql_string(spelling)}, {_sql_string(same)})"
    return f"trim({out})"


def sql() -> str:
    values = ", ".join(f"({_sql_string(name)}, {_sql_string(text)})" for name, text in KNOWN.items())
    return f"""
    with texts(licence_id, text) as (values {values}),
    known as (select sha256({sql_normalised('text')}) as digest, min(licence_id) as licence_id from texts group by 1),
    own as (select doc_id, sha256({sql_normalised('text')}) as digest from documents)
    select doc_id, own.digest, licence_id from own left join known on own.digest = known.digest
    """
