"""Group values joined back to rows, with hot groups spread over all partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group(frame: DataFrame, keys: list[str], salt_on: str, values: dict[str, tuple[Column, str]], where: str | None = None) -> DataFrame:
    """Inner-joins each row to values of its group; ``where`` keeps the groups it holds for.

    ``values`` gives, by name, the aggregate of rows and the SQL function that joins such partial values
    (``min`` for minima, ``sum`` for counts).  Rows carry a salt from ``salt_on``; a group is summed by
    salt, then as a whole, and its values go back to each salt it has, so that a group that holds a
    third of all rows is neither gathered nor joined in one task.
    """
    n = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = frame.withColumn("_salt", F.pmod(F.xxhash64(salt_on), F.lit(n)))
    parts = salted.groupBy(*keys, "_salt").agg(*[rows.alias(name) for name, (rows, _) in values.items()])
    whole = parts.groupBy(*keys).agg(*[F.expr(f"{joining}(`{name}`)").alias(name) for name, (_, joining) in values.items()], F.collect_list("_salt").alias("_salts"))
    if where:
        whole = whole.where(where)
    targets = whole.select(*keys, *values, F.explode("_salts").alias("_salt"))
    return salted.join(targets, [*keys, "_salt"]).drop("_salt")
