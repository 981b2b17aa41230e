"""Verdict alignment and disagreement (differential check of strategies).

Verdict tables hold one row per check, so they are small whatever the data
size.  Alignment is a union plus a pivot on the check name: the result of a
chain of full outer joins, computed with a single shuffle and no join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def align_verdicts(verdicts: dict[str, DataFrame], value: str = "status") -> DataFrame:
    """Align verdict tables on ``checkName`` (a full outer join of all of them).

    ``verdicts`` maps a label to a table with ``checkName`` and ``value``
    columns; the output has ``checkName`` plus ``<label>Status`` per input
    (null where that strategy has no such check).  The join key is the
    name itself, so a check present in any input keeps its name.
    """
    labels = list(verdicts)
    stacked = reduce(DataFrame.unionByName, [
        v.select(F.lit(label).alias("strategy"), F.col("checkName"), F.col(value).alias("status"))
        for label, v in verdicts.items()
    ])
    return pivot_verdicts(stacked, labels)


def pivot_verdicts(stacked: DataFrame, labels: list[str]) -> DataFrame:
    """``(strategy, checkName, status)`` rows -> one row per check, a status column per strategy.

    Same result as chained full outer joins on the name, with one shuffle and no join.  A name that one
    strategy holds several times gives as many rows: no verdict is dropped.
    """
    nth = F.row_number().over(Window.partitionBy("checkName", "strategy").orderBy("status"))
    aligned = (stacked.withColumn("_nth", nth).groupBy("checkName", "_nth").pivot("strategy", labels)
               .agg(F.first("status")))
    return aligned.select("checkName", *[F.col(label).alias(f"{label}Status") for label in labels])


def status_columns(aligned: DataFrame) -> list[str]:
    return [c for c in aligned.columns if c != "checkName"]


def disagree(cols: list[str]) -> Column:
    """True when any two status columns differ, a missing verdict counting as a value."""
    pairs = [~F.col(a).eqNullSafe(F.col(b)) for a, b in zip(cols, cols[1:])]
    return reduce(lambda x, y: x | y, pairs) if pairs else F.lit(False)


def verdict_disagreements(aligned: DataFrame) -> DataFrame:
    """Rows of an aligned table whose strategies do not all agree."""
    return aligned.where(disagree(status_columns(aligned)))


def compare_verdicts(sql: DataFrame, expression: DataFrame, validator: DataFrame) -> DataFrame:
    """Align the three strategies' verdicts: ``checkName, sqlStatus, expressionStatus, validatorStatus``."""
    return align_verdicts({"sql": sql, "expression": expression, "validator": validator})
