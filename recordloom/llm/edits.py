"""Single-edit neighbourhoods by deletion forms: texts one edit apart share a form, so an equi-join finds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shorter stems are compared exactly: one edit makes another word of them.
LEAST_LENGTH = 6


def deletion_forms(stem: Column) -> Column:
    """The stem and, if it is long enough, every text that lacks one of its characters."""
    n = F.length(stem)
    forms = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(stem, F.lit(1), i - 1), F.substring(stem, i + 1, n)))
    return F.when(n >= LEAST_LENGTH, F.array_distinct(F.concat(F.array(stem), forms))).otherwise(F.array(stem))


def canonical_stems(stems: DataFrame, scope: list[str], stem: str = "stem", n: str = "n", sure: str | None = None) -> DataFrame:
    """(scope, stem, canonical): for each stem the best supported one of its scope within one edit, itself included.

    Support is first whether the stem is sure (a spelling known to be right), then its number of records; ties go to the
    smaller in byte order. One edit is a letter added, left out, replaced or moved. Forms are grouped, never paired: the best
    stem of each form is found with map-side partial maxima, then the best over the forms of each stem.
    """
    rank = F.struct(*([F.col(sure).cast("int").alias("sure")] if sure else []), F.col(n).alias("n"))
    support = stems.groupBy(*scope, stem).agg(F.max(rank).alias("rank") if sure is None else F.max(F.struct(F.col(sure).cast("int").alias("sure"), F.lit(0).alias("z"))).alias("s0"), F.sum(n).alias("total"))
    best = F.struct(*([F.col("s0.sure").alias("sure")] if sure else []), F.col("total").alias("total"), F.col(stem).alias("stem"))
    forms = support.select(*scope, stem, best.alias("best"), F.explode(deletion_forms(F.col(stem))).alias("form"))
    # larger support wins, of equal support the smaller text: order by support alone, then take the least text
    key = ["best.sure", "best.total"] if sure else ["best.total"]
    top = forms.groupBy(*scope, "form").agg(F.min(F.struct(*[(-F.col(k)).alias(k.split(".")[1]) for k in key], F.col("best.stem").alias("stem"))).alias("top"))
    joined = forms.select(*scope, stem, "form").join(top, [*scope, "form"])
    return joined.groupBy(*scope, stem).agg(F.min("top").alias("top")).select(*scope, stem, F.col("top.stem").alias("canonical"))
