"""Joins against key sets and lookups.

All are lazy.  Neither side has a known bound, so Spark picks the join at run time: it
broadcasts a side whose shuffled size is within the session's adaptive threshold, and
else splits hot keys (adaptive skew join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.operators.windows import filed, sieve, sifted


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``."""
    names = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*names), names, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys``."""
    names = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*names), names, "left_anti")


def decode(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Join a code to its lookup row; rows with an unknown code are dropped (see ``unmapped``)."""
    return df.join(lookup, on)


def unmapped(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Distinct codes without a lookup row, null included."""
    return anti_join(df.select(on).distinct(), lookup, on)


def first_contained(df: DataFrame, name: str, patterns: Sequence[tuple[str, str]], out: str) -> DataFrame:
    """Label of the first pattern contained in the text of ``name``; rows without one are dropped.

    The patterns are one ordered array value, so the plan does not grow with them.
    """
    listed = F.array(*[F.struct(F.lit(text).alias("text"), F.lit(code).alias("code")) for text, code in patterns])
    hits = F.filter(listed, lambda p: F.col(name).contains(p["text"]))
    return df.withColumn(out, F.get(hits, F.lit(0))["code"]).filter(F.col(out).isNotNull())


def first_contained_in(df: DataFrame, name: str, patterns: DataFrame, out: str) -> DataFrame:
    """As ``first_contained``, for any number of patterns: rows of ``text``, ``code`` and ``position``.

    Of the patterns a text contains the one of the smallest position labels it (of equal positions
    the smallest text).  Each pattern is filed under one of the windows that cover it (see ``windows``),
    the one that the fewest texts hold; a text meets only the patterns filed under its own windows, and is
    searched for these.  Patterns with a window that no text holds are out at once.  Only texts with a
    window that passes the sieve of all patterns are shuffled.  Equal texts are searched once.
    Null texts and patterns contain and are nothing; an empty pattern is in every text.
    """
    key, gram = "__key", "__gram"
    # Of equal patterns one can label a text.
    least = F.min(F.struct(F.col("position").alias("__position"), F.col("code").alias("__code"))).alias("__least")
    known = patterns.filter("text IS NOT NULL").groupBy(F.col("text").alias("__text")).agg(least).select("__text", "__least.__code", "__least.__position")
    empty = known.filter("__text = ''").agg(F.min(F.struct("__position", "__text", "__code"))).scalar()
    windows = filed(known.filter("__text <> ''"), "__text")
    texts = df.filter(F.col(name).isNotNull()).select(F.sha2(F.col(name).cast("binary"), 256).alias(key), F.col(name).alias("__in"))
    # One value holds text and windows, so all that follows reads the same shuffle.
    texts = sifted(texts, key, "__in", sieve(windows)).groupBy(key).agg(F.first(F.struct("__in", "__grams")).alias("__held"))
    runs = texts.select(key, F.explode("__held.__grams").alias(gram))
    often = runs.groupBy(gram).agg(F.count(F.lit(1)).alias("__n"))
    rarest = windows.join(often, gram, "left").groupBy("__text", "__code", "__position").agg(
        F.min(F.struct("__n", gram)).alias("__least"), F.count_if(F.col("__n").isNull()).alias("__absent")
    )
    rarest = rarest.filter("__absent = 0").select("__text", "__code", "__position", F.col(f"__least.{gram}").alias(gram))
    asked = runs.join(rarest, gram).drop(gram)
    found = asked.join(texts, key).filter(F.col("__held.__in").contains(F.col("__text")))
    found = found.groupBy(key).agg(F.min(F.struct("__position", "__text", "__code")).alias("__found"))
    labelled = df.filter(F.col(name).isNotNull()).withColumn(key, F.sha2(F.col(name).cast("binary"), 256)).join(found, key, "left")
    return labelled.withColumn(out, F.least("__found", empty)["__code"]).drop(key, "__found").filter(F.col(out).isNotNull())
