"""An index for name search: which parties have which three letters in their name.

A name that contains a text has all of the text's trigrams, so only parties that stand in the
postings of all of them are looked at, and their names decide. Names are compared in lower case,
as in the search without an index. The postings are stored in buckets of the trigram, sorted by
it: a search reads the buckets of a few trigrams, not all names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entigrid.operators.view import name_search, party_listing
from entigrid.sources.bucketed import read_bucketed, write_bucketed
from entigrid.sources.stored import bounded, stored

GRAM = 3
# Postings that are read for one search: those of the text's rarest trigrams.
GRAMS_READ = 4
# A trigram with more parties than this is written by several tasks.
PARTIES_A_TASK = 1_000_000


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text; none if it is too short."""
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))))


def write_name_index(view: DataFrame, path: str, buckets: int, parties_a_task: int = PARTIES_A_TASK) -> None:
    """Postings (gram, id) and the number of parties per trigram, below one path."""
    lower = view.select("id", F.lower("legal_name").alias("name"))
    postings = lower.select(F.explode(trigrams(F.col("name"))).alias("gram"), "id")
    counts = stored(postings.groupBy("gram").agg(F.count("*").alias("parties")), "grams")
    write_bucketed(counts, f"{path}/grams", "gram", buckets)
    large = counts.filter(F.col("parties") > parties_a_task).select("gram", F.ceil(F.col("parties") / parties_a_task).alias("tasks"))
    joined = postings.join(bounded(large), "gram", "left")
    spread = F.when(F.col("tasks").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.col("tasks")))
    write_bucketed(joined.withColumn("spread", spread).drop("tasks"), f"{path}/postings", "gram", buckets, F.col("spread"))


def _rarest(spark: SparkSession, path: str, text: str) -> list[str] | None:
    """The text's rarest trigrams; None if some trigram of it is in no name."""
    grams = spark.range(1).select(F.explode(trigrams(F.lit(text)))).toPandas().iloc[:, 0].tolist()
    known = read_bucketed(spark, f"{path}/grams").filter(F.col("gram").isin(grams)).collect()
    if len(known) < len(grams):
        return None
    return [r.gram for r in sorted(known, key=lambda r: (r.parties, r.gram))[:GRAMS_READ]]


def indexed_search(view: DataFrame, path: str, name: str) -> DataFrame:
    """Parties whose name contains the text, whatever its case; the same as ``name_search``.

    ``view`` is the stored view that the index was made of. A text of less than three letters
    is searched for in all names.
    """
    spark = view.sparkSession
    text = spark.range(1).select(F.lower(F.lit(name))).first()[0]
    if len(text) < GRAM:
        return name_search(view, name)
    grams = _rarest(spark, path, text)
    if grams is None:
        return party_listing(view).filter(F.lit(False))
    postings = read_bucketed(spark, f"{path}/postings").filter(F.col("gram").isin(grams))
    ids = postings.groupBy("id").agg(F.count_distinct("gram").alias("n")).filter(F.col("n") == len(grams)).select("id")
    return name_search(view.join(bounded(stored(ids, "found-names")), "id", "left_semi"), name)
