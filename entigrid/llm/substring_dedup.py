"""Substring dedup over sliding runs of sentences.

A text is cut into sentences (up to and with its end marks, line ends and the white space after).
Runs of two or more consecutive sentences, however many, that have ``RUN_WORDS`` words or more
count, and so do single sentences of ``LONG_WORDS`` or more; they are told by their lower-cased
words. Equal runs are ranked globally; the first one, by doc_id and position, stays. The
sentences under any other are removed, the rest of the text is kept as it is. A repeated stretch
with ends inside sentences is only removed for its whole sentences, if they make up such a run.

Not all runs need be hashed. Of the runs that start at a sentence, and of those that end at it, the
shortest will do: they are part of any longer run, so they repeat wherever it does, and those
within a run cover it. (A sentence from which a run's rest is too short, and up to which its
beginning is, lies in the shortest run from that run's start.)

Defined results: null is the empty text; pieces without a word belong to the sentence before them
(or the first one after, at the start); rows that repeat a doc_id and its text count as one
document and have one result; a null doc_id comes first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from entigrid.llm.common import stored, text_of

RUN_WORDS, LONG_WORDS = 8, 25
#: One of so many documents is looked at for frequent runs; a frequent run is more than such a
#: part of all runs, and dealt out in so many parts; bits of the places of documents with spans.
SAMPLE, FREQUENT, SALTS, PLACE_BITS = 64, 1024, 64, 1 << 25

_PIECE = re.compile(r"[^.!?\n]*[.!?\n]+\s*|[^.!?\n]+")
_WORDS = re.compile(r"\w+")
_RUNS = "h long, g int, doc_id long, mark int, first int, size int"


def sentences(text: str | None) -> list[tuple[str, list[str]]]:
    """The text's sentences in full and their lower-cased words; joined, they are the text."""
    out: list[tuple[str, list[str]]] = []
    lead = ""
    for piece in _PIECE.findall(text or ""):
        words = _WORDS.findall(piece.lower())
        if words:
            out.append((lead + piece, words))
            lead = ""
        elif out:
            out[-1] = (out[-1][0] + piece, out[-1][1])
        else:
            lead += piece
    return out if not lead or out else [(lead, [])]


def spans(counts: list[int]) -> list[tuple[int, int]]:
    """First sentence and number of sentences of the runs to hash, for sentences of so many words."""
    n = len(counts)
    upto = [0, *accumulate(counts)]
    found = {(i, 1) for i, c in enumerate(counts) if c >= LONG_WORDS}
    end = 0
    for i in range(n - 1):  # the shortest run from i on ends before ``end``, which never goes back
        end = max(end, i + 2)
        while end < n and upto[end] - upto[i] < RUN_WORDS:
            end += 1
        if upto[end] - upto[i] >= RUN_WORDS:
            found.add((i, end - i))
    first = 0
    for j in range(1, n):  # the shortest run up to j starts at ``first``
        while first + 1 < j and upto[j + 1] - upto[first + 1] >= RUN_WORDS:
            first += 1
        if upto[j + 1] - upto[first] >= RUN_WORDS:
            found.add((first, j + 1 - first))
    return sorted(found)


def runs(cut: list[tuple[str, list[str]]]) -> list[tuple[int, int, bytes]]:
    """First sentence, number of sentences and a 128-bit hash of each run."""
    keys = b"".join(xxhash.xxh3_128_digest(" ".join(words)) for _, words in cut)
    return [(i, size, xxhash.xxh3_128_digest(keys[16 * i : 16 * (i + size)])) for i, size in spans([len(words) for _, words in cut])]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, marks = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
        found = [runs(sentences(t)) for t in batch.column("text").to_pylist()]
        sizes = [len(f) for f in found]
        flat = [r for f in found for r in f]
        hashes = np.frombuffer(b"".join(r[2] for r in flat), dtype="<i8").reshape(-1, 2)
        place = np.repeat(np.arange(len(found)), sizes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hashes[:, 0]), pa.array(hashes[:, 1].astype(np.int32)),
                batch.column("doc_id").take(pa.array(place)), batch.column("mark").take(pa.array(place)),
                pa.array([r[0] for r in flat], pa.int32()), pa.array([r[1] for r in flat], pa.int32()),
            ],
            ["h", "g", "doc_id", "mark", "first", "size"],
        )
        del ids, marks


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("mark"), text.alias("text"))


def _frequent(keyed: DataFrame) -> DataFrame:
    """(h, g): runs that more than a ``FREQUENT``-th of the runs in one of ``SAMPLE`` parts of the
    documents are. They decide how runs are dealt out, not what is found."""
    part = keyed.filter(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SAMPLE)) == 0)
    counts = stored(part.mapInArrow(_runs, _RUNS).groupBy("h", "g").agg(F.count("*").alias("n")), "run-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return stored(counts.filter(F.col("n") > max(1, total // FREQUENT)).select("h", "g"), "frequent-runs")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, spans): of each document with non-first repeated runs, their first sentence
    and size. A hash is 96 bits; the mark tells texts of one doc_id apart.

    Runs are hashed and dealt out once, and all but the first of each are found by their rank. A
    frequent one is dealt out in ``SALTS`` parts, whose first ones are ranked once more.
    """
    keyed = _keyed(docs)
    found = keyed.mapInArrow(_runs, _RUNS)
    place = ["doc_id", "mark", "first"]  # the first run's rows, if rows repeat, all have rank 1
    frequent = _frequent(keyed)
    if frequent.isEmpty():
        others = found.withColumn("nth", F.rank().over(Window.partitionBy("h", "g").orderBy(*place))).filter("nth > 1")
    else:
        own = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(SALTS))
        found = found.join(F.broadcast(frequent.withColumn("often", F.lit(True))), ["h", "g"], "left")
        found = found.withColumn("salt", F.when(F.col("often"), own).otherwise(F.lit(0)))
        found = found.withColumn("nth", F.rank().over(Window.partitionBy("h", "g", "salt").orderBy(*place))).filter("nth > 1 OR often")
        # those past the first of their part are settled, and spread by their places
        settled = F.when(F.col("nth") > 1, F.xxhash64("doc_id", "mark", "first"))
        again = Window.partitionBy("h", "g", "settled").orderBy(*place)
        others = found.withColumn("settled", settled).withColumn("again", F.rank().over(again)).filter("settled IS NOT NULL OR again > 1")
    # one row of a document for each stretch, then one per document: bounded by its sentences
    return others.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("first", "size")).alias("spans"))


def _bit(doc_id: str, mark: str) -> Column:
    return F.pmod(F.xxhash64(doc_id, mark), F.lit(PLACE_BITS))


def _perhaps(keyed: DataFrame, spans: DataFrame) -> DataFrame:
    """``keyed`` with a column perhaps: false only for documents that have no spans.

    The places of those with spans are bits of ``PLACE_BITS``, broadcast in rows of 4 KB; the more
    documents share a bit, the more have perhaps without spans.
    """
    bit = _bit("d", "m")
    bits = spans.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    at = keyed.withColumn("bit", _bit("doc_id", "mark")).withColumns(
        {"bucket": F.bitmap_bucket_number("bit"), "at": F.bitmap_bit_position("bit").cast("int")}
    )
    byte = "CAST(conv(hex(substring(bits, at DIV 8 + 1, 1)), 16, 10) AS INT)"
    perhaps = F.expr(f"coalesce(shiftright({byte}, at % 8) & 1 = 1, false)")
    return at.join(F.broadcast(bits), "bucket", "left").select("doc_id", "mark", "text", perhaps.alias("perhaps"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, n_removed, text): each document without the sentences under repeated
    runs other than their first. Only documents that perhaps have such runs are dealt out."""
    spans = stored(repeated_runs(docs), "run-spans").select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "spans")
    keyed = _perhaps(_keyed(docs), spans)
    own = keyed["doc_id"].eqNullSafe(F.col("d")) & (keyed["mark"] == F.col("m"))
    dealt = keyed.filter("perhaps").join(spans.hint("merge"), own, "left").select("doc_id", "text", "spans")
    whole = keyed.filter("NOT perhaps").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    joined = dealt.unionByName(whole)

    @F.pandas_udf("n_sentences long, n_removed long, text string")
    def keep(texts: pd.Series, firsts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        rows = []
        for text, first, size in zip(texts, firsts, sizes):
            cut = sentences(text)
            gone = set()
            if first is not None:
                for a, n in zip(first, size):
                    gone.update(range(a, a + n))
            kept = "".join(s for i, (s, _) in enumerate(cut) if i not in gone) if gone else text
            rows.append((len(cut), len(gone), kept))
        return pd.DataFrame(rows, columns=["n_sentences", "n_removed", "text"])

    done = joined.select("doc_id", keep("text", F.col("spans.first"), F.col("spans.size")).alias("r"))
    return done.select("doc_id", "r.n_sentences", "r.n_removed", "r.text")
