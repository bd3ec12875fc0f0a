"""Shards by extendible hashing, in DataFrame functions only.

The directory is indexed by the upper bits of a hash of each document. A bucket that is larger
than the byte limit splits on one more bit, others stay, until every shard fits. As a bucket never
gets larger by a split, a document's shard is the bucket of least depth around it that fits; so
sizes are summed per bucket at each depth and no bucket is split one by one.

A bucket of equal hashes can't split: a document larger than the limit is a shard of its own, and
rows that repeat a document are counted out into shards that fit. Defined results: null texts have
0 bytes; a null doc_id is an id like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from entigrid.llm.common import free_name, stored

SHARD_BYTES = 16 << 20
# Bits beyond those that even shards would need; a bucket this fine is rarely too large.
SPARE_BITS = 6


def _bits_for(total: int, limit: int) -> int:
    bits = 0
    while (limit << bits) < total:
        bits += 1
    return bits


def _upper(bits: str) -> str:
    """The upper bits of the hash; none is 0."""
    return f"IF({bits} = 0, 0L, shiftrightunsigned(h, 64 - {bits}))"


def _leaves(sizes: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """Of buckets (h, bytes, n, least, most) by hashes cut to ``high`` bits: (h, depth, done), the
    least depth from ``low`` at which the bucket around each fits or has equal hashes."""
    depths = sizes.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn("prefix", F.expr(_upper("depth")))
    around = depths.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.min("least").alias("least"), F.max("most").alias("most"))
    fits = around.filter((F.col("bytes") <= limit) | (F.col("least") == F.col("most"))).select("depth", "prefix")
    found = depths.join(fits, ["depth", "prefix"]).groupBy("h").agg(F.min("depth").alias("depth"))
    return sizes.select("h").join(found, "h", "left")


def assigned(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, bytes, shard, depth, part, place): ``shard`` is the directory's bits; ``part`` counts the
    shards of a bucket of equal hashes, else it is 0."""
    rows = stored(
        docs.select(
            F.col("doc_id"),
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
            F.xxhash64("doc_id", "text").alias("h"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(60, _bits_for(total, limit) + SPARE_BITS)
    open_rows, directory = rows, None
    while True:
        cut = f"shiftleft({_upper(str(high))}, 64 - {high})" if high else "0L"
        sizes = stored(
            open_rows.groupBy(F.expr(cut).alias("h")).agg(F.sum("bytes").alias("bytes"), F.min("h").alias("least"), F.max("h").alias("most")),
            "shard-sizes",
        )
        leaves = stored(_leaves(sizes, low, high, limit).withColumn("bits", F.lit(high)), "shard-leaves")
        done = leaves.filter("depth IS NOT NULL")
        directory = done if directory is None else directory.union(done)
        left = leaves.filter("depth IS NULL").select(F.col("h").alias("cut"))
        if high >= 64 or left.isEmpty():
            break
        open_rows = open_rows.withColumn("cut", F.expr(cut)).join(left, "cut", "left_semi").drop("cut")
        low, high = high + 1, min(64, high + 8)
    found = None
    for bits in sorted(r.bits for r in directory.select("bits").distinct().collect()):
        cut = f"shiftleft({_upper(str(bits))}, 64 - {bits})" if bits else "0L"
        own = directory.filter(F.col("bits") == bits).select(F.col("h").alias("cut"), "depth")
        part = rows.withColumn("cut", F.expr(cut)).join(own, "cut").drop("cut")
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.withColumn("depth", F.lit(0))
    shard = F.expr(f"IF(depth = 0, '', substr(lpad(bin(h), 64, '0'), 1, depth))")
    return _counted_out(found.withColumn("shard", shard), limit)


def _counted_out(rows: DataFrame, limit: int) -> DataFrame:
    """Equal documents that are too many for one shard, counted out within each input partition."""
    too_large = (
        rows.groupBy("shard", "depth").agg(F.sum("bytes").alias("total"), F.count("*").alias("n")).filter((F.col("total") > limit) & (F.col("n") > 1))
    )
    rows = rows.join(too_large.select("shard", "depth", F.lit(True).alias("over")), ["shard", "depth"], "left")
    single = rows.filter("over IS NULL").withColumn("part", F.lit(0).cast("long"))
    over = rows.filter("over")
    own = Window.partitionBy("h", F.shiftright("place", 33)).orderBy("place")
    each = F.expr(f"greatest(1L, {limit} DIV greatest(bytes, 1))")
    counted = over.withColumn("part", F.shiftright("place", 33) * F.lit(1 << 24) + F.floor((F.row_number().over(own) - 1) / each))
    names = ["doc_id", "bytes", "shard", "depth", F.col("part").cast("long").alias("part"), "place"]
    return single.select(*names).union(counted.select(*names))


def directory(assignment: DataFrame) -> DataFrame:
    """(shard, depth, part, shard_bytes, shard_docs) of the shards that have documents."""
    return assignment.groupBy("shard", "depth", "part").agg(F.sum("bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> str:
    """The documents as one folder for each shard (``shard=b<bits>/part=<n>``), as Parquet files.

    ``docs`` is a table scan: rows are told apart by their place in it. Where the documents have
    a column ``shard`` or ``part`` themselves, the folders' names get an ending.
    """
    place, shard, part = (free_name(docs, name) for name in ("place", "shard", "part"))
    own = assigned(docs, limit).select(F.col("place").alias(place), F.concat(F.lit("b"), "shard").alias(shard), F.col("part").alias(part))
    joined = docs.withColumn(place, F.monotonically_increasing_id()).join(own, place).drop(place)
    joined.repartition(shard, part).write.partitionBy(shard, part).parquet(path)
    return path
