"""Tables stored in buckets of a key: rows of one key are found in one bucket, and joins and
aggregations on the key need no exchange.

A file ``_layout.json`` beside the data tells columns, key and number of buckets, so a table can be
opened by its path in any session.
"""

from __future__ import annotations

import json
import uuid
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_LAYOUT = "_layout.json"


def _file(spark: SparkSession, path: str, name: str = ""):
    """The Hadoop path and its file system."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path, name) if name else jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(at), system


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, spread: Column | None = None) -> None:
    """Write rows in buckets of the key, sorted by it, one file a bucket.

    ``spread`` deals the rows of large keys out to several tasks: it is 0, or a number that varies
    among the rows of one key. Their bucket then has several files.
    """
    spark = df.sparkSession
    at, _ = _file(spark, path)
    name = f"entigrid_{uuid.uuid4().hex}"
    task = bucket_of(key, buckets)
    dealt = df.repartition(buckets, key) if spread is None else df.repartition(buckets, F.pmod(task + spread, F.lit(buckets)))
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", at.toString()).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name alone; its files stay
    layout, system = _file(spark, path, _LAYOUT)
    out = system.create(layout, True)
    try:
        out.write(bytearray(json.dumps({"key": key, "buckets": buckets, "schema": df._jdf.schema().toDDL()}).encode()))
    finally:
        out.close()


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """Open a table written so. It is declared anew, under a name that follows from its path."""
    layout, system = _file(spark, path, _LAYOUT)
    stream = system.open(layout)
    try:
        known = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    at, _ = _file(spark, path)
    name = f"entigrid_{md5(at.toString().encode()).hexdigest()}"
    location = at.toString().replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({known['schema']}) USING parquet CLUSTERED BY (`{known['key']}`) SORTED BY (`{known['key']}`)"
        f" INTO {known['buckets']} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)
