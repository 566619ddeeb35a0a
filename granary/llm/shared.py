"""Storage all executors share, and linked groups of rows."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of this driver's tables, by the folder they lie in.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session on one machine (a ``local`` master) may do without and gets a temporary
    one; elsewhere executors would not see each other's files, so that stops the job.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder all machines share (master {master})")
        base = f"file://{tempfile.mkdtemp(prefix='granary-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def _own_dir(spark: SparkSession) -> str:
    base = shared_dir(spark).rstrip("/")
    if base not in _OWN:
        _OWN[base] = f"{base}/granary-{uuid.uuid4().hex}"
        atexit.register(_forget, spark)
    return _OWN[base]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and outlives executors.

    Tables are kept until ``discard`` is called or the driver ends.
    """
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Delete the tables that ``written`` has made in this driver.

    To be called when all results that read them are stored elsewhere.
    """
    for base, own in list(_OWN.items()):
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _OWN.pop(base)


def _forget(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        discard(spark)


#: Parts of a node's links in a join.
SALTS = 8


def _beside(links: DataFrame, low: DataFrame) -> DataFrame:
    """``links(u, v)`` with ``m`` of ``low(u, m)``; a node with very many links is spread."""
    salted = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"]).drop("salt")


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up > 0 and down > 0").isEmpty()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest id reachable from each id that occurs in ``links(a, b)``: ``(id, root)``.

    Alternating large-star and small-star steps (Kiveris et al., 2014), until all groups are
    stars around their smallest id. A step keeps each id with its smallest neighbour only, so
    a hub's links shrink to one a member, and each step ends in a written table.
    """
    edges = written(
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    for _ in range(max_rounds):
        if _stars(edges):
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = _beside(both, low).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            _beside(large, low)
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        edges = written(small, "links")
    raise RuntimeError(f"groups did not settle in {max_rounds} rounds")
