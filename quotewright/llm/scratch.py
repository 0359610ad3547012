"""Written intermediate tables and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Shuffle files of a query go when it ends, instead of when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a folder of this machine only where none is set, as in tests."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='run-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """The rows of ``df``, stored in the shared folder and read again.

    Cuts the lineage without tying rows to an executor: a lost executor only
    repeats its own tasks. Its shuffle files are removed at once. ``batch_rows``
    is the most rows that go to Python at once, where they are large.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    settings = {_CLEANUP: "true"} | ({_BATCH: str(batch_rows)} if batch_rows else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        # Planned anew under these settings; the rows are read from the table from here on.
        df.select("*").write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """Union-find over ``(a, b)`` links: ``(node, component)``, the smallest reachable node.

    Works by star contraction: alternately every node hands its larger
    neighbours, then its smaller ones, to the smallest node it sees, until
    only stars are left; the rounds grow with the logarithm of the longest
    chain. All steps are aggregates and joins; no neighbour list is gathered.
    Nulls and self links are ignored. Nodes without links are not returned.
    """
    edges = written(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        rows = large.join(root, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")
        )
        edges = written(rows.select("e.*").filter("u != v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
