"""Helpers the operators share: reading tables, cutting lineage, connected components, native array sums."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import SessionConfigError
from ..plans.publish import drop_staging
from ..session import checkpoint_root


def workers_import(spark: SparkSession) -> None:
    """Lets Python workers of this session import the package from where the driver did.

    For sessions started elsewhere than in the repository; with ``--py-files`` or
    an installed package the path is just not needed.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session that names none gets a scratch folder; on a cluster a
    missing setting is an error, because executors share no local disk.
    """
    sc = spark.sparkContext
    try:
        root = checkpoint_root(spark)
    except SessionConfigError:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise
        root = tempfile.mkdtemp(prefix="assay-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/assay-llm/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    The copy survives the loss of any executor, and a join above it gets
    exchanges of its own, so that AQE can split skewed partitions on both sides.
    """
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside send whole texts to Python in batches of so many rows; bounds workers' memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Tables:
    """Written tables below the shared folder that cut the lineage, with their real sizes as statistics.

    A chain of checkpointed joins carries estimates that square with every step; Parquet files are measured.  ``drop``
    removes what is not needed any more; what a returned DataFrame still reads has to stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame) -> DataFrame:
        return self.write_counted(df, F.count(F.lit(1)))[0]

    def write_counted(self, df: DataFrame, what: Column | None = None) -> tuple[DataFrame, int]:
        """The written table and an aggregate of it (its rows), taken while it is written."""
        path, seen = scratch_path(self.spark, "table"), Observation()
        what = F.count(F.lit(1)) if what is None else what
        df.observe(seen, what.alias("n")).write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        n = seen.get.get("n")
        return out, out.agg(what.alias("n")).first()["n"] if n is None else n

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if id(t) in self.paths:
                drop_staging(self.spark, self.paths.pop(id(t))[1])

    def drop_but(self, *tables: DataFrame) -> None:
        keep = {id(t) for t in tables}
        self.drop(*[t for t, _ in list(self.paths.values()) if id(t) not in keep])


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once, also where ``f`` uses it inside the lambda of another function."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def running_total(lengths: Column) -> Column:
    """Inclusive prefix sums of an array of ints, as bigint, by built-in functions.

    Appending to one accumulator copies it each time; doing that in blocks of
    256, with one offset per block, keeps arrays of 100,000 entries cheap.
    """
    width = 256

    def sums(block: Column, base: Column) -> Column:
        start = F.struct(base.cast("bigint").alias("t"), F.array().cast("array<bigint>").alias("a"))
        return F.aggregate(block, start, lambda acc, x: F.struct(
            (acc["t"] + x).alias("t"), F.concat(acc["a"], F.array(acc["t"] + x)).alias("a")))["a"]

    def in_blocks(lengths: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / width).cast("int")),
                           lambda b: F.slice(lengths, b * width + 1, F.lit(width)))

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, x: a + x))
        bases = F.concat(F.array(F.lit(0).cast("bigint")), sums(totals, F.lit(0)))
        return F.flatten(F.zip_with(blocks, F.slice(bases, F.lit(1), F.size(blocks)), sums))

    return bound(lengths, lambda x: F.when(F.size(x) <= 0, F.array().cast("array<bigint>")).otherwise(bound(in_blocks(x), of_blocks)))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``; component is the smallest node reachable.

    Rounds of hooking and contraction.  Every node points to its least neighbour, if that is smaller; pointers are followed to
    their ends by doubling; then the edges between different ends are the edges of the next round.  A
    component loses half its nodes a round at least, stars and near-stars are done in one.  Minima are combined before the
    shuffle, and both sides of each join are written first, so that a node that holds a third of all edges is split.
    """
    tables, rounds = Tables(edges.sparkSession), []
    edges, left = tables.write_counted(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while left:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = tables.write(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        moved = 1
        while moved:
            to = ends.select(F.col("a").alias("m"), F.col("m").alias("further"))
            step = ends.join(to, "m").select("a", F.col("further").alias("m"), (F.col("m") != F.col("further")).alias("moved"))
            jumped, moved = tables.write_counted(step, F.count_if("moved"))
            tables.drop(ends)
            ends = jumped
        rounds.append(ends)
        end_of = lambda x: ends.select(F.col("a").alias(x), F.col("m").alias(f"m_{x}"))  # noqa: B023, E731
        between = edges.join(end_of("a"), "a").join(end_of("b"), "b").where("m_a != m_b") \
            .select(F.greatest("m_a", "m_b").alias("a"), F.least("m_a", "m_b").alias("b")).distinct()
        between, left = tables.write_counted(between)
        tables.drop(edges)
        edges = between
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    members = rounds[0].select(F.col("a").alias("node"), F.col("m").alias("component"))
    for ends in rounds[1:]:
        members = members.join(ends.select(F.col("a").alias("component"), "m"), "component", "left") \
            .select("node", F.coalesce("m", "component").alias("component"))
    return members
