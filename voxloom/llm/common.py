"""Shared pieces of the training-data operators: shared-folder tables, row
clean-up and distributed connected components."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a folder of our own
    only where the setting is absent and all tasks run on this machine, as in
    tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = spark.sparkContext.applicationId
    if key not in _own_dirs:
        _own_dirs[key] = "file://" + tempfile.mkdtemp(prefix="voxloom-")
    return _own_dirs[key]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone at exit; a leftover table is harmless
        pass


_scopes: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/voxloom-{name}-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(path)
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends at files
    that outlive any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    shrink(spark)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession, *keep: str):
    """Deletes at its end the tables made within, but for those of the names in
    keep. What leaves the block must not read the deleted ones."""
    _scopes.append(made := [])
    try:
        yield
    finally:
        _scopes.remove(made)
    for path in made:
        if not path.rsplit("/", 1)[1].startswith(tuple(f"voxloom-{name}-" for name in keep)):
            _remove(spark, path)
    release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that nothing
    refers to any more, such as those behind a table just written."""
    for _ in range(2):  # first the Python side's references go, then the JVM's
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)
    trim(spark)


def shrink(spark: SparkSession) -> None:
    """Between two plans: garbage of planning goes once the driver's heap has
    grown past half of its limit, as the JVM gives heap back to the system only
    when all of it is collected; so does what native code has freed."""
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > runtime.maxMemory() // 2:
        gc.collect()
        runtime.gc()
    trim(spark)


def trim(spark: SparkSession) -> bool:
    """Have the C library give memory that the driver's JVM freed (compilers,
    codecs, class data) back to the system; it keeps it otherwise. False where
    the JVM has no such command."""
    try:
        gateway = spark.sparkContext._gateway
        jvm = gateway.jvm
        # the server's own class is not open to reflection, its interface is
        named = jvm.java.lang.Class.forName
        kinds, given = gateway.new_array(jvm.java.lang.Class, 4), gateway.new_array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = named(kind)
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        named("javax.management.MBeanServerConnection").getMethod("invoke", kinds).invoke(server, given)
    except Exception:  # another system or an older JVM: nothing depends on it
        return False
    return True


def discard(df: DataFrame) -> None:
    """Delete a materialized table that nothing will read again."""
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/voxloom-" in f:
            _remove(df.sparkSession, f)


def free_names(cols: list[str], *names: str) -> list[str]:
    """names, each with as many underscores before it as it takes to clash with
    none of cols."""
    taken = {c.lower() for c in cols}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def once(value):
    """A long computed once for a row. Generated code computes a plain one where
    it is used, which is the loop over the elements if an explode follows; one
    that is not deterministic it computes at its place."""
    return value.cast("long").bitwiseOR(F.monotonically_increasing_id().bitwiseAND(F.lit(0).cast("long")))


def fold_of(doc_id, modulus: int):
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v); the
    component is its smallest node.

    Alternates large-star and small-star; a hub is never gathered: each step
    is a map-side combined minimum and an equi join (split by AQE if skewed).
    Every round is a table in the shared folder. Null or equal ends are
    ignored; no edges give no rows."""
    spark = edges.sparkSession
    cur = materialize(
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:  # ends, as every round that changes an edge lowers its ends
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        nxt = materialize(small, "edges")
        new = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(cur)
        cur = nxt
        if tuple(new) == mark:
            break
        mark = tuple(new)
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
