"""Size-tiered compaction of immutable shards under a versioned manifest.

An arrival is appended as a run of small Parquet shards. Runs belong to tiers
by size: tier t holds runs of up to BASE * FANOUT**t bytes. When a tier has
FANOUT runs the oldest FANOUT of them are merged into one run of files near the
target size. A version is one JSON manifest that lists the live runs. It is
written under another name and committed by a rename that fails if the version
exists: then nothing of the attempt is visible, and it is tried again on top of
the version that won. A writer that dies leaves a draft that nobody reads and
blocks no one. Shards are never changed, and those that no kept manifest lists
are garbage once they are old enough not to belong to a running writer.

Merging reads the runs and coalesces partitions to as many as there are files
to write, which follows from bytes alone, so it moves no row between executors
by key and a hot key makes no large task. Writes are Spark's own committed writes: a lost executor's tasks are
run again.

Defined results: nulls, empty and very long texts and repeated rows are
stored as they are; an empty arrival adds no run; an empty store reads as an
empty table with the schema of its manifest; columns of any name are kept.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.llm.common import free_names, new_path

TARGET = 128 << 20  # bytes of a merged file
BASE = 32 << 20  # bytes of the largest run of tier 0
FANOUT = 4
ARRIVALS = 8


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Run:
    path: str
    bytes: int
    files: int
    rows: int
    tier: int


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, base: int = BASE, fanout: int = FANOUT):
        self.spark, self.root, self.target, self.base, self.fanout = spark, root, target, base, fanout
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{root}/manifests"))

    # --- manifests

    def versions(self) -> list[int]:
        found = self._fs.listStatus(self._path(f"{self.root}/manifests"))
        names = [s.getPath().getName() for s in found]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The live runs and schema of a version, the newest by default."""
        known = self.versions()
        if not known:
            return {"version": 0, "schema": None, "runs": []}
        stream = self._fs.open(self._path(f"{self.root}/manifests/v{known[-1] if version is None else version:08d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        out = json.loads(text)
        return out | {"runs": [Run(**r) for r in out["runs"]]}

    def commit(self, version: int, runs: list[Run], schema: T.StructType) -> None:
        """Create the manifest of a version, all of it or nothing: the bytes go
        to a file of another name, and a rename that refuses to overwrite
        makes them visible."""
        final = self._path(f"{self.root}/manifests/v{version:08d}.json")
        draft = self._path(f"{self.root}/manifests/.draft-{uuid.uuid4().hex}")
        body = json.dumps({"version": version, "schema": schema.json(), "runs": [asdict(r) for r in runs]}).encode()
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        jvm = self.spark.sparkContext._jvm
        options = jvm.org.apache.hadoop.fs.Options.Rename
        never = self.spark.sparkContext._gateway.new_array(options, 1)
        never[0] = options.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, final, never)
        except Exception as e:
            self._fs.delete(draft, False)
            if not self._fs.exists(final):
                raise
            raise Conflict(f"version {version} is taken") from e

    def _retried(self, change) -> int:
        """Commit change(manifest) -> (runs, schema) on top of the newest
        version, again if another writer was faster; the version committed, or
        the newest if change gives None."""
        while True:
            last = self.manifest()
            made = change(last)
            if made is None:
                return last["version"]
            try:
                self.commit(last["version"] + 1, *made)
                return last["version"] + 1
            except Conflict:
                continue

    # --- runs

    def tier_of(self, size: int) -> int:
        return 0 if size <= self.base else math.ceil(math.log(size / self.base, self.fanout) - 1e-9)

    def _write(self, df: DataFrame, name: str) -> Run | None:
        path = f"{self.root}/runs/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        files = [s for s in self._fs.listStatus(self._path(path)) if s.getPath().getName().startswith("part-")]
        rows = self.spark.read.parquet(path).count() if files else 0
        if not rows:
            self._fs.delete(self._path(path), True)
            return None
        size = sum(s.getLen() for s in files)
        return Run(path, size, len(files), rows, self.tier_of(size))

    def append(self, df: DataFrame) -> int:
        """Add an arrival as a run of its own; the new version."""
        run = self._write(df, "arrival")
        return self._retried(lambda last: ([*last["runs"], *[run] * bool(run)], df.schema))

    def plan(self, runs: list[Run]) -> list[list[Run]]:
        """Groups to merge: in each tier, FANOUT runs at a time, oldest first
        (manifests list runs by age)."""
        tiers: dict[int, list[Run]] = {}
        for r in runs:
            tiers.setdefault(r.tier, []).append(r)
        return [g[i:i + self.fanout] for _, g in sorted(tiers.items()) for i in range(0, len(g) - self.fanout + 1, self.fanout)]

    def compact(self) -> int:
        """Merge until no tier is full; the newest version."""
        while True:
            last = self.manifest()
            groups = self.plan(last["runs"])
            if not groups:
                return last["version"]
            group, schema = groups[0], T.StructType.fromJson(json.loads(last["schema"]))
            files = max(1, round(sum(r.bytes for r in group) / self.target))
            run = self._write(self.spark.read.schema(schema).parquet(*[r.path for r in group]).coalesce(files), "merged")
            gone = {r.path for r in group}

            def swap(now):
                if not gone <= {r.path for r in now["runs"]}:
                    return None  # another writer has merged some of them
                return [*[r for r in now["runs"] if r.path not in gone], *[run] * bool(run)], T.StructType.fromJson(json.loads(now["schema"]))

            self._retried(swap)

    def vacuum(self, keep: int = 2, seconds: float = 86_400) -> int:
        """Delete the manifests before the newest keep, and the runs that none
        of these lists and that are older than seconds (younger ones may be of
        a writer that has not committed yet); how many runs."""
        known = self.versions()
        live = {r.path.rsplit("/", 1)[1] for v in known[-keep:] for r in self.manifest(v)["runs"]}
        for v in known[:-keep]:
            self._fs.delete(self._path(f"{self.root}/manifests/v{v:08d}.json"), False)
        if not self._fs.exists(self._path(f"{self.root}/runs")):
            return 0
        oldest = (time.time() - seconds) * 1000
        gone = [s.getPath() for s in self._fs.listStatus(self._path(f"{self.root}/runs")) if s.getPath().getName() not in live and s.getModificationTime() <= oldest]
        for p in gone:
            self._fs.delete(p, True)
        return len(gone)

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        schema = T.StructType.fromJson(json.loads(m["schema"])) if m["schema"] else T.StructType([])
        if not m["runs"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[r.path for r in m["runs"]])


def query(spark, sf_dir: str) -> DataFrame:
    """op8: documents arrive in ARRIVALS parts, are compacted after each, and
    are read back under the last manifest: for every document its bytes and
    digest, the shard that holds it, the tier and the version."""
    store = ShardStore(spark, new_path(spark, "shards"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    landed = new_path(spark, "arrivals")
    arrival = F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS))
    name, = free_names(docs.columns, "arrival")
    docs.withColumn(name, arrival).write.partitionBy(name).option("compression", "zstd").parquet(landed)
    for k in range(ARRIVALS):
        found = spark.read.schema(docs.schema).parquet(f"{landed}/{name}={k}") if store._fs.exists(store._path(f"{landed}/{name}={k}")) else docs.limit(0)
        store.append(found)
        store.compact()
        store.vacuum(keep=1, seconds=0)
    m = store.manifest()
    tier = F.create_map(*[x for r in m["runs"] for x in (F.lit(r.path.rsplit("/", 1)[1]), F.lit(r.tier))]) if m["runs"] else F.lit(None).cast("map<string,int>")
    found = store.read().select("doc_id", "text", F.element_at(F.split(F.input_file_name(), "/"), -2).alias("run"), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("shard"))
    return found.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text"), 256).alias("text_sha256"),
                        "run", "shard", F.try_element_at(tier, F.col("run")).alias("tier"), F.lit(m["version"]).alias("version"))
