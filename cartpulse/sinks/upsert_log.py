"""A log of upserts whose folders stay bounded: base snapshot, deltas, manifest.

Every micro-batch writes one delta, ``deltas/run_started=R/batch_id=B``. Compaction
folds the deltas of finished batches into the base: for the days that they touch it
writes the last row of each key to ``base/<generation>/log_day=D``, then publishes a
new manifest by one rename that never overwrites. The manifest names the folder of
every day and the last (run, batch) that the base holds; readers take these folders
and the later deltas, nothing else. So a compaction that dies before the rename has
only left folders that nobody reads, one that dies after it has only not removed
what is folded; the next one removes both. Folders that the manifest before names
stay until then, for readers that began with it.

The file system must rename a file as one step, as the checkpoints of a stream
need, too. One writer (the stream's ``foreachBatch``) is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_COLUMNS = [T.StructField("run_started", T.LongType()), T.StructField("batch_id", T.LongType())]


@dataclass
class Manifest:
    """What the base holds: folders by day, and all batches up to (run, batch)."""
    version: int = 0
    run: int = -1
    batch: int = -1
    days: dict[str, str] = field(default_factory=dict)  # day -> generation


class UpsertLog:
    """Rows of ``schema``, of which the last for each ``key`` counts; ``day`` is the
    column whose date the base is kept by."""

    roots = ("base",)  # folders that a generation lies in

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: list[str], day: str) -> None:
        self.spark, self.path, self.key, self.day = spark, path.rstrip("/"), key, day
        self.schema = T.StructType(schema.fields + LOG_COLUMNS)
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    # --- files ---------------------------------------------------------------

    def _hadoop(self, *parts: str):
        p = self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return p.getFileSystem(self.conf), p

    def _list(self, *parts: str) -> list[str]:
        fs, p = self._hadoop(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _delete(self, *parts: str) -> None:
        fs, p = self._hadoop(*parts)
        fs.delete(p, True)

    def _rename(self, old: str, new: str) -> None:
        """Fails if ``new`` exists."""
        _, a = self._hadoop(old)
        _, b = self._hadoop(new)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), self.conf)
        none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(context.makeQualified(a), context.makeQualified(b), none)

    def manifest(self) -> Manifest:
        versions = [n for n in self._list("manifest") if n.endswith(".json") and not n.startswith("_")]
        if not versions:
            return Manifest()
        fs, p = self._hadoop("manifest", versions[-1])
        stream = fs.open(p)
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _publish(self, manifest: Manifest) -> None:
        draft = f"manifest/_{uuid.uuid4().hex}"
        fs, p = self._hadoop(draft)
        out = fs.create(p)
        try:
            out.write(bytearray(json.dumps(vars(manifest)).encode()))
        finally:
            out.close()
        self._rename(draft, f"manifest/{manifest.version:012d}.json")

    # --- rows ------------------------------------------------------------------

    def append(self, rows: DataFrame, run: int, batch: int) -> None:
        """Write a batch's delta; a batch that is executed again replaces its own."""
        (rows.withColumn("run_started", F.lit(run).cast("long")).withColumn("batch_id", F.lit(batch).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_started", "batch_id").parquet(f"{self.path}/deltas"))

    def deltas(self) -> list[tuple[int, int]]:
        """(run, batch) of every delta folder, folded ones included."""
        return sorted((int(r.partition("=")[2]), int(b.partition("=")[2]))
                      for r in self._list("deltas") if r.startswith("run_started=")
                      for b in self._list("deltas", r) if b.startswith("batch_id="))

    def _later(self, manifest: Manifest):
        run, batch = F.col("run_started"), F.col("batch_id")
        return (run > manifest.run) | ((run == manifest.run) & (batch > manifest.batch))

    def _rows_of(self, manifest: Manifest, days: dict[str, str]) -> list[DataFrame]:
        out = []
        if self._list("deltas"):
            out.append(self.spark.read.schema(self.schema).parquet(f"{self.path}/deltas")
                       .where(self._later(manifest)).select(*self.schema.fieldNames()))
        folders = [f"{self.path}/base/{gen}/log_day={day}" for day, gen in sorted(days.items())]
        if folders:
            out.append(self.spark.read.schema(self.schema).parquet(*folders))
        return out

    def read(self) -> DataFrame:
        """Base and later deltas; the last row of a key is that with the greatest
        (run_started, batch_id)."""
        manifest = self.manifest()
        parts = self._rows_of(manifest, manifest.days)
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def last_rows(self, log: DataFrame) -> DataFrame:
        """The last row of each key; ``row_number() = 1`` limits before the shuffle."""
        w = Window.partitionBy(*self.key).orderBy(F.desc_nulls_last("run_started"), F.desc("batch_id"))
        return log.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")

    # --- compaction --------------------------------------------------------------

    def compact(self, run: int, batch: int) -> None:
        """Fold all deltas up to (run, batch), batches that will not run again, into
        the base: only the days that these touch are rewritten."""
        before = self.manifest()
        live = [d for d in self.deltas() if (before.run, before.batch) < d <= (run, batch)]
        if live:
            log_day = F.date_format(F.col(self.day), "yyyy-MM-dd")
            upto = Manifest(run=live[-1][0], batch=live[-1][1])
            deltas, = self._rows_of(before, {})
            folded = deltas.where(~self._later(upto)).withColumn("log_day", log_day)
            days = [r[0] for r in folded.select("log_day").distinct().collect()]
            touched = {d: before.days[d] for d in days if d in before.days}
            for base in self._rows_of(before, touched)[1:]:
                folded = folded.unionByName(base.withColumn("log_day", log_day))
            generation = uuid.uuid4().hex
            if days:  # else the deltas are empty
                self._write_base(self.last_rows(folded), generation)
            after = Manifest(before.version + 1, *live[-1],
                             {**before.days, **{d: generation for d in days}})
            self._publish(after)
            self._clean(before, after)

    def _write_base(self, rows: DataFrame, generation: str) -> None:
        (rows.hint("rebalance", "log_day").write.partitionBy("log_day")
         .parquet(f"{self.path}/base/{generation}"))

    def _clean(self, before: Manifest, after: Manifest) -> None:
        """Remove what neither the new manifest nor the one before it needs."""
        for run, batch in self.deltas():
            if (run, batch) <= (before.run, before.batch):
                self._delete("deltas", f"run_started={run}", f"batch_id={batch}")
        for r in self._list("deltas"):
            if r.startswith("run_started=") and not self._list("deltas", r):
                self._delete("deltas", r)
        needed = {(g, d) for m in (before, after) for d, g in m.days.items()}
        for root in self.roots:
            for generation in self._list(root):
                held = [n for n in self._list(root, generation) if n.startswith("log_day=")]
                kept = [n for n in held if (generation, n.partition("=")[2]) in needed]
                for n in set(held).difference(kept):
                    self._delete(root, generation, n)
                if not kept:
                    self._delete(root, generation)
        for name in self._list("manifest"):
            if name not in {f"{m.version:012d}.json" for m in (before, after)}:
                self._delete("manifest", name)
