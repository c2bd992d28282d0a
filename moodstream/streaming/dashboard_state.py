"""Dashboard tables of a stream of joined rows, kept up to date by changes.

What a batch costs depends on the batch, not on what came before:

1. **One row per id.** A stateful operator remembers, per id, the row with the
   earliest ``joined_at``. A row that beats the remembered one *withdraws* it, so
   the stream becomes a stream of changes: rows that count (+1) and rows that
   no longer do (-1).
2. **Ledger.** The changes of a batch are summed per key: rows per bucket and
   label, per label, per latency value, per model version, and per hour. All
   dashboard numbers are sums over the ledger: a withdrawn row is a negative
   count. Exact percentiles come from the counts per latency value.
3. **Segments.** Sums of batches are kept like the digits of a binary counter:
   after batch b there is one segment for each 1 in b + 1, over as many batches.
   A batch writes one new segment, out of its own sums and the segments that
   it replaces, so that a row is written again log2(batches) times at most and a
   reader has log2(batches) segments to add up. The rows themselves (for the
   latest ones) lie in segments of their own, by hour.
4. **Commit.** A batch writes its segments first and then its version, one row
   in ``versions``. Readers look at the newest version and the segments that its
   number names, so they see all tables of one batch, and a batch that fails in
   between and runs again replaces what it had written. Segments that no recent
   version names are deleted by ``prune``.

The latest rows are found by the ledger's counts per hour: only the hours that
are needed are read.

Defined cases: rows without an id count as one id, as in ``dedupe_first``;
``joined_at`` null comes last; of equal ``joined_at`` the row that arrived first
stays; rows without a time or a label are in no bucket but in ``total``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from moodstream.functions.numeric import safe_div
from moodstream.functions.time import epoch_micros, from_micros
from moodstream.operators import dashboard
from moodstream.plans.ordered import percentiles_of_counts
from moodstream.plans.scalar import attach_row
from moodstream.schemas import LABELS
from moodstream.session import stream_checkpoint
from moodstream.streaming.join_timers import ROCKSDB

ROWS = "id string, label string, text string, confidence double, predicted_us long, joined_us long, latency double, model_version string"
CHANGES = f"{ROWS}, change int"
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]
STEP, HOUR = 10_000_000, 3_600_000_000  # the finest bucket; the buckets on offer are multiples of it
KEYS = ["kind", "at", "name", "value"]


class FirstRows(StatefulProcessor):
    """The row with the earliest ``joined_at`` per id, as changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", ROWS)

    def handleInputRows(self, key, rows, timerValues):
        held = tuple(self.first.get()) if self.first.exists() else None
        place = COLUMNS.index("joined_us")
        best = held
        for r in rows:
            row = tuple(r[c] for c in COLUMNS)
            if best is None or (row[place] is None, row[place] or 0) < (best[place] is None, best[place] or 0):
                best = row
        if best is not held:
            self.first.update(best)
            if held is not None:
                yield Row(**dict(zip(COLUMNS, held, strict=True)), change=-1)
            yield Row(**dict(zip(COLUMNS, best, strict=True)), change=1)

    def close(self) -> None:
        pass


def as_rows(joined: DataFrame) -> DataFrame:
    return joined.select("id", "label", "text", "confidence", epoch_micros("predicted_at").alias("predicted_us"), epoch_micros("joined_at").alias("joined_us"),
                         F.col("end_to_end_ms").cast("string").try_cast("double").alias("latency"), "model_version")


def changes(joined: DataFrame) -> DataFrame:
    """The stream of changes of a stream of joined rows."""
    if joined.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise RuntimeError(f"the state of ids needs spark.sql.streaming.stateStore.providerClass={ROCKSDB}")
    return as_rows(joined).groupBy("id").transformWithState(FirstRows(), CHANGES, "Append", "None")


def ledger_of(change: DataFrame) -> DataFrame:
    """Changes -> ``kind, at, name, value, rows, named`` (rows with an id)."""
    def floor(step):
        return F.col("predicted_us") - F.pmod(F.col("predicted_us"), F.lit(step).cast("long"))

    def entry(kind, at=None, name=None, value=None):
        return F.struct(F.lit(kind).alias("kind"), (F.lit(None) if at is None else at).cast("long").alias("at"),
                        (F.lit(None) if name is None else F.col(name)).cast("string").alias("name"), (F.lit(None) if value is None else F.col(value)).cast("double").alias("value"))

    entries = F.array_compact(F.array(
        F.when(F.col("predicted_us").isNotNull() & F.col("label").isNotNull(), entry("bucket", floor(STEP), "label")), entry("label", name="label"),
        F.when(F.col("latency").isNotNull(), entry("latency", value="latency")), F.when(F.col("model_version").isNotNull(), entry("version", name="model_version")),
        entry("hour", floor(HOUR))))
    each = change.select(F.col("change").cast("long").alias("rows"), F.when(F.col("id").isNotNull(), F.col("change")).otherwise(0).cast("long").alias("named"),
                         F.inline(entries))
    return _added(each, KEYS, ["rows", "named"])


def _added(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums per key; what adds up to no rows goes."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).where(F.col(sums[0]) != 0)


def segments(batches: int) -> list[tuple[int, int]]:
    """The segments (first, last batch) that hold ``batches`` batches: one for each 1 of the number."""
    out, lo = [], 0
    for bit in reversed(range(batches.bit_length())):
        if batches >> bit & 1:
            out.append((lo, lo + (1 << bit) - 1))
            lo += 1 << bit
    return out


def _read(spark: SparkSession, folder: str, table: str, some: list[tuple[int, int]]) -> DataFrame | None:
    paths = [f"{folder}/{table}/{lo}-{hi}" for lo, hi in some]
    return spark.read.option("basePath", paths[0]).parquet(paths[0]) if len(paths) == 1 else _union([_read(spark, folder, table, [s]) for s in some])


def _union(frames: list[DataFrame]) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def apply_changes(change: DataFrame, folder: str, batch_id: int) -> None:
    """Adds the changes of a batch to the state in ``folder`` as version ``batch_id``."""
    spark = change.sparkSession
    held = change.withColumn("hour", F.col("predicted_us") - F.pmod(F.col("predicted_us"), F.lit(HOUR).cast("long"))).persist()
    lo, hi = segments(batch_id + 1)[-1]
    replaced = [s for s in segments(batch_id) if s[0] >= lo]
    ledger, rows = ledger_of(held), held
    if replaced:
        ledger = _added(ledger.unionByName(_read(spark, folder, "ledger", replaced)), KEYS, ["rows", "named"])
        rows = rows.unionByName(_read(spark, folder, "rows", replaced).select(*rows.columns))
    ledger.write.mode("overwrite").parquet(f"{folder}/ledger/{lo}-{hi}")
    # A row and its withdrawal go together.
    kept = rows.groupBy(*COLUMNS, "hour").agg(F.sum("change").cast("int").alias("change")).where("change <> 0")
    kept.write.mode("overwrite").partitionBy("hour").parquet(f"{folder}/rows/{lo}-{hi}")
    spark.range(1).select(F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(f"{folder}/versions/version={batch_id}")
    held.unpersist()


def start_incremental_dashboard(joined: DataFrame, folder: str, query_name: str = "dashboard_state", trigger: dict | None = None):
    w = changes(joined).writeStream.queryName(query_name).foreachBatch(lambda batch, batch_id: apply_changes(batch, folder, batch_id)) \
        .option("checkpointLocation", stream_checkpoint(joined.sparkSession, query_name))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def newest_version(spark: SparkSession, folder: str) -> int:
    return spark.read.parquet(f"{folder}/versions").agg(F.max("version")).first()[0]


def tables(spark: SparkSession, folder: str, freq_seconds: int = 30, version: int | None = None, n_latest: int = 15) -> dict[str, DataFrame]:
    """KPIs, bucket counts and latest reviews as of a version (the newest)."""
    step = freq_seconds * 1_000_000
    if step % STEP:
        raise ValueError(f"buckets are multiples of {STEP // 1_000_000} s")
    live = segments(1 + (newest_version(spark, folder) if version is None else version))
    ledger = _added(_read(spark, folder, "ledger", live), KEYS, ["rows", "named"]).checkpoint()
    return {"kpis": _kpis(ledger), "bucket_counts": _buckets(ledger, step), "latest": _latest(_read(spark, folder, "rows", live), ledger, n_latest)}


def _kpis(ledger: DataFrame) -> DataFrame:
    of = ledger.where("kind = 'label'")
    known = F.sum(F.when(F.col("name").isNotNull(), F.col("rows")))
    base = of.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total"), *[
        safe_div(F.coalesce(F.sum(F.when(F.col("name") == lab, F.col("rows"))), F.lit(0)), F.coalesce(known, F.lit(0))).alias(f"{lab}_share") for lab in LABELS])
    versions = ledger.where("kind = 'version'").agg(F.array_sort(F.collect_list("name")).alias("model_versions"))
    spread = percentiles_of_counts(ledger.where("kind = 'latency'"), "value", "rows", {"p50_latency_ms": 0.5, "p95_latency_ms": 0.95})
    return attach_row(attach_row(base, versions), spread)


def _buckets(ledger: DataFrame, step: int) -> DataFrame:
    b = ledger.where("kind = 'bucket'").withColumn("bucket_us", F.col("at") - F.pmod(F.col("at"), F.lit(step).cast("long")))
    per = b.groupBy("bucket_us").agg(*[F.coalesce(F.sum(F.when(F.col("name") == lab, F.col("named"))), F.lit(0)).alias(f"_n{i}") for i, lab in enumerate(LABELS)])
    return dashboard.fill_counts(per.checkpoint(), step)


def _latest(rows: DataFrame, ledger: DataFrame, n: int) -> DataFrame:
    # One row per hour; the newest hours that hold n rows together are enough.
    after = Window.orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    hours = ledger.where("kind = 'hour' AND at IS NOT NULL").select("at", F.sum("rows").over(after).alias("upto"))
    least = hours.where(F.col("upto") >= n).agg(F.max("at")).first()[0]
    some = rows if least is None else rows.where(F.col("hour") >= least)
    live = some.groupBy(*COLUMNS).agg(F.sum("change").alias("change")).where("change > 0")
    return dashboard.latest(live.withColumn("predicted_at", from_micros("predicted_us")), n)


def prune(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Deletes segments and versions that none of the last ``keep`` versions
    names; returns the deleted paths. A reader of an older version fails."""
    newest = newest_version(spark, folder)
    named = {f"{lo}-{hi}" for v in range(max(0, newest - keep + 1), newest + 1) for lo, hi in segments(v + 1)}
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for table in ("ledger", "rows", "versions"):
        for f in fs.listStatus(fs_path(f"{folder}/{table}")):
            name = f.getPath().getName()
            old = int(name.split("=")[1]) <= newest - keep if name.startswith("version=") else name not in named and int(name.split("-")[1]) <= newest
            if f.isDirectory() and old:
                fs.delete(f.getPath(), True)
                gone.append(f"{table}/{name}")
    return gone
