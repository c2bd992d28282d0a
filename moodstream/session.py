"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every moodstream job relies on. Session time zone must be UTC:
# timestamps cross the JSON boundary as UTC ISO-8601 strings.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A checkpoint's files go when the frame that reads them is released.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # JSON objects that repeat a key keep its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "moodstream",
              conf: dict[str, str] | None = None) -> SparkSession:
    """Builds (or returns) a session with the defaults above.

    ``master`` is only set when given, so a cluster submit keeps its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is; an
    unset one is an error there, as executors cannot read a folder of one
    machine. In local mode (one process) a scratch folder is made and set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: master {master} needs a folder that all executors share")
        current = tempfile.mkdtemp(prefix="moodstream-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def stream_checkpoint(spark: SparkSession, query_name: str) -> str:
    """Per-query checkpoint location under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "streams", query_name)


def ship_package(spark: SparkSession) -> None:
    """Makes ``moodstream`` importable on the executors' Python workers
    (``mapInPandas``/``applyInPandasWithState`` functions live in it) by
    adding a zip of the package with ``addPyFile`` — the programmatic form
    of ``spark-submit --py-files``. Done once per SparkContext."""
    import zipfile

    import moodstream

    sc = spark.sparkContext
    if getattr(sc, "_moodstream_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(moodstream.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="moodstream-pkg-"), "moodstream.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    sc._moodstream_shipped = True
