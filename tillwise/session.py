"""Session settings the library relies on."""

from __future__ import annotations

import warnings

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Runtime SQL settings; all may be set on a session that already runs.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where that costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Columns in files are packed to about a tenth of their rows, and a broadcast side is its rows: without
    # this a dimension of a million keys passes for a small one and is sent through the driver.
    "spark.sql.sources.fileCompressionFactor": "10.0",
    # A retried map task that puts rows elsewhere than its first run restarts its consumers.
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
    # Streaming state lives off-heap and is checkpointed as a change log.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built. They change that session,
    its time zone and ANSI mode included; what could not be set is told in a warning."""
    left = []
    for key, value in RUNTIME.items():
        try:
            if spark.conf.get(key, None) != value:
                spark.conf.set(key, value)
        except PySparkException:
            left.append(key)  # a setting this Spark build does not know or does not let us change
    if left:
        warnings.warn(f"settings left as they are: {', '.join(left)}", stacklevel=2)
    return spark


def build(app: str = "tillwise", master: str | None = None, **conf: str) -> SparkSession:
    """A tuned session. On a cluster give ``spark.checkpoint.dir`` and
    ``spark.sql.shuffle.partitions`` (two to three times the cores) in the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
