"""Tables as lists of finished writes.

Data goes to folders of its own, which no reader knows until one row in the table's log names them.
So a reader sees whole writes only, a write that failed half-way is never seen, and rows can be moved
to other files by one more row that names the new folders and the ones they replace. The log is a
folder of small JSON files below the table, one for each row.

A log row is the work of a writer with increasing numbers, such as a stream and its batches. A write
that is repeated under a number already in the log changes nothing. ``fold`` puts the rows of the log
into one, and ``sweep`` deletes files that no row of the last ``keep`` needs, so neither the log nor
the files grow with the number of writes. Folding and compacting are meant for one job at a time, and
folding for tables that no stream follows: who follows reads the rows of the log.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillwise.schemas import with_columns

# adds and replaces name folders below the table; a note is what the writer wants to find again. In
# a row of fold, done and notes hold the last number and note of every writer.
LOG = ("writer string, batch_id bigint, adds array<string>, replaces array<string>, note string, "
       "at double, done map<string,bigint>, notes map<string,string>")
FOLD = "fold"
# Writes of one size that are put together, and seconds for which replaced files stay.
TOGETHER, KEEP = 16, 3600.0


@dataclass
class State:
    """What the log says: folders of the table, and each writer's last number and note."""

    live: list[str] = field(default_factory=list)
    done: dict[str, int] = field(default_factory=dict)
    notes: dict[str, str | None] = field(default_factory=dict)
    replaced: dict[str, float] = field(default_factory=dict)
    files: dict[str, float] = field(default_factory=dict)

    def has(self, writer: str, batch_id: int) -> bool:
        return batch_id <= self.done.get(writer, -1)


def log_path(path: str) -> str:
    return f"{path.rstrip('/')}/_finished"


def _folder(spark: SparkSession, place: str):
    """A path and its file system, as Hadoop knows them."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


# Rows of log files that were read; a log file never changes.
_rows: dict[str, Row] = {}


def _log(spark: SparkSession, path: str) -> list[Row]:
    """The rows of the log. They are few and small, so the driver reads them without a job, each once."""
    place, files = _folder(spark, log_path(path))
    if not files.exists(place):
        return []
    names = [str(f.getPath()) for f in files.listStatus(place)]
    for name in names:
        if name not in _rows and name.endswith(".json"):
            try:
                stream = files.open(_folder(spark, name)[0])
            except Py4JJavaError as gone:  # swept since it was listed
                if "FileNotFoundException" not in str(gone.java_exception):
                    raise
                continue
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            _rows[name] = Row(**json.loads(text), file=name)
    return [_rows[name] for name in names if name in _rows]


def state(spark: SparkSession, path: str) -> State:
    """The table as it is now, from one log row per write since the last fold."""
    rows = _log(spark, path)
    folds = sorted((r for r in rows if r.writer == FOLD), key=lambda r: r.batch_id)
    folded = dict(folds[-1].done) if folds else {}
    found = State(done=dict(folded), notes=dict(folds[-1].notes) if folds else {})
    adds, gone = list(folds[-1].adds) if folds else [], set()
    for r in sorted((r for r in rows if r.writer != FOLD), key=lambda r: (r.at, r.batch_id)):
        for folder in r.replaces:
            found.replaced[folder] = r.at
        if r.batch_id <= folded.get(r.writer, -1):
            found.files[r.file] = folds[-1].at  # covered; of no use once readers know the fold
            continue
        adds += r.adds
        gone.update(r.replaces)
        if r.batch_id > found.done.get(r.writer, -1):
            found.done[r.writer], found.notes[r.writer] = r.batch_id, r.note
    for r in folds[:-1]:
        found.files[r.file] = folds[-1].at
    if folds:
        found.done[FOLD] = folds[-1].batch_id
    found.live = [a for a in dict.fromkeys(adds) if a not in gone]
    return found


def commit(spark: SparkSession, path: str, writer: str, batch_id: int, adds: list[str],
           replaces: list[str] | tuple[str, ...] = (), note: str | None = None, **more) -> None:
    """Make folders part of the table, and others not, by one row of its log."""
    row = {"writer": writer, "batch_id": batch_id, "adds": adds, "replaces": list(replaces), "note": note, "at": time.time(),
           "done": more.get("done"), "notes": more.get("notes")}
    name = f"{writer}-{batch_id}-{uuid.uuid4().hex}.json"
    draft, files = _folder(spark, f"{log_path(path)}/_{name}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(row).encode()))
    stream.close()
    # Readers see it whole or not at all.
    if not files.rename(draft, _folder(spark, f"{log_path(path)}/{name}")[0]):
        raise OSError(f"{name} could not be put into {log_path(path)}")


def append(rows: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Write rows, with their writer and number, as one batch; nothing if it is in the table."""
    spark = rows.sparkSession
    if state(spark, path).has(writer, batch_id):
        return
    folder = f"{writer}-{batch_id}"
    (rows.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").parquet(f"{path}/{folder}"))
    commit(spark, path, writer, batch_id, [folder])


def append_by(rows: DataFrame, path: str, writer: str, number: str) -> None:
    """Write rows as one batch per value of the ``number`` column, which is left out, by one job;
    each batch has as many files as its size calls for. Batches are finished in order of their number."""
    spark = rows.sparkSession
    folder = f"{writer}-{uuid.uuid4().hex}"
    (rows.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.col(number).cast("long"))
     .withColumnRenamed(number, "part").hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/{folder}"))
    parts = spark.read.parquet(f"{path}/{folder}").select("part", "batch_id").distinct().orderBy("batch_id").collect()
    for r in parts:  # one row per batch
        commit(spark, path, writer, r.batch_id, [f"{folder}/part={r.part}"])


def _of(spark: SparkSession, path: str, folders: list[str], schema: StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path}/{folder}" for folder in folders))


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All finished batches, with ``writer`` and ``batch_id``."""
    full = with_columns(schema, writer="string", batch_id="long")
    return _of(spark, path, state(spark, path).live, full)


def replace(rows: DataFrame, path: str, writer: str, batch_id: int, note: str | None = None) -> None:
    """Make rows the whole table; nothing if that was done."""
    spark = rows.sparkSession
    now = state(spark, path)
    if now.has(writer, batch_id):
        return
    folder = f"{writer}-{batch_id}"
    rows.write.mode("overwrite").parquet(f"{path}/{folder}")
    commit(spark, path, writer, batch_id, [folder], [f for f in now.live if f != folder], note)


def read_whole(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``replace`` wrote last."""
    return _of(spark, path, state(spark, path).live, schema)


# Following ---------------------------------------------------------------------------------------

def follow(spark: SparkSession, path: str, one_by_one: bool = False) -> DataFrame:
    """The log as a stream: what is finished from now on, or one write per trigger, however many files
    it has. ``of_entries`` gives the rows of such a batch."""
    reader = spark.readStream.schema(LOG)
    if one_by_one:
        reader = reader.option("maxFilesPerTrigger", 1)
    return reader.json(log_path(path)).where((F.col("writer") != FOLD) & (F.size("replaces") == 0))


def of_entries(spark: SparkSession, path: str, entries: list[Row], schema: StructType) -> DataFrame:
    """The batches that log rows name, from where they are now: ``compact`` may have moved them."""
    wanted = [(r.writer, r.batch_id, r.adds) for r in entries]
    live, full = state(spark, path).live, with_columns(schema, writer="string", batch_id="long")
    here = [f for _, _, adds in wanted for f in adds if f in live]
    rows = _of(spark, path, here, full)
    moved = [(w, b) for w, b, adds in wanted if any(f not in live for f in adds)]
    if moved:
        keys = spark.createDataFrame(moved, "writer string, batch_id bigint")
        packed = _of(spark, path, [f for f in live if f.startswith("tier")], full)
        rows = rows.unionByName(packed.join(keys, ["writer", "batch_id"], "left_semi"))
    return rows


# Keeping it small --------------------------------------------------------------------------------

def _tier(folder: str) -> int:
    return int(folder[4:].split("-")[0]) if folder.startswith("tier") else 0


def compact(spark: SparkSession, path: str, schema: StructType, together: int = TOGETHER) -> int:
    """Put every ``together`` folders of one size together, and those again; returns how many folders
    are left. So a table of n batches has at most ``together`` times log n folders."""
    full, now = with_columns(schema, writer="string", batch_id="long"), state(spark, path)
    tier = 0
    while tier <= max(map(_tier, now.live), default=0):
        folders = [f for f in now.live if _tier(f) == tier]
        if len(folders) >= together:
            made = f"tier{tier + 1}-{uuid.uuid4().hex}"
            # Adaptive execution makes files of its advisory size.
            _of(spark, path, folders, full).hint("rebalance").write.parquet(f"{path}/{made}")
            commit(spark, path, "compact", now.done.get("compact", -1) + 1, [made], folders)
            now = state(spark, path)
        tier += 1
    return len(now.live)


def fold(spark: SparkSession, path: str) -> None:
    """Put the log into one row."""
    now = state(spark, path)
    writers = {w: n for w, n in now.done.items() if w != FOLD}
    commit(spark, path, FOLD, now.done.get(FOLD, -1) + 1, now.live, done=writers, notes=now.notes)


def sweep(spark: SparkSession, path: str, keep: float = KEEP) -> int:
    """Delete folders replaced, and log rows folded, more than ``keep`` seconds ago; returns how many.
    Readers that hold an older list have that long to finish."""
    now, before = state(spark, path), time.time() - keep
    old = [f"{path}/{f}" for f, at in now.replaced.items() if at <= before and f not in now.live]
    old += [f for f, at in now.files.items() if at <= before]
    return sum(_delete(spark, file) for file in old)


def _delete(spark: SparkSession, file: str) -> bool:
    place, files = _folder(spark, file)
    return files.delete(place, True)


def keep_small(spark: SparkSession, path: str, schema: StructType, batch_id: int, every: int = TOGETHER,
               keep: float = KEEP) -> None:
    """Every so many batches: compact and sweep. The log is left whole, for those that follow it."""
    if (batch_id + 1) % every == 0:
        compact(spark, path, schema, every)
        sweep(spark, path, keep)
