"""Output of long-running streams in few files: segments, merged level by level, and a manifest that names the live ones.

Every micro-batch becomes a segment of level 0.  As soon as ``fan_out`` neighbouring segments of one level are there, they are
merged into one of the next, so a run of ``n`` batches has at most ``fan_out`` times ``log n`` segments.  The manifest
is a file for each version; a version becomes visible by one rename that fails if another writer was first, who
then starts over from the new version.  Readers take the newest version and read what it names, without listing any data;
a batch that is in the manifest is finished, and running it again changes nothing.
"""

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "_manifest"
#: Versions of the manifest that are kept for readers that have just looked one up.
KEPT_VERSIONS = 20
#: Bytes above which a merged segment is written in several files for each value of its partition column.
FILE_BYTES = 256_000_000
#: Rows above which it is, too: a task sorts its rows by that column, and in memory they are ten times as large as in files.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class Segment:
    """``values``: those of the partition column, as folders name them."""

    name: str
    run: str
    first: int
    last: int
    level: int
    values: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    segments: tuple[Segment, ...] = ()
    #: Names of segments that have been merged, with the time when that happened.
    retired: Mapping[str, float] = field(default_factory=dict)

    def covers(self, run: str, batch_id: int) -> bool:
        return any(s.run == run and s.first <= batch_id <= s.last for s in self.segments)


class _Folder:
    """Spark's file system below a path: whatever Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.hadoop, self.root = self.jvm.org.apache.hadoop.fs, path.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.files = self.at("").getFileSystem(self.conf)

    def at(self, name: str):
        return self.hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        place = self.at(name)
        return [status.getPath().getName() for status in self.files.listStatus(place)] if self.files.exists(place) else []

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Makes the file visible as a whole; False if it is there already."""
        held = f"{MANIFEST}/.{uuid.uuid4().hex}"
        stream = self.files.create(self.at(held), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.hadoop.FileContext.getFileContext(self.at("").toUri(), self.conf)
        never_replace = self.gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        try:
            context.rename(self.files.makeQualified(self.at(held)), self.files.makeQualified(self.at(name)), never_replace)
        except Py4JJavaError as error:
            self.delete(held)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)

    def size(self, name: str) -> int:
        return self.files.getContentSummary(self.at(name)).getLength() if self.files.exists(self.at(name)) else 0

    def changed(self, name: str) -> float:
        return self.files.getFileStatus(self.at(name)).getModificationTime() / 1000


def _versions(folder: _Folder) -> list[int]:
    return sorted(int(name[:-5]) for name in folder.names(MANIFEST) if name.endswith(".json") and name[:-5].isdigit())


def load(spark: SparkSession, path: str) -> Manifest:
    folder = _Folder(spark, path)
    versions = _versions(folder)
    if not versions:
        return Manifest()
    stored = json.loads(folder.read(f"{MANIFEST}/{versions[-1]:012d}.json"))
    segments = tuple(Segment(**{**s, "values": tuple(s["values"])}) for s in stored["segments"])
    return Manifest(versions[-1], segments, stored["retired"])


def commit(spark: SparkSession, path: str, change: Callable[[Manifest], Manifest | None]) -> bool:
    """Applies ``change`` to the newest version and publishes the result; False if it has nothing to change.

    Whoever comes second starts over, so ``change`` sees every version that is published before its own.
    """
    folder = _Folder(spark, path)
    while True:
        before = load(spark, path)
        after = change(before)
        if after is None:
            return False
        text = json.dumps({"segments": [asdict(s) for s in after.segments], "retired": dict(after.retired)})
        if folder.create(f"{MANIFEST}/{before.version + 1:012d}.json", text):
            for version in _versions(folder)[:-KEPT_VERSIONS]:
                folder.delete(f"{MANIFEST}/{version:012d}.json")
            return True


def _write(rows: DataFrame, path: str, column: str, segment: Segment) -> Segment:
    rows.write.mode("error").partitionBy(column).parquet(f"{path}/segment={segment.name}")
    folders = _Folder(rows.sparkSession, path).names(f"segment={segment.name}")
    prefix = f"{column}="
    return replace(segment, values=tuple(sorted(n[len(prefix) :] for n in folders if n.startswith(prefix))))


def read_live(
    spark: SparkSession, path: str, schema: StructType, column: str, values: Callable[[str], bool] | None = None
) -> DataFrame:
    """The rows of all live segments, of the partitions whose value (as in the folder's name) ``values`` accepts.

    ``schema`` has the partition column; no file is opened to find one out.
    """
    return _read(spark, path, load(spark, path).segments, schema, column, values)


def _read(spark, path, segments, schema, column, values=None) -> DataFrame:
    found = [
        f"{path}/segment={s.name}/{column}={value}" for s in segments for value in s.values if values is None or values(value)
    ]
    if not found:
        return spark.createDataFrame([], schema)
    with_segment = StructType([*schema.fields]).add("segment", "string")
    return spark.read.schema(with_segment).option("basePath", path).parquet(*found).select(*schema.names)


@dataclass(frozen=True)
class SegmentFolder:
    """``foreachBatch`` writer of one query: every batch counts once, however often it is run.

    Batch ids start over with a new checkpoint, so ``run`` must change whenever the checkpoint does.  ``merge`` is what becomes
    of the rows of several segments, such as adding up partial sums; it must not matter in which order or grouping it is
    applied.  With ``compacting`` False another job calls :func:`compact`.
    """

    path: str
    run: str
    column: str = "billing_period"
    fan_out: int = 8
    merge: Callable[[DataFrame], DataFrame] | None = None
    compacting: bool = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if load(spark, self.path).covers(self.run, batch_id):
            return
        name = f"{self.run}-{batch_id:012d}-{uuid.uuid4().hex}"
        segment = _write(batch, self.path, self.column, Segment(name, self.run, batch_id, batch_id, 0, ()))

        def add(before: Manifest) -> Manifest | None:
            # An attempt that was thought dead may have finished meanwhile.
            return None if before.covers(self.run, batch_id) else replace(before, segments=(*before.segments, segment))

        commit(spark, self.path, add)
        if self.compacting:
            compact(spark, self.path, batch.schema, self.column, self.fan_out, self.merge)


def _due(manifest: Manifest, fan_out: int) -> list[Segment] | None:
    """The first ``fan_out`` neighbouring segments of one run and level; a batch that is missing may still come."""
    groups: dict[tuple[str, int], list[Segment]] = {}
    for segment in sorted(manifest.segments, key=lambda s: (s.run, s.level, s.first)):
        own = groups.setdefault((segment.run, segment.level), [])
        if own and own[-1].last + 1 != segment.first:
            own.clear()
        own.append(segment)
        if len(own) == fan_out:
            return own
    return None


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    column: str = "billing_period",
    fan_out: int = 8,
    merge: Callable[[DataFrame], DataFrame] | None = None,
    file_bytes: int = FILE_BYTES,
    file_rows: int = FILE_ROWS,
) -> int:
    """Merges segments until no ``fan_out`` of one level are neighbours; returns how many merges were published.

    Writers go on meanwhile.  If another merge of the same segments was first, this one leaves nothing behind that is read.
    """
    if fan_out < 2:
        raise ValueError("a merge takes two segments at least")
    merged = 0
    while own := _due(load(spark, path), fan_out):
        rows = _read(spark, path, own, schema, column)
        size = sum(_Folder(spark, path).size(f"segment={s.name}") for s in own)
        tasks = max(1, -(-size // file_bytes), -(-rows.count() // file_rows))
        rows = merge(rows) if merge else rows
        # Tasks take ranges of equal size: rows of one value go to neighbouring tasks, so values stay in few files.  Rows that
        # come from files alone have the same numbers whenever they are read, so that even equal ones can be dealt out.
        spread = F.xxhash64(*rows.columns) if merge else F.monotonically_increasing_id()
        rows = rows.repartitionByRange(tasks, column, spread)
        first, last, level = own[0].first, own[-1].last, own[0].level + 1
        name = f"{own[0].run}-{first:012d}-{last:012d}-{uuid.uuid4().hex}"
        segment = _write(rows, path, column, Segment(name, own[0].run, first, last, level, ()))

        def swap(before: Manifest, own=tuple(own), segment=segment) -> Manifest | None:
            if not set(own) <= set(before.segments):
                return None
            kept = tuple(s for s in before.segments if s not in own)
            retired = {**before.retired, **{s.name: time.time() for s in own}}
            return Manifest(before.version, (*kept, segment), retired)

        merged += commit(spark, path, swap)
    return merged


def vacuum(spark: SparkSession, path: str, older_than: float = 24 * 3600) -> list[str]:
    """Deletes segments that no version names since ``older_than`` seconds: merged ones, and those of failed attempts."""
    folder, limit = _Folder(spark, path), time.time() - older_than
    manifest = load(spark, path)
    live = {s.name for s in manifest.segments}
    gone = []
    for name in folder.names(""):
        segment = name.removeprefix("segment=")
        if segment == name or segment in live:
            continue
        since = manifest.retired.get(segment, folder.changed(name))
        if since < limit:
            folder.delete(name)
            gone.append(segment)

    def forget(before: Manifest) -> Manifest | None:
        kept = {name: at for name, at in before.retired.items() if name not in gone}
        return replace(before, retired=kept) if len(kept) < len(before.retired) else None

    commit(spark, path, forget)
    return gone
