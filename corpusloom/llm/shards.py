"""Sharding by size-tiered compaction, with an atomically committed, versioned manifest.

A store is a folder with immutable data files and manifests. ``append`` writes an arrival as small shards, one a task.
``compact`` merges shards of one size tier, the largest at most FAN times the smallest, once FAN of them have gathered, into
files of about TARGET_BYTES; what it writes may fill the next tier, so it goes on until none is full. Both then commit a manifest
under the next version number, put in place by a rename that fails if that version exists. Readers
see the shards of one manifest; what a failed job has written is in none, and ``vacuum`` removes it. Rows are merged by
tasks that read whole shards, without a shuffle, and the tiers of a round are merged at the same time.

A manifest is a list of segments: one line for each write, whose shards are listed in a file of its own that never changes. A commit
writes the segments of what it adds and of what it takes shards from, and names the others. Shards that are too large to be merged aren't
looked at by ``compact``, a segment none of whose shards is gone is read by its folder, and ``shards`` gives
the shards of a version as a table, so what the driver handles grows with the writes, not with the shards.

The rename is atomic on HDFS. The local file system and object stores look for the target first and rename then, so there
two writers that commit at the same moment may both succeed: let one writer at a time commit, or lock by other means.

Defined cases: an empty arrival commits an empty shard, which keeps the schema; repeated rows and nulls are kept as they are;
a text of any length is in one shard; columns may have any names, as the caller chooses those of the locations apart from
them (by default _shard, _shard_bytes and _version, which then take the place of columns of these names).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import free_names, quoted, shared_folder, table

#: Bytes of a compacted file, about; shards that make a tier, and times that sizes may differ in it.
TARGET_BYTES = 128 << 20
FAN = 4
#: Names of the columns that tell a row's shard, its bytes and the version.
LOCATION = ("_shard", "_shard_bytes", "_version")
#: A line of a segment.
SHARD = "path string, bytes long"
#: Tiers that are merged at the same time.
MERGES = 4
#: Arrivals that ``op9_shards_size_tiered`` appends the table in.
ARRIVALS = 4


@dataclass(frozen=True)
class Shard:
    path: str
    bytes: int


@dataclass(frozen=True)
class Segment:
    """The live shards of one write, listed in the file ``name``: how many, how many of them may be merged, and their bytes.

    Those of the folder ``folder`` are all live if ``whole``.
    """

    name: str
    folder: str
    shards: int
    small: int
    bytes: int
    whole: bool = True


class ManifestConflict(RuntimeError):
    """Another writer has committed the version first; read the manifest again and retry."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES):
        self.spark, self.root, self.target = spark, root.rstrip("/"), target_bytes
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, folder: str) -> list[Shard]:
        if not self._fs.exists(self._path(folder)):
            return []
        found = self._fs.listFiles(self._path(folder), True)
        out = []
        while found.hasNext():
            status = found.next()
            path = status.getPath().toString()
            if path.endswith(".parquet"):
                out.append(Shard(path, status.getLen()))
        return sorted(out, key=lambda s: s.path)

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifests")
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(n[1:-5]) for n in names if n[0] == "v" and n.endswith(".json"))

    def _text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def segments(self, version: int | None = None) -> tuple[int, list[Segment]]:
        """The version, by default the last, and its segments; version 0 is the empty store."""
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            return 0, []
        return version, [Segment(**x) for x in json.loads(self._text(f"{self.root}/manifests/v{version:09d}.json"))["segments"]]

    def _listed(self, segments: Iterable[Segment]) -> dict[Segment, list[Shard]]:
        return {g: [Shard(**json.loads(x)) for x in self._text(f"{self.root}/segments/{g.name}").splitlines()] for g in segments}

    def manifest(self, version: int | None = None) -> tuple[int, list[Shard]]:
        """The version, by default the last, and its shards, all of them; ``shards`` gives them as a table."""
        version, segments = self.segments(version)
        return version, [s for listed in self._listed(segments).values() for s in listed]

    def shards(self, version: int | None = None) -> DataFrame:
        """(path, bytes) of the shards of a version."""
        _, segments = self.segments(version)
        if not segments:
            return self.spark.createDataFrame([], SHARD)
        return self.spark.read.schema(SHARD).json([f"{self.root}/segments/{g.name}" for g in segments])

    def _segment(self, folder: str, shards: list[Shard], whole: bool = True) -> Segment:
        """A new segment of ``shards``, which lie in ``folder`` below the folder of data."""
        name = f"{uuid.uuid4().hex}.json"
        out = self._fs.create(self._path(f"{self.root}/segments/{name}"), False)
        out.write("".join(json.dumps(asdict(s)) + "\n" for s in shards).encode())
        out.close()
        return Segment(name, folder, len(shards), sum(map(self._small, shards)), sum(s.bytes for s in shards), whole)

    def _small(self, shard: Shard) -> bool:
        return shard.bytes <= self.target / 2

    def _commit(self, version: int, segments: list[Segment]) -> int:
        """Makes ``segments`` the version after ``version``, or raises ManifestConflict."""
        content = json.dumps({"version": version + 1, "segments": [asdict(g) for g in segments]})
        folder = f"{self.root}/manifests"
        draft, final = self._path(f"{folder}/.draft-{uuid.uuid4().hex}"), self._path(f"{folder}/v{version + 1:09d}.json")
        out = self._fs.create(draft, False)
        out.write(content.encode())
        out.close()
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
            none = self._jvm.java.lang.reflect.Array.newInstance(
                self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
            )
            context.rename(draft, final, none)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise ManifestConflict(f"version {version + 1} exists") from e
            raise
        return version + 1

    def _written(self, rows: DataFrame) -> Segment:
        """The segment of the shards that ``rows`` are written to."""
        folder = uuid.uuid4().hex
        rows.write.option("compression", "zstd").parquet(f"{self.root}/data/{folder}")
        return self._segment(folder, self._files(f"{self.root}/data/{folder}"))

    def append(self, rows: DataFrame) -> int:
        """Adds the rows as small shards; the new version."""
        return self._arrived(self._written(rows))

    def append_each(self, rows: DataFrame, arrival: Column) -> int:
        """Adds the rows of each value of ``arrival`` (a small number of them) as an arrival of its own; the last version.

        All are written in one pass; each is then committed. Rows without a value are an arrival, too.
        """
        (name,) = free_names(rows.columns, "_arrival")
        folder = uuid.uuid4().hex
        rows.withColumn(name, arrival).write.option("compression", "zstd").partitionBy(name).parquet(f"{self.root}/data/{folder}")
        arrivals: dict[str, list[Shard]] = {}
        for shard in self._files(f"{self.root}/data/{folder}"):
            arrivals.setdefault(shard.path.rpartition("/")[0].rpartition("/")[2], []).append(shard)
        if not arrivals:  # a table without rows leaves no file, and its schema is to be kept
            return self.append(rows)
        return [self._arrived(self._segment(f"{folder}/{value}", arrived)) for value, arrived in sorted(arrivals.items())][-1]

    def _arrived(self, arrived: Segment) -> int:
        while True:
            version, segments = self.segments()
            try:
                return self._commit(version, [*segments, arrived])
            except ManifestConflict:
                continue  # appends never clash with what others commit

    def plan(self, shards: list[Shard]) -> list[list[Shard]]:
        """The runs to merge: FAN shards or more of similar size. Those of over half the target stay."""
        runs: list[list[Shard]] = []
        for s in sorted(filter(self._small, shards), key=lambda s: (s.bytes, s.path)):
            if not runs or s.bytes > FAN * max(1, runs[-1][0].bytes):
                runs.append([])
            runs[-1].append(s)
        return [run for run in runs if len(run) >= FAN]

    def merge(self, run: list[Shard]) -> Segment:
        parts = max(1, round(sum(s.bytes for s in run) / self.target))
        return self._written(self._rows([s.path for s in run]).coalesce(parts))

    def _rows(self, paths: list[str]) -> DataFrame:
        # Names of folders aren't columns.
        return self.spark.read.option("recursiveFileLookup", "true").parquet(*paths)

    def compact(self) -> int:
        """Merges full tiers until none is left; the last version."""
        while True:
            version, segments = self.segments()
            looked = self._listed(g for g in segments if g.small)
            runs = self.plan([s for listed in looked.values() for s in listed])
            if not runs:
                return version
            gone = {s.path for run in runs for s in run}
            with ThreadPoolExecutor(MERGES) as pool:
                merged = list(pool.map(inheritable_thread_target(self.spark)(self.merge), runs))
            if sum(g.shards for g in merged) >= len(gone):
                return version  # nothing would be gained
            kept = [g for g in segments if g not in looked]
            for g, listed in looked.items():
                left = [s for s in listed if s.path not in gone]
                if len(left) == len(listed):
                    kept.append(g)
                elif left:
                    kept.append(self._segment(g.folder, left, whole=False))
            try:
                self._commit(version, kept + merged)
            except ManifestConflict:
                continue  # plan anew; what was merged is in no manifest

    def vacuum(self, keep_versions: int = 1) -> None:
        """Removes data files that the last ``keep_versions`` manifests don't list. No writer may be at work."""
        live = [g for v in self.versions()[-keep_versions:] for g in self.segments(v)[1]]
        whole, names = {g.folder for g in live if g.whole}, {g.name for g in live}
        paths = {s.path for listed in self._listed({g for g in live if g.folder not in whole}).values() for s in listed}
        for status in self._there(f"{self.root}/data"):
            top = status.getPath().getName()
            if top in whole:
                continue
            if not any(g.folder.partition("/")[0] == top for g in live):
                self._fs.delete(status.getPath(), True)
                continue
            for s in self._files(f"{self.root}/data/{top}"):
                within = f"{top}/{s.path.rpartition('/')[0].rpartition('/')[2]}"
                if within not in whole and s.path not in paths:
                    self._fs.delete(self._path(s.path), False)
        for status in self._there(f"{self.root}/segments"):
            if status.getPath().getName() not in names:
                self._fs.delete(status.getPath(), False)

    def _there(self, folder: str) -> list:
        return list(self._fs.listStatus(self._path(folder))) if self._fs.exists(self._path(folder)) else []

    def read(self, version: int | None = None, names: Sequence[str] = LOCATION) -> DataFrame:
        """The rows of a version with their shard, its bytes and the version, under ``names``."""
        version, segments = self.segments(version)
        if not segments:
            raise ValueError("the store is empty")
        parts = self._listed(g for g in segments if not g.whole)
        folders = [f"{self.root}/data/{g.folder}" for g in segments if g.whole]
        rows = self._rows(folders + [s.path for listed in parts.values() for s in listed])
        values = F.regexp_extract("_metadata.file_path", "/data/(.*)$", 1), F.col("_metadata.file_size"), F.lit(version)
        kept = [F.col(quoted(c)) for c in rows.columns if c not in names]
        return rows.select(*kept, *(v.alias(n) for n, v in zip(names, values, strict=True)))


def compacted(
    rows: DataFrame, root: str, target_bytes: int = TARGET_BYTES, arrival: Column | None = None, names: Sequence[str] = LOCATION
) -> DataFrame:
    """``rows`` appended to the store at ``root``, in arrivals if told by what, compacted, and read back with their shards."""
    store = ShardStore(rows.sparkSession, root, target_bytes)
    if arrival is None:
        store.append(rows)
    else:
        store.append_each(rows, arrival)
    version = store.compact()
    store.vacuum()
    return store.read(version, names)


def op9_shards_size_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    arrival = F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS))  # every row comes with one of them
    names = free_names(docs.columns, "shard", "shard_bytes", "manifest_version")
    rows = compacted(docs, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", arrival=arrival, names=names)
    shard, size, version = map(F.col, names)
    return rows.select(
        "doc_id", shard.alias("shard"), size.cast("bigint").alias("shard_bytes"), version.cast("bigint").alias("manifest_version")
    )
