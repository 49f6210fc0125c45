"""Parquet snapshots: a refresh writes a new folder, readers take the newest complete one.

``t_<entity>`` / ``mv<entity>`` of the reference become snapshot versions:
each refresh writes a NEW folder ``<root>/<entity>/v=<n>``. A folder counts
from the moment its job commits (Spark's ``_SUCCESS`` file), so there is no
pointer to swap: readers see the old version until then, and a failed job
leaves it intact. Two writers get two folders. File operations go through the
Hadoop FileSystem of the path, so the root can live on any shared storage.

Dated snapshots lie in month folders ``in_month=<yyyymm>``: a reader that names
its dates opens the files of their months only. The column is the layout's own;
readers don't get it.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeworks.session import ensure_checkpoint_dir, shuffles_freed

MONTH = "in_month"
_UNKNOWN = {"needs": {}, "inputs": None, "rows": None, "content": None}


def month_number(day: dt.date) -> int:
    return day.year * 100 + day.month


def _month_of(date: str) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("int")


def _place(path: str) -> str:
    """A file's place in an entity's folder: ``<version>/[<column>=<value>/...]<file>``."""
    return re.sub(r".*/v=(\d{6,}/)", r"\1", path)


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        if root is None:
            root = ensure_checkpoint_dir(spark).rstrip("/") + f"/lake-{uuid.uuid4().hex[:12]}"
        self.root = root.rstrip("/")
        self._notes: dict[tuple[str, int], dict] = {}
        self._frames: dict[str, tuple[int, DataFrame]] = {}
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- paths -------------------------------------------------------------
    def _dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _version_dir(self, name: str, version: int) -> str:
        return f"{self._dir(name)}/v={version:06d}"

    def complete(self, name: str, version: int) -> bool:
        return self._fs.exists(self._Path(f"{self._version_dir(name, version)}/_SUCCESS"))

    def current_version(self, name: str) -> int | None:
        return max((v for v in self.versions(name) if self.complete(name, v)), default=None)

    # -- notes: what a version was made from, as JSON beside its folder ---------
    def _note_path(self, name: str, version: int):
        return self._Path(f"{self._dir(name)}/_note-{version:06d}.json")

    def write_note(self, name: str, version: int, note: dict) -> None:
        out = self._fs.create(self._note_path(name, version), True)
        try:
            out.write(json.dumps(note).encode())
        finally:
            out.close()
        self._notes[name, version] = json.loads(json.dumps(note))

    def read_note(self, name: str, version: int) -> dict | None:
        if (name, version) not in self._notes:
            path = self._note_path(name, version)
            if not self._fs.exists(path):
                return None
            file = self._fs.open(path)
            try:
                text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
            finally:
                file.close()
            self._notes[name, version] = json.loads(text)  # a version never changes
        return self._notes[name, version]

    def content(self, name: str, version: int | None = None) -> str | None:
        """Checksum of a version's rows, None if it isn't known."""
        v = version if version is not None else self.current_version(name)
        note = self.read_note(name, v) if v is not None else None
        return note["content"] if note else None

    # -- API ---------------------------------------------------------------
    def versions(self, name: str) -> list[int]:
        d = self._Path(self._dir(name))
        if not self._fs.exists(d):
            return []
        out = []
        for st in self._fs.listStatus(d):
            n = st.getPath().getName()
            if n.startswith("v="):
                out.append(int(n[2:]))
        return sorted(out)

    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None, note: dict | None = None,
              dated: str | None = None, cluster: tuple = ()) -> int:
        """Write a new version, current once it is complete; returns the version.
        A ``note`` is there before the version counts. Rows lie in order of
        ``cluster`` inside each file.

        With ``dated`` (a date column) they lie in month folders. Rows of a month
        are brought together first, so a folder holds few files; a month far
        larger than the rest is dealt to several tasks (AQE's rebalance). Rows
        without a date have a folder of their own."""
        version = max(self.versions(name), default=0) + 1
        self._fs.mkdirs(self._Path(self._dir(name)))
        while not self._claim(name, version):
            version += 1
        folders = list(partition_by or ())
        if dated:
            folders = [MONTH, *folders]
            note = {**(note or _UNKNOWN), "dated": dated}
            df = df.withColumn(MONTH, _month_of(dated)).hint("rebalance", F.col(MONTH))
        if cluster:
            df = df.sortWithinPartitions(*folders, *cluster)
        if folders:                          # without rows there is no file to tell the columns
            note = {**(note or _UNKNOWN), "schema": df.schema.jsonValue()}
        if note is not None:
            self.write_note(name, version, note)
        w = df.write.mode("append").option("compression", "zstd")
        if folders:
            w = w.partitionBy(*folders)
        with shuffles_freed(self.spark):
            w.parquet(self._version_dir(name, version))
        return version

    def _claim(self, name: str, version: int) -> bool:
        """Creating the claim file fails for all writers but one."""
        try:
            self._fs.create(self._Path(f"{self._dir(name)}/_claim-{version:06d}"), False).close()
        except Exception:  # noqa: BLE001 - another writer has it
            return False
        return True

    def read(self, name: str, version: int | None = None, dates: tuple[dt.date, dt.date] | None = None) -> DataFrame:
        """A version's rows. ``dates`` (first and last day) keeps a dated snapshot
        to the folders of their months, which may hold days before and after."""
        df = self._read(name, version)
        if MONTH not in df.columns:
            return df
        if dates is not None:
            df = df.where(F.col(MONTH).between(*[month_number(d) for d in dates]))
        return df.drop(MONTH)

    def _read(self, name: str, version: int | None = None) -> DataFrame:
        """A version never changes, so its folders are listed once; of each entity
        the version read last is kept."""
        v = version if version is not None else self.current_version(name)
        kept = self._frames.get(name)
        if kept is None or kept[0] != v:
            kept = self._frames[name] = (v, reduce(DataFrame.unionByName, self._parts(name, v)))
        return kept[1]

    def _parts(self, name: str, v: int | None) -> list[DataFrame]:
        """A version's own rows, and those it takes from folders of other versions."""
        if v is None:
            raise KeyError(f"{name} has no snapshot")
        own, note = self._version_dir(name, v), self.read_note(name, v) or {}
        files, reader = note.get("files"), self.spark.read
        if note.get("schema"):
            reader = reader.schema(StructType.fromJson(note["schema"]))
        if not files:
            return [reader.parquet(own)]
        if not any("/" in _place(f).split("/", 1)[1] for f in files):
            return [reader.parquet(own, *files)]
        own_rows = reader.parquet(own)
        return [own_rows, *self._in_folders(files, own_rows.schema)]

    def _in_folders(self, files: list[str], schema: StructType) -> list[DataFrame]:
        """Files with the columns that their folders stand for, a frame for each version."""
        by_version: dict[str, list[str]] = {}
        for f in files:
            by_version.setdefault(f[:len(f) - len(_place(f).split("/", 1)[1])], []).append(f)
        return [self.spark.read.schema(schema).option("basePath", base).parquet(*group)
                for base, group in sorted(by_version.items())]

    def newest_month(self, name: str) -> tuple[dt.date, dt.date] | None:
        """First and last day of a dated snapshot's newest month; None if it isn't
        dated or has no dates. Read off the folders' names."""
        v = self.current_version(name)
        note = self.read_note(name, v) if v is not None else None
        if not note or not note.get("dated"):
            return None
        places = [st.getPath().getName() for st in self._fs.listStatus(self._Path(self._version_dir(name, v)))]
        found = re.findall(rf"\b{MONTH}=(\d+)", "\n".join(places + (note.get("files") or [])))
        if not found:
            return None
        year, month = divmod(max(map(int, found)), 100)
        return dt.date(year, month, 1), dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(1)

    # -- changes by predicate (S12, S13) ----------------------------------------
    def delete_where(self, name: str, predicate: Column) -> tuple[int, int]:
        """Delete the rows that ``predicate`` is true for; (version, files rewritten).
        Rows for which it is unknown stay."""
        return self._rewrite(name, predicate, lambda df: df.where(~F.coalesce(predicate, F.lit(False))))

    def update_where(self, name: str, predicate: Column, values: dict[str, Column]) -> tuple[int, int]:
        """Set columns of the rows that ``predicate`` is true for; (version, files rewritten)."""
        hit = F.coalesce(predicate, F.lit(False))

        def change(df: DataFrame) -> DataFrame:
            kinds = {f.name: f.dataType for f in df.schema}
            return df.select(*[F.when(hit, values[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
                               for c in df.columns])
        return self._rewrite(name, predicate, change)

    def _rewrite(self, name: str, predicate: Column, change) -> tuple[int, int]:
        """A new version in which only files that hold a match are written anew; the
        others are read where they are (files of a version are never changed). Files
        in folders go to the folders their rows belong to then."""
        v = self.current_version(name)
        parts = self._parts(name, v)
        files = {_place(f): f for p in parts for f in p.inputFiles()}
        found = reduce(DataFrame.union, [p.where(predicate).select("_metadata.file_path") for p in parts])
        touched = {_place(r[0]) for r in found.distinct().collect()}
        if not touched:
            return v, 0
        hit, rest = ([files[f] for f in sorted(files) if (f in touched) == t] for t in (True, False))
        old = reduce(DataFrame.unionByName, self._in_folders(hit, parts[0].schema))
        dated = (self.read_note(name, v) or {}).get("dated")
        folders = [x.split("=", 1)[0] for x in next(iter(files)).split("/")[1:-1]]
        if dated:
            old = old.drop(MONTH)
        new = change(old)
        return self.write(name, new, [c for c in folders if c != MONTH], {**_UNKNOWN, "files": rest}, dated), len(touched)

    def clone_shape(self, source: str, target: str) -> int:
        """An empty table of another one's columns."""
        return self.write(target, self.read(source).where(F.lit(False)))

    def history(self, name: str) -> DataFrame:
        """DESCRIBE HISTORY: one row per version with its row count."""
        rows = [(v, self.read(name, v).count()) for v in self.versions(name) if self.complete(name, v)]
        return self.spark.createDataFrame(rows, "version int, row_count long").withColumn(
            "is_current", F.col("version") == F.lit(self.current_version(name)))

    def log_refresh(self, name: str, mode: str, seconds: float, rows: int, version: int) -> None:
        """Append one line to the refresh log (R11m)."""
        df = self.spark.createDataFrame(
            [(name, mode, float(seconds), int(rows), int(version), time.time())],
            "entity string, strategy string, duration_seconds double, row_count long, version int, logged_at double")
        df.write.mode("append").parquet(f"{self.root}/_refresh_log")

    def refresh_log(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/_refresh_log")
