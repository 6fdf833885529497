"""Sources and sinks (operators A1, A3-A6, A8).

* A1 ``scan_tree``: a recursive file listing, one task per folder below the
  root; no file body is read.
* A3 ``snapshot_groups``: one compressed, never-overwritten layout per group
  (``partitionBy`` on an escaped folder name + ``errorifexists``).
* A4 ``archive_shards``: tar / zip shards written by a Python Data Source; each
  task streams its rows into one archive per group it sees.  A task writes
  under an attempt-private name and only committed attempts are renamed into
  place, so a retried task never leaves a partial shard behind.
* A5 ``publish``: successful rows to a store layout partitioned by group.
* A6 ``write_report``: report lines in order, appended as text.
* A8 ``fan_out``: one result, computed once, handed to several sinks.

Destinations must be shared storage on a cluster (the folder named by
``spark.checkpoint.dir`` or an object store URI), never a machine-local path.
"""

from __future__ import annotations

import io
import json
import os
import tarfile
import uuid
import zipfile
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

# --- A1 ----------------------------------------------------------------------------------------

class TreeReader(DataSourceReader):
    """Lists a folder: one partition for the files directly in it and one for each folder right below."""

    def __init__(self, options: dict):
        self.fs, self.base = fs.FileSystem.from_uri(options["path"])

    def partitions(self):
        top = self.fs.get_file_info(fs.FileSelector(self.base))
        return [InputPartition(None)] + [InputPartition(i.path) for i in top if i.type == fs.FileType.Directory]

    def read(self, partition):
        below = partition.value
        for i in self.fs.get_file_info(fs.FileSelector(below or self.base, recursive=below is not None)):
            if i.type == fs.FileType.File:
                yield i.path, i.path[len(self.base.rstrip("/")) + 1:], i.size, i.mtime.replace(tzinfo=None)


class TreeSource(DataSource):
    """``spark.read.format("opslog_tree")``: files below a URI that the store's file system lists, hidden ones too."""

    @classmethod
    def name(cls):
        return "opslog_tree"

    def schema(self):
        return "path string, rel_path string, length bigint, mtime timestamp_ntz"

    def reader(self, schema):
        return TreeReader(self.options)


def scan_tree(spark: SparkSession, root: str) -> DataFrame:
    """A1: every file below ``root`` (a path or URI) with its path relative to ``root``, size and time (UTC).

    Spark's own readers hide names that start with a dot or an underscore, so the listing has a source of its own.
    """
    spark.dataSource.register(TreeSource)
    uri = root if "://" in root else "file://" + quote(root[len("file:"):] if root.startswith("file:") else os.path.abspath(root))
    return spark.read.format("opslog_tree").load(uri)


# --- A3 ----------------------------------------------------------------------------------------

# Archive codec names -> Spark text/json codec names.
TEXT_CODECS = {None: "none", "gz": "gzip", "bz2": "bzip2", "deflate": "deflate", "lz4": "lz4", "snappy": "snappy"}


def _folder(group: Column) -> Column:
    """A folder name that keeps every group value apart: null, the empty text and texts that look like numbers."""
    return F.coalesce(F.concat(F.lit("v_"), F.url_encode(group.cast("string"))), F.lit("null"))


def write_groups(df: DataFrame, group_col: str, dest: str, fmt: str, options: dict) -> DataFrame:
    """Write each group below ``dest/<group_col>_folder=<name>/``; refuse to overwrite. Returns the rows as stored.

    Stored rows are read with the schema they had, the group value restored from
    the folder's name, next to the file that holds them (``_file``, ``_file_bytes``).
    """
    part = f"{group_col}_folder"
    data = df.drop(group_col)
    (df.withColumn(part, _folder(F.col(group_col))).drop(group_col)
     .write.mode("errorifexists").partitionBy(part).format(fmt).options(**options).save(dest))
    schema = T.StructType([*data.schema.fields, T.StructField(part, T.StringType())])
    back = df.sparkSession.read.format(fmt).schema(schema).load(dest)
    value = F.url_decode(F.substring(part, 3, 1 << 30)).cast(df.schema[group_col].dataType)
    return back.select(*data.columns, F.when(F.col(part) != "null", value).alias(group_col),
                       F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_file_bytes"))


def group_manifest(stored: DataFrame, group_col: str) -> DataFrame:
    """Per group: rows, files and their bytes on disk, and the status that the read-back proves."""
    files = stored.groupBy(group_col, "_file", "_file_bytes").agg(F.count("*").alias("_n"))
    return files.groupBy(group_col).agg(F.sum("_n").alias("rows"), F.count("*").alias("files"),
                                        F.sum("_file_bytes").alias("bytes"), F.lit("success").alias("status"))


def snapshot_groups(df: DataFrame, group_col: str, dest: str, fmt: str = "json", codec: str | None = "gz") -> DataFrame:
    """A3: write each group to a folder of its own, compressed; refuse to overwrite.

    Returns the manifest read back from what was written: rows, files, bytes and status of each group.
    """
    if fmt in ("json", "csv", "text") and codec not in TEXT_CODECS:
        raise ValueError(f"codec {codec!r} is not available for {fmt} output")
    spark_codec = TEXT_CODECS.get(codec, codec) if fmt in ("json", "csv", "text") else (codec or "none")
    return group_manifest(write_groups(df, group_col, dest, fmt, {"compression": spark_codec}), group_col)


# --- A4 ----------------------------------------------------------------------------------------

# Codec names of archives -> zip methods (tar takes the names as they are).
SHARD_CODECS = {None: zipfile.ZIP_STORED, "gz": zipfile.ZIP_DEFLATED, "bz2": zipfile.ZIP_BZIP2, "xz": zipfile.ZIP_LZMA}


@dataclass
class ShardCommit(WriterCommitMessage):
    shards: list  # [(temp path, final path, files, bytes)]


class ShardWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.dest = options["path"]
        self.kind = options.get("kind", "tar")
        self.codec = options.get("codec") or None
        self.name_col = options.get("name_col", "name")
        self.data_col = options.get("data_col", "data")
        self.group_col = options.get("group_col") or None
        if self.kind not in ("tar", "zip"):
            raise ValueError(f"unknown archive kind {self.kind!r}")
        if self.codec not in SHARD_CODECS:
            raise ValueError(f"codec must be one of {list(SHARD_CODECS)}")
        self.write_id = uuid.uuid4().hex[:12]  # shards of an earlier write to the same folder stay

    def _ext(self) -> str:
        if self.kind == "zip":
            return "zip"
        return "tar" if self.codec is None else f"tar.{self.codec}"

    def _open(self, path):
        if self.kind == "tar":
            return tarfile.open(path, "w" if self.codec is None else f"w:{self.codec}")
        return zipfile.ZipFile(path, "w", compression=SHARD_CODECS[self.codec])

    def _add(self, arc, name: str, data: bytes):
        if self.kind == "tar":
            info = tarfile.TarInfo(name)
            info.size = len(data)
            arc.addfile(info, io.BytesIO(data))
        else:
            arc.writestr(name, data)

    def write(self, iterator):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.taskAttemptId()
        open_arcs: dict = {}
        stats: dict = {}
        try:
            for row in iterator:
                group = str(row[self.group_col]) if self.group_col else "all"
                if group not in open_arcs:
                    gdir = os.path.join(self.dest, f"{self.group_col}={group}" if self.group_col else "")
                    os.makedirs(gdir, exist_ok=True)
                    final = os.path.join(gdir, f"part-{self.write_id}-{pid:05d}.{self._ext()}")
                    tmp = os.path.join(gdir, f".part-{self.write_id}-{pid:05d}-{attempt}.tmp")
                    open_arcs[group] = self._open(tmp)
                    stats[group] = [tmp, final, 0, 0]
                data = row[self.data_col]
                data = data.encode("utf-8") if isinstance(data, str) else bytes(data or b"")
                self._add(open_arcs[group], str(row[self.name_col]), data)
                stats[group][2] += 1
                stats[group][3] += len(data)
        except BaseException:
            for g, arc in open_arcs.items():
                arc.close()
                os.remove(stats[g][0])
            raise
        for arc in open_arcs.values():
            arc.close()
        return ShardCommit([tuple(v) + (g,) for g, v in stats.items()])

    def commit(self, messages):
        manifest = []
        for m in messages:
            for tmp, final, files, nbytes, group in m.shards:
                os.replace(tmp, final)
                manifest.append({"group": group, "shard": final, "files": files, "bytes": nbytes})
        os.makedirs(self.dest, exist_ok=True)
        with open(os.path.join(self.dest, "manifest.jsonl"), "a", encoding="utf-8") as fh:
            for rec in manifest:
                fh.write(json.dumps(rec) + "\n")

    def abort(self, messages):
        for m in messages:
            if m is None:
                continue
            for tmp, *_ in m.shards:
                if os.path.exists(tmp):
                    os.remove(tmp)


class ShardSource(DataSource):
    """``df.write.format("opslog_shards")``: tar or zip shards, one per partition and group."""

    @classmethod
    def name(cls):
        return "opslog_shards"

    def writer(self, schema, overwrite):
        return ShardWriter(self.options)


def archive_shards(df: DataFrame, name_col: str, data_col: str, dest: str, kind: str = "tar",
                   codec: str | None = "gz", group_col: str | None = None) -> DataFrame:
    """A4: pack rows into archive shards in parallel; returns the shard manifest."""
    spark = df.sparkSession
    spark.dataSource.register(ShardSource)
    data = df
    if group_col:
        # rows of a group together, a hot group split by its size into several tasks (one shard each)
        data = df.hint("rebalance", group_col)
    w = (data.write.format("opslog_shards").mode("append").option("path", dest).option("kind", kind)
         .option("name_col", name_col).option("data_col", data_col))
    if codec:
        w = w.option("codec", codec)
    if group_col:
        w = w.option("group_col", group_col)
    w.save()
    return spark.read.schema("group string, shard string, files bigint, bytes bigint").json(
        os.path.join(dest, "manifest.jsonl"))


# --- A5 ----------------------------------------------------------------------------------------

def publish(df_ok: DataFrame, dest: str, group_col: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """A5: copy successful rows to the store, one folder per group; returns the uploaded rows with their file."""
    return write_groups(df_ok, group_col, dest, fmt, options or {})


# --- A6 / A8 -----------------------------------------------------------------------------------

def write_report(lines: DataFrame, dest: str) -> None:
    """Append the report's lines, in ``(section_no, line_no)`` order, as text.

    Lines are range-partitioned by their place, so a long report becomes several
    part files whose names sort in report order.
    """
    (lines.repartitionByRange("section_no", "line_no").sortWithinPartitions("section_no", "line_no").select("text")
     .write.mode("append").text(dest))


def fan_out(df: DataFrame, sinks: list) -> None:
    """Compute once, write to every sink in order (the result is persisted between them)."""
    cached = df.persist()
    try:
        for sink in sinks:
            sink(cached)
    finally:
        cached.unpersist()
