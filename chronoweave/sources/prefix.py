"""Listing and copying of file trees by prefix: one partition a page of names, copies with a manifest that a later run resumes."""

from __future__ import annotations

import fnmatch
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship_package

LISTING = "path string, name string, group string, size long, modified timestamp, page int"
MANIFEST = "path string, target string, size long, modified timestamp, sha256 string, status string, error string, run_id string"
#: Bytes that a copy holds at once.
PIECE = 8 << 20


class Page(InputPartition):
    """Some first-level names under the prefix."""

    def __init__(self, number: int, names: list[str]) -> None:
        self.number, self.names = number, names


class PrefixReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root = options["path"].rstrip("/")
        self.size, self.pattern = int(options.get("pagesize", 100)), options.get("pattern", "*")

    def partitions(self) -> list[Page]:
        """Pages of the first level only; what lies below is listed by the tasks."""
        store, top = fs.FileSystem.from_uri(self.root)
        names = sorted(x.base_name for x in store.get_file_info(fs.FileSelector(top, allow_not_found=True)))
        return [Page(k, names[at : at + self.size]) for k, at in enumerate(range(0, len(names), self.size))]

    def read(self, partition: Page | None) -> Iterator[tuple]:
        if partition is None:
            return  # no page: nothing under the prefix
        store, top = fs.FileSystem.from_uri(self.root)
        for name in partition.names:
            first = store.get_file_info(f"{top}/{name}")
            every = [first] if first.is_file else store.get_file_info(fs.FileSelector(first.path, recursive=True, allow_not_found=True))
            for x in every:
                rest = x.path[len(top) :].lstrip("/")
                if x.is_file and fnmatch.fnmatch(x.base_name, self.pattern):
                    yield (f"{self.root}/{rest}", x.base_name, name if "/" in rest else "", x.size, x.mtime, partition.number)


class PrefixSource(DataSource):
    """``spark.read.format("prefix")``: all files under ``path`` (any store that Arrow opens by URI), with the first folder of
    each as ``group``. Options: ``pageSize`` first-level names a partition, ``pattern`` of file names. A file that goes while
    it is listed is not an error; a missing prefix has no files."""

    @classmethod
    def name(cls) -> str:
        return "prefix"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> PrefixReader:
        return PrefixReader(self.options)


def list_prefix(spark: SparkSession, path: str, page_size: int = 100, pattern: str = "*") -> DataFrame:
    ship_package(spark)
    spark.dataSource.register(PrefixSource)
    return spark.read.format("prefix").options(path=path, pageSize=page_size, pattern=pattern).load()


def browse(files: DataFrame) -> DataFrame:
    """group, n_files, bytes, newest: one row for each first-level folder."""
    return files.groupBy("group").agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.max("modified").alias("newest"))


def _copy(source: str, target: str, run_id: str) -> tuple[int, str]:
    """Copies one file under a name of its own and moves it into place; (bytes, sha256)."""
    (a, src), (b, dst) = fs.FileSystem.from_uri(source), fs.FileSystem.from_uri(target)
    b.create_dir(dst.rsplit("/", 1)[0], recursive=True)
    part, sha, size = f"{dst}.{run_id}.part", hashlib.sha256(), 0
    with a.open_input_stream(src) as read, b.open_output_stream(part) as write:
        while piece := read.read(PIECE):
            sha.update(piece)
            write.write(piece)
            size += len(piece)
    if size != b.get_file_info(part).size:
        raise OSError(f"{size} bytes read, {b.get_file_info(part).size} written")
    b.move(part, dst)
    return size, sha.hexdigest()


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The last word on each target: done if any run copied this version of the file."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(manifest)
    except AnalysisException:
        rows = spark.createDataFrame([], MANIFEST)
    best = F.max_by(F.struct("size", "sha256", "status", "error", "run_id"), F.struct(F.col("status") == "done", "run_id"))
    return rows.groupBy("path", "target", "modified").agg(best.alias("s")).select("path", "target", "modified", "s.*")


def export_files(files: DataFrame, root: str, target: str, manifest: str, tasks: int | None = None) -> DataFrame:
    """Copies the listed ``files`` (path, size, modified) from below ``root`` to the same places below ``target``.

    Every task copies files of its own, largest first over the tasks; a row of ``manifest`` tells of each copy (bytes, SHA-256,
    status, error). Files that the manifest has as done, in this version, are left out, so a run that failed or was killed
    half way is resumed by calling again; a killed copy leaves a ``.part`` file only. Returns this run's rows. A file that
    cannot be read is a row with status ``failed`` and does not stop the others. No files copy nothing.
    """
    spark, run_id = files.sparkSession, uuid.uuid4().hex
    ship_package(spark)
    root, target = root.rstrip("/"), target.rstrip("/")
    todo = files.select("path", "size", "modified", F.concat(F.lit(f"{target}/"), F.substring("path", len(root) + 2, 2147483647)).alias("target")).distinct()
    done = read_manifest(spark, manifest).where("status = 'done'").select("path", "target", "modified")
    todo = todo.join(done, ["path", "target", "modified"], "left_anti")
    todo = todo.orderBy(F.desc("size"), "path").repartition(tasks) if tasks else todo.repartition(F.xxhash64("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                try:
                    size, sha = _copy(row["path"], row["target"], run_id)
                    got = (size, sha, "done", None)
                except OSError as e:
                    got = (row["size"], None, "failed", str(e)[:500])
                yield pa.RecordBatch.from_pylist([{"path": row["path"], "target": row["target"], "size": got[0], "modified": row["modified"], "sha256": got[1], "status": got[2], "error": got[3], "run_id": run_id}], schema=_SCHEMA)

    todo.mapInArrow(run, MANIFEST).write.mode("append").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest).where(F.col("run_id") == run_id)


_SCHEMA = pa.schema([("path", pa.string()), ("target", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", "UTC")), ("sha256", pa.string()), ("status", pa.string()), ("error", pa.string()), ("run_id", pa.string())])


def verify_export(files: DataFrame, manifest: str) -> DataFrame:
    """path, target, ok: every manifest copy read again and compared with its SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                sha = hashlib.sha256()
                try:
                    store, path = fs.FileSystem.from_uri(row["target"])
                    with store.open_input_stream(path) as f:
                        while piece := f.read(PIECE):
                            sha.update(piece)
                    ok = sha.hexdigest() == row["sha256"]
                except OSError:
                    ok = False
                yield pa.RecordBatch.from_pylist([{"path": row["path"], "target": row["target"], "ok": ok}])

    rows = read_manifest(files.sparkSession, manifest).where("status = 'done'").join(files.select("path", "modified"), ["path", "modified"], "left_semi")
    return rows.select("path", "target", "sha256").mapInArrow(run, "path string, target string, ok boolean")
