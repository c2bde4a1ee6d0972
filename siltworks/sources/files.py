"""Files of datasets and archives as tables; nothing is unpacked to disk."""

from __future__ import annotations

import io
import json
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators.exporting import EXAMPLE_SCHEMA


def _fs(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is directory) of a directory's entries; none if it is no directory."""
    fs, there = _fs(spark, path)
    if not fs.exists(there) or not fs.getFileStatus(there).isDirectory():
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(there))


def copy(spark: SparkSession, source: str, target: str) -> bool:
    """Copy a file or folder if it is there."""
    fs, there = _fs(spark, source)
    if not fs.exists(there):
        return False
    to_fs, to = _fs(spark, target)
    return spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, there, to_fs, to, False, spark.sparkContext._jsc.hadoopConfiguration())


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put source in the place of target."""
    remove(spark, target)
    fs, there = _fs(spark, source)
    if not fs.rename(there, _fs(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, there = _fs(spark, path)
    fs.delete(there, True)


def unpack(spark: SparkSession, package: str, name: str, target: str) -> bool:
    """Write one member of a package as a file, if it is there."""
    found = members(spark.read.format("binaryFile").load(package)).where(F.col("rel_path") == name).first()
    if found:
        with open(target, "wb") as f:
            f.write(found.content)
    return found is not None


def is_zip(path: str) -> bool:
    return path.lower().endswith(".zip")


def find_data_dir(spark: SparkSession, root: str) -> str:
    """``data`` under root, or root itself if an entry is named owner__repo; a package (.zip) is its own."""
    if is_zip(root):
        return root
    names = dict(entries(spark, root))
    if names.get("data"):
        return f"{root.rstrip('/')}/data"
    if any("__" in n for n in names):
        return root
    raise FileNotFoundError(f"{root} holds no data directory and no owner__repo entry")


def find_layout(spark: SparkSession, root: str) -> tuple[str, str | None, list[str]]:
    """(code directory, docs directory or None, repository directories): code/ and docs/, else data/, else root.

    In a package (.zip) the directories are <package>!<directory>.
    """
    if is_zip(root):
        tops = {r.top: r.repos for r in members(spark.read.format("binaryFile").load(root)).select(
            F.split("rel_path", "/")[0].alias("top"), F.get(F.split("rel_path", "/"), F.lit(1)).alias("second")
        ).groupBy("top").agg(F.array_sort(F.collect_set(F.when(F.col("second").contains("__"), F.col("second")))).alias("repos")).collect()}
        code = next((x for x in ("code", "data") if tops.get(x)), None)
        if code is None:
            raise FileNotFoundError(f"{root} holds no owner__repo directories")
        return f"{root}!{code}", f"{root}!docs" if code == "code" and "docs" in tops else None, list(tops[code])
    names, base = dict(entries(spark, root)), root.rstrip("/")
    code = f"{base}/code" if names.get("code") else f"{base}/data" if names.get("data") else root
    docs = f"{base}/docs" if names.get("code") and names.get("docs") else None
    repos = [n for n, is_dir in entries(spark, code) if is_dir and "__" in n]
    if not repos:
        raise FileNotFoundError(f"{root} holds no owner__repo directories")
    return code, docs, repos


def tree(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """Files below root: full_name, rel_path (from root, with the repository's directory), size_bytes and content.

    Without content only directory metadata is read, and conditions on size_bytes reach the scan.  root may be a package
    (.zip, or <package>!<directory>), read without unpacking it to disk.
    """
    package, _, part = root.partition("!")
    if is_zip(package):
        own = members(spark.read.format("binaryFile").load(package))
        for top in [part] if part else ["data"]:
            own = own.where(F.col("rel_path").startswith(f"{top}/")).withColumn("rel_path", F.substring("rel_path", len(top) + 2, 1 << 30))
        own = own.select("rel_path", "size_bytes", *(["content"] if content else []))
        return own.withColumn("full_name", paths.decode_repo(F.split("rel_path", "/")[0]))
    base = _fs(spark, root)[0].makeQualified(_fs(spark, root)[1]).toUri().getPath().rstrip("/")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    where = F.regexp_replace("path", r"^[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?", "")
    rel = F.url_decode(F.replace(F.substring(where, len(base) + 2, 1 << 30), F.lit("+"), F.lit("%2B")))
    df = df.select(rel.alias("rel_path"), F.col("length").alias("size_bytes"), *(["content"] if content else []))
    return df.withColumn("full_name", paths.decode_repo(F.split("rel_path", "/")[0]))


def with_text(files: DataFrame) -> DataFrame:
    return files.withColumn("text", F.decode("content", "UTF-8"))


ARCHIVE = "archive string, rel_path string, size_bytes long, content binary"


def members(packed: DataFrame, strip: int = 1) -> DataFrame:
    """Regular files inside .tar.gz, .tgz and .zip archives (path, content), a row at a time.

    Tar entries lose their first ``strip`` path parts.  Entries that lead outside the archive are left out.
    """

    def entries_of(name: str, data: bytes) -> Iterator[tuple[str, bytes]]:
        if name.lower().endswith(".zip"):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                for i in z.infolist():
                    if not i.is_dir():
                        yield i.filename, z.read(i)
        else:
            with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as t:
                for m in t:
                    rest = m.name.split("/")[strip:]
                    if m.isfile() and rest:
                        yield "/".join(rest), t.extractfile(m).read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                for rel, content in entries_of(name, data.as_py()):
                    if posixpath.isabs(rel) or ".." in rel.split("/"):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([rel]), pa.array([len(content)], pa.int64()), pa.array([content], pa.binary())], names=["archive", "rel_path", "size_bytes", "content"]
                    )

    return packed.select("path", "content").mapInArrow(run, ARCHIVE)


def archives(spark: SparkSession, path: str, strip: int = 1) -> DataFrame:
    """The files inside the archives that a path or glob names."""
    return members(spark.read.format("binaryFile").load(path), strip)


def read_json_file(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A JSON side file of one value, or None if it is missing or bad.  <package>!<name> is a member of a package."""
    package, _, name = path.partition("!")
    if is_zip(package):
        found = members(spark.read.format("binaryFile").load(package)).where(F.col("rel_path") == name).first()
        try:
            value = json.loads(found.content) if found else None
        except ValueError:
            return None
        rows = value if isinstance(value, list) else [value] if isinstance(value, dict) else []
        return spark.createDataFrame([Row(**r) for r in _squared(rows)], schema) if rows else None
    fs, there = _fs(spark, path)
    if not fs.exists(there):
        return None
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    try:
        df = (reader.schema(schema) if schema else reader).json(path)
        df.limit(1).collect()
        return df
    except PySparkException:
        return None


def _squared(rows: list[dict]) -> list[dict]:
    """Rows with the keys of all."""
    keys = dict.fromkeys(k for r in rows for k in r)
    return [{k: r.get(k) for k in keys} for r in rows]


def parse_examples(lines: DataFrame) -> DataFrame:
    """Rows of JSON text lines (column value); blank lines and bad JSON are left out."""
    one = F.from_json("value", EXAMPLE_SCHEMA + ", _bad string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    return lines.where(F.trim("value") != "").select(one.alias("x")).where("x is not null and x._bad is null").select("x.*").drop("_bad")


def read_examples(spark: SparkSession, directory: str) -> DataFrame:
    """training.jsonl of a directory, else examples.jsonl."""
    names = dict(entries(spark, directory))
    name = next((n for n in ("training.jsonl", "examples.jsonl") if n in names), None)
    if name is None:
        raise FileNotFoundError(f"{directory} holds neither training.jsonl nor examples.jsonl")
    return parse_examples(spark.read.text(f"{directory.rstrip('/')}/{name}"))
