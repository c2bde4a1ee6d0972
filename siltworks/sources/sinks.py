"""Where results go: JSON lines, file trees, packages, side files."""

from __future__ import annotations

import json
import os
import shutil
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import paths


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, null keys left out; what was there is replaced."""
    df.write.mode("overwrite").json(path)


def write_dataset(files: DataFrame, path: str) -> None:
    """The dataset as one Parquet table, written where the rows are: no repository is gathered in one task."""
    files.write.mode("overwrite").parquet(path)


def write_split(outcomes: DataFrame, path: str) -> None:
    """What a filter run keeps, one folder for each of data, or code and docs."""
    outcomes.where(F.col("outcome").isin("data", "code", "docs")).write.mode("overwrite").partitionBy("outcome").parquet(path)


def write_tree(files: DataFrame, root: str) -> None:
    """files (full_name, rel_path, content or text) under root/owner__repo/, written by the tasks.

    root must be a folder that all executors share; what it held before is removed.  A path that leads outside is an
    error.  An empty table leaves an empty folder.
    """
    shutil.rmtree(root, ignore_errors=True)
    os.makedirs(root)
    body = F.col("content") if "content" in files.columns else F.col("text").cast("binary")

    def put(rows) -> None:
        top = os.path.realpath(root)
        for r in rows:
            there = os.path.realpath(f"{top}/{r['repo']}/{r['rel_path']}")
            if not there.startswith(top + os.sep):
                raise ValueError(f"{r['rel_path']} leads outside {root}")
            os.makedirs(os.path.dirname(there), exist_ok=True)
            part = f"{there}.{uuid.uuid4().hex}.part"
            with open(part, "wb") as f:
                f.write(r["body"])
            os.replace(part, there)

    files.select(paths.encode_repo(F.col("full_name")).alias("repo"), "rel_path", body.alias("body")).foreachPartition(put)


def manifest_rows(manifest: DataFrame) -> list[dict]:
    """The manifest in the repositories' order, without null keys: one row a repository, so small by nature."""
    rows = manifest.orderBy("src_rank", "src_pos", "full_name").drop("src_rank", "src_pos").toLocalIterator()
    return [{k: v for k, v in r.asDict().items() if v is not None} for r in rows]


def write_json(value: object, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, ensure_ascii=False), encoding="utf-8")


def build_zip(folder: str, target: str, level: int = 6) -> str:
    """All files of a finished output folder but its inner tables (names with _ or . first), in sorted order, deflated.

    A JSON lines folder becomes one member, its parts one after another.
    """
    inner = lambda p: any(x[:1] in ("_", ".") for x in p.relative_to(folder).parts[:1])
    lines = sorted(p for p in Path(folder).glob("*.jsonl") if p.is_dir())
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as z:
        for p in sorted(Path(folder).rglob("*")):
            if p.is_file() and not inner(p) and p.resolve() != Path(target).resolve() and not any(x in p.parents for x in lines):
                z.write(p, p.relative_to(folder).as_posix())
        for x in lines:
            with z.open(x.name, "w") as out:
                for p in sorted(x.glob("part-*")):
                    with open(p, "rb") as f:
                        shutil.copyfileobj(f, out)
    return target
