"""Sources and sinks of Spark's Python data source API: a listing of pictures, and artifacts whose writes are whole or nothing.

register(spark) makes them known as format("figures") and format("artifacts"). Addresses are those that pyarrow opens: local
folders as seen by all executors, and remote stores with a client there.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


@dataclass
class Folders(InputPartition):
    """Folders that one task lists."""

    names: list[str]


class FigureReader(DataSourceReader):
    """Lists the pictures of one folder a study, some folders a task. A filter on the study is pushed to the folders, so that the
    others are not listed."""

    def __init__(self, options: dict):
        self.path, self.tasks, self.wanted = options["path"].rstrip("/"), int(options.get("tasks", 16)), None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("study_id",):
                self.wanted = {f.value} if self.wanted is None else self.wanted & {f.value}
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        at, root = _open(self.path)
        found = at.get_file_info(fs.FileSelector(root, allow_not_found=True))
        names = sorted(f.base_name for f in found if f.type == fs.FileType.Directory and (self.wanted is None or f.base_name in self.wanted))
        n = max(1, min(self.tasks, len(names)))
        return [Folders(names[i::n]) for i in range(n)]

    def read(self, partition: Folders) -> Iterator[tuple]:
        at, root = _open(self.path)
        for name in partition.names:
            for f in at.get_file_info(fs.FileSelector(f"{root}/{name}", recursive=True)):
                if f.type == fs.FileType.File:
                    figure, dot, suffix = f.base_name.rpartition(".")
                    yield name, figure if dot else f.base_name, dot + suffix if dot else "", f"{self.path}/{name}/{f.path.removeprefix(f'{root}/{name}/')}", f.size, f.mtime.astimezone(dt.UTC)


class Figures(DataSource):
    """study_id, figure_id, suffix, path, bytes, modified of the files of a folder with a folder a study. Options: path, tasks."""

    @classmethod
    def name(cls) -> str:
        return "figures"

    def schema(self) -> str:
        return "study_id string, figure_id string, suffix string, path string, bytes long, modified timestamp"

    def reader(self, schema: StructType) -> FigureReader:
        return FigureReader(self.options)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: its file's name in the staging folder, and how many rows it holds by step."""

    file: str | None
    rows: dict[str, int]


ARTIFACTS = "paper_id string, step string, value string"
_STAGING, _MANIFESTS, _FILES = "_staging", "_manifests", "files"


class ArtifactWriter(DataSourceWriter):
    """Each task writes one file into the write's own staging folder. commit() moves the files to their place and then writes the
    manifest, which is what readers go by; abort() removes the staging folder. Files of tasks that were tried again and lost are
    in no message, and go with the staging folder."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.id, self.overwrite = options["path"].rstrip("/"), uuid.uuid4().hex, overwrite

    def write(self, iterator) -> Written:
        at, root = _open(self.path)
        counts: dict[str, int] = {}
        file, out = f"{uuid.uuid4().hex}.jsonl", None
        try:
            for row in iterator:
                if out is None:
                    at.create_dir(f"{root}/{_STAGING}/{self.id}", recursive=True)
                    out = at.open_output_stream(f"{root}/{_STAGING}/{self.id}/{file}")
                if row.paper_id is None or row.step is None:
                    raise ValueError("an artifact needs a paper_id and a step")
                out.write((json.dumps(row.asDict(), ensure_ascii=False) + "\n").encode())
                counts[row.step] = counts.get(row.step, 0) + 1
        finally:
            if out is not None:
                out.close()
        return Written(file if out else None, counts)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        at, root = _open(self.path)
        files = sorted(m.file for m in messages if m and m.file)
        totals: dict[str, int] = {}
        for m in messages:
            for step, n in m.rows.items() if m else ():
                totals[step] = totals.get(step, 0) + n
        for folder in (_FILES, _MANIFESTS):
            at.create_dir(f"{root}/{folder}", recursive=True)
        for file in files:
            at.move(f"{root}/{_STAGING}/{self.id}/{file}", f"{root}/{_FILES}/{file}")
        before = _manifests(at, root)
        number = max((n for n, _ in before), default=0) + 1
        body = {"files": files, "rows": totals, "replaces": number - 1 if self.overwrite else 0}
        with at.open_output_stream(f"{root}/{_MANIFESTS}/{self.id}.tmp") as out:
            out.write(json.dumps(body).encode())
        at.move(f"{root}/{_MANIFESTS}/{self.id}.tmp", f"{root}/{_MANIFESTS}/{number:012d}.json")
        self._clear(at, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*_open(self.path))

    def _clear(self, at: fs.FileSystem, root: str) -> None:
        if at.get_file_info(f"{root}/{_STAGING}/{self.id}").type == fs.FileType.Directory:
            at.delete_dir(f"{root}/{_STAGING}/{self.id}")


def _manifests(at: fs.FileSystem, root: str) -> list[tuple[int, dict]]:
    found = []
    for f in at.get_file_info(fs.FileSelector(f"{root}/{_MANIFESTS}", allow_not_found=True)):
        if f.extension == "json":
            with at.open_input_stream(f.path) as body:
                found.append((int(f.base_name.removesuffix(".json")), json.loads(body.readall())))
    return sorted(found, key=lambda x: x[0])


class ArtifactReader(DataSourceReader):
    """Reads the files of the manifests that no later one replaces, one task a file."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[InputPartition]:
        at, root = _open(self.path)
        manifests = _manifests(at, root)
        gone = max((body["replaces"] for _, body in manifests), default=0)
        files = [f for n, body in manifests if n > gone for f in body["files"]]
        return [Folders([f]) for f in files] or [Folders([])]

    def read(self, partition: Folders) -> Iterator[tuple]:
        at, root = _open(self.path)
        for file in partition.names:
            with at.open_input_stream(f"{root}/{_FILES}/{file}") as body:
                rest = b""
                while block := body.read(1 << 20):
                    *lines, rest = (rest + block).split(b"\n")
                    for line in lines:
                        row = json.loads(line)
                        yield row["paper_id"], row["step"], row["value"]


class Artifacts(DataSource):
    """paper_id, step, value (JSON texts), appended or, in mode overwrite, in place of all before. A write that fails, or whose
    driver ends, leaves nothing that is read. Option: path."""

    @classmethod
    def name(cls) -> str:
        return "artifacts"

    def schema(self) -> str:
        return ARTIFACTS

    def reader(self, schema: StructType) -> ArtifactReader:
        return ArtifactReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> ArtifactWriter:
        return ArtifactWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the sources known, and lets filters reach them: a source that takes filters can't be read otherwise."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (Figures, Artifacts):
        spark.dataSource.register(source)
