"""Page, payload and rendered files as a data source: ``spark.read.format("page_files").load(path)``.

A row is a file: kind (page, payload or rendered), stage, product_idx (from 0), page_no, size, body. All but
the body is told by the file's name, so filters on kind, stage, product_idx and page_no choose files and folders
before any is opened. The planner packs the chosen files, in order of their names, into tasks of about
``partitionBytes`` (a small file counts as ``openCost`` bytes), so many small files are few tasks.

The writer takes rows with stage, product_idx, page_no and body, and kind if not all are pages. Files lie in a
folder for each 1,000 products. A task writes into a staging folder of its own; when all tasks are done
the files are moved to their places, so a failed or repeated task leaves nothing behind. A file that is there
already is replaced. What a task reports is its folders, not its files; a folder that is new at its place moves
as one, so :func:`write_files` deals the rows by folder.

Where there are many folders, tasks are given folders, which they list themselves: neither the planner nor the
driver then sees the files.

``path`` is on any file system that Arrow knows, mounted folders included; every machine has to reach it.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

# Names of stored page files; the numbers count from 1.
SNAPSHOT_FILE = r"product_snapshot_(\d+)\.html"
PAGE_FILE = r"review_page_(\d+)_(\d+)\.html"
PAYLOAD_FILE = r"review_page_(\d+)_(\d+)_browser_payload\.json"
RENDERED_FILE = r"review_page_(\d+)_(\d+)_browser_rendered_html\.html"

FORMAT = "page_files"
SCHEMA = "kind string, stage string, product_idx int, page_no int, size long, body string"
FOLDER_PRODUCTS = 1000
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096
PLANNED_FOLDERS = 32  # more of them are listed by the tasks that read them
FOLDER_TASKS = 1024  # at most, when folders are dealt to tasks
MOVERS = 16
_FOLDER = re.compile(r"products_(\d+)$")
_STAGING = "_staging"
# earlier writers made a folder per file, with a text file in it that ends in a line feed of its own
_FILE_FOLDER = "page_file="
# a payload's and a rendered page's name begins like a page's, so these come first
_NAMES = (
    ("payload", "review_harvest", re.compile(PAYLOAD_FILE + "$")), ("rendered", "review_harvest", re.compile(RENDERED_FILE + "$")),
    ("page", "review_harvest", re.compile(PAGE_FILE + "$")), ("page", "product_snapshot", re.compile(SNAPSHOT_FILE + "$")),
)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path in it."""
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def facts_of(name: str) -> dict | None:
    """What a file name tells; None for files of other kinds."""
    for kind, stage, pattern in _NAMES:
        found = pattern.search(name)
        if found:
            numbers = [int(n) for n in found.groups()]
            return {"kind": kind, "stage": stage, "product_idx": numbers[0] - 1, "page_no": numbers[1] if len(numbers) > 1 else 1}
    return None


def name_of(kind: str, stage: str, product_idx: int, page_no: int) -> str:
    if stage == "product_snapshot":
        return f"product_snapshot_{product_idx + 1:03d}.html"
    tail = {"page": ".html", "payload": "_browser_payload.json", "rendered": "_browser_rendered_html.html"}[kind]
    return f"review_page_{product_idx + 1:03d}_{page_no:03d}{tail}"


_TESTS = {
    ds.EqualTo: lambda have, value: have == value, ds.EqualNullSafe: lambda have, value: have == value, ds.In: lambda have, value: have in value,
    ds.GreaterThan: lambda have, value: have > value, ds.GreaterThanOrEqual: lambda have, value: have >= value,
    ds.LessThan: lambda have, value: have < value, ds.LessThanOrEqual: lambda have, value: have <= value,
    ds.IsNotNull: lambda have, value: True,
}
_TOLD = ("kind", "stage", "product_idx", "page_no")


@dataclass
class Files(ds.InputPartition):
    """(path, size, facts) of the files of one task, and folders whose files it has to find itself."""

    files: list
    folders: list = field(default_factory=list)

    def __post_init__(self) -> None:
        super().__init__(None)


class PageFileReader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionbytes", 64 << 20))
        self.open_cost = int(options.get("opencost", 64 << 10))
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        """Filters on what a name tells are kept here; the others stay with Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if type(f) in _TESTS and column in _TOLD:
                self.tests.append((column, type(f), getattr(f, "value", None)))
            else:
                yield f

    def _fits(self, facts: dict) -> bool:
        return all(_TESTS[kind](facts[column], value) for column, kind, value in self.tests)

    def _folder_fits(self, number: int) -> bool:
        """Whether a folder can hold a product that the filters want."""
        low, high = number * FOLDER_PRODUCTS, (number + 1) * FOLDER_PRODUCTS - 1
        for column, kind, value in self.tests:
            if column != "product_idx" or kind is ds.IsNotNull:
                continue
            if kind is ds.In:
                fits = any(low <= v <= high for v in value)
            elif kind in (ds.GreaterThan, ds.GreaterThanOrEqual):
                fits = _TESTS[kind](high, value)
            elif kind in (ds.LessThan, ds.LessThanOrEqual):
                fits = _TESTS[kind](low, value)
            else:
                fits = low <= value <= high
            if not fits:
                return False
        return True

    def _listed(self, system: fs.FileSystem, folder: str, named: str | None = None) -> tuple[list, list[str]]:
        """The files of a folder that the filters want, and the folders in it that can hold some."""
        found, folders = [], []
        for info in system.get_file_info(fs.FileSelector(folder)):
            if info.base_name.startswith(("_", ".")):
                continue
            if info.type == fs.FileType.Directory:
                number = _FOLDER.search(info.base_name)
                facts = facts_of(info.base_name) if info.base_name.startswith(_FILE_FOLDER) else None
                if (number is None or self._folder_fits(int(number[1]))) and (facts is None or self._fits(facts)):
                    folders.append(info.path)
                continue
            facts = facts_of(named or info.base_name)
            if facts is not None and self._fits(facts):
                found.append((info.path, info.size or 0, facts))
        return found, folders

    def _below(self, system: fs.FileSystem, folders: list[str]) -> Iterator[tuple[str, int, dict]]:
        """The files to read in ``folders`` and the folders in these, folder by folder."""
        folders = list(folders)
        while folders:
            folder = folders.pop()
            name = folder.rsplit("/", 1)[-1]
            found, more = self._listed(system, folder, name if name.startswith(_FILE_FOLDER) else None)
            folders += more
            yield from found

    def chosen(self) -> list[tuple[str, int, dict]]:
        """The files to read, by name. Folders that cannot hold any are not listed."""
        system, root = file_system(self.path)
        return sorted(self._below(system, [root]), key=lambda f: f[0])

    def partitions(self) -> list[Files]:
        system, root = file_system(self.path)
        found, folders = self._listed(system, root)
        if len(folders) > PLANNED_FOLDERS:
            n = min(len(folders), FOLDER_TASKS)
            folders = sorted(folders)
            return [*self._packed(sorted(found, key=lambda f: f[0])), *(Files([], folders[k::n]) for k in range(n))]
        packed = self._packed(sorted([*found, *self._below(system, folders)], key=lambda f: f[0]))
        return packed or [Files([])]

    def _packed(self, files: list[tuple[str, int, dict]]) -> list[Files]:
        packed, held, size = [], [], 0
        for file in files:
            if held and size + max(file[1], self.open_cost) > self.partition_bytes:
                packed.append(Files(held))
                held, size = [], 0
            held.append(file)
            size += max(file[1], self.open_cost)
        return [*packed, Files(held)] if held else packed

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        rows, held = [], 0
        for path, size, facts in chain(partition.files, self._below(system, partition.folders)) if partition else ():
            with system.open_input_stream(path) as stream:
                data = stream.read()
            if path.rpartition("/")[0].rpartition("/")[2].startswith(_FILE_FOLDER):
                data = data.removesuffix(b"\n")
            rows.append({**facts, "size": size, "body": data.decode("utf-8", "replace")})
            held += size
            if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(rows, _ARROW)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


_ARROW = pa.schema([
    ("kind", pa.string()), ("stage", pa.string()), ("product_idx", pa.int32()), ("page_no", pa.int32()), ("size", pa.int64()), ("body", pa.string()),
])


@dataclass
class Written(ds.WriterCommitMessage):
    """A task's staging folder and the names of the folders in it."""

    own: str
    folders: list


class PageFileWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.staging = f"{_STAGING}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = file_system(self.path)
        own, folders = f"{root}/{self.staging}/{uuid.uuid4().hex}", set()
        system.create_dir(own, recursive=True)
        for row in (r for batch in iterator for at in range(0, len(batch), BATCH_ROWS) for r in _rows(batch.slice(at, BATCH_ROWS))):
            folder = f"products_{row['product_idx'] // FOLDER_PRODUCTS:07d}"
            name = name_of(row.get("kind", "page"), row["stage"], row["product_idx"], row["page_no"])
            if folder not in folders:
                system.create_dir(f"{own}/{folder}")
                folders.add(folder)
            with system.open_output_stream(f"{own}/{folder}/{name}") as stream:
                stream.write((row["body"] or "").encode())
        return Written(own, sorted(folders))

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.path)
        old = {i.base_name for i in system.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory and _FOLDER.search(i.base_name)}
        if self.overwrite:
            for folder in old:
                system.delete_dir(f"{root}/{folder}")
            old = set()
        # a new folder moves as one where the file system can do that; the files of others one by one
        whole, single = [], []
        for own, folder in ((m.own, f) for m in messages if m for f in m.folders):
            if folder in old or system.type_name not in ("local", "hdfs"):
                system.create_dir(f"{root}/{folder}", recursive=True)
                single.append((f"{own}/{folder}", f"{root}/{folder}"))
            else:
                whole.append((f"{own}/{folder}", f"{root}/{folder}"))
                old.add(folder)
        with ThreadPoolExecutor(MOVERS) as movers:
            list(movers.map(lambda m: system.move(*m), whole))
            list(movers.map(lambda m: _move_files(system, *m), single))
        system.delete_dir(f"{root}/{self.staging}")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.path)
        if system.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{self.staging}")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    names = batch.schema.names
    return (dict(zip(names, row, strict=True)) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))


def _move_files(system: fs.FileSystem, staged: str, folder: str) -> None:
    for info in system.get_file_info(fs.FileSelector(staged)):
        system.move(info.path, f"{folder}/{info.base_name}")


class PageFiles(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageFileReader:
        return PageFileReader(self.options)

    def writer(self, schema, overwrite: bool) -> PageFileWriter:
        return PageFileWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it take filters."""
    spark.dataSource.register(PageFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_files(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).options(**options).load(path)


def by_folder(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_folder``, all of one folder in one task. A few folders are a task each; opening files is
    the cost, so the number of tasks does not follow the bytes."""
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.withColumn("_folder", F.floor(F.col("product_idx") / FOLDER_PRODUCTS)).repartition(tasks, "_folder")


def write_files(rows: DataFrame, path: str, mode: str = "append") -> None:
    """``rows`` (stage, product_idx, page_no, body, and kind if there are others than pages) as files."""
    write_dealt(by_folder(rows), path, mode)


def write_dealt(rows: DataFrame, path: str, mode: str = "append") -> None:
    """What :func:`write_files` does, for rows that lie where they shall be written."""
    register(rows.sparkSession)
    columns = [c for c in ("kind", "stage", "product_idx", "page_no", "body") if c in rows.columns]
    rows.select(*columns).write.format(FORMAT).mode(mode).save(path)


def page_rows(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages: stage, product_idx, page_no, html."""
    found = read_files(spark, path).filter("kind = 'page'")
    return found.select("stage", "product_idx", "page_no", F.col("body").alias("html"))


def payload_rows(spark: SparkSession, path: str) -> DataFrame:
    """Captured payloads: product_idx, payload_no, source_url, payload (JSON text)."""
    found = read_files(spark, path).filter("kind = 'payload'")
    part = lambda name: F.get_json_object("body", f"$.{name}").alias(name)
    return found.select("product_idx", F.col("page_no").alias("payload_no"), part("source_url"), part("payload"))


def rendered_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rendered pages: product_idx, html."""
    return read_files(spark, path).filter("kind = 'rendered'").select("product_idx", F.col("body").alias("html"))


# The source travels to the workers as code, so that these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
