"""Stored result lists as a data source: one file for each page of a list, ``<path>/<list>/<n>.html``.

    register(spark)
    spark.read.format("page_files").option("first_url", ...).load(path)
    spark.readStream.format("page_files").load(path)

Rows are (list, page, html). The pages of a list are 1 to n, n being what the last pagination link of page 1 says (``pages``
overrides it), up to the first page that is missing or empty; every page is a partition of its own, or ``per_task`` of
them. ``lists`` (names with commas between), ``from_page`` and ``to_page`` choose files. In the format ``page_files_pushed``, which
needs ``spark.sql.python.filterPushdown.enabled``, so do conditions ``list = ...``, ``list in (...)`` and comparisons of ``page`` with
a number; Spark keeps them with the loaded table, so load it anew for each set of conditions.

As a stream, offsets are the number of pages taken of each list: a list that grew since, or a new one, gives the pages that
came, and a page that is still missing or empty ends the list until it is there. Files are opened through Arrow, so the
path may be of any store that Arrow knows (``file``, ``hdfs``, ``s3``, ``gs``)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

NAME, SCHEMA = "page_files", "list string, page int, html string"
_PAGINATION = re.compile(rb"[?&;]page=(\d+)")
_COMPARED = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, EqualTo: lambda a, b: a == b}


@dataclass
class Pages(InputPartition):
    name: str
    pages: tuple[int, ...]


class Store:
    """The folder of lists."""

    def __init__(self, path: str):
        self.files, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def lists(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)

    def page(self, name: str, number: int) -> bytes:
        """What is stored; nothing if the page isn't there."""
        path = f"{self.root}/{name}/{number}.html"
        if self.files.get_file_info(path).type != fs.FileType.File:
            return b""
        with self.files.open_input_stream(path) as f:
            return f.read()

    def has(self, name: str, number: int) -> bool:
        info = self.files.get_file_info(f"{self.root}/{name}/{number}.html")
        return info.type == fs.FileType.File and bool(info.size)

    def count(self, name: str) -> int:
        """How many pages the first one announces."""
        links = _PAGINATION.findall(self.page(name, 1))
        return int(links[-1]) if links else 1

    def end(self, name: str, announced: int, after: int = 0) -> int:
        """The last page before the first missing or empty one."""
        while after < announced and self.has(name, after + 1):
            after += 1
        return after

    def write(self, name: str, number: int, html: bytes) -> None:
        self.files.create_dir(f"{self.root}/{name}", recursive=True)
        with self.files.open_output_stream(f"{self.root}/{name}/{number}.html") as f:
            f.write(html)


def _rows(path: str, part: Pages, encoding: str) -> Iterator[tuple]:
    store = Store(path)
    for n in part.pages:
        yield part.name, n, store.page(part.name, n).decode(encoding, "replace")


class _Options:
    def __init__(self, options: dict[str, str]):
        self.path, self.encoding = options["path"], options.get("encoding", "utf-8")
        self.pages = int(options["pages"]) if "pages" in options else None
        self.per_task = int(options.get("per_task", "1"))
        self.lists = {n.strip() for n in options["lists"].split(",")} if "lists" in options else None
        self.first, self.last = int(options.get("from_page", "1")), int(options.get("to_page", str(1 << 31)))

    def announced(self, store: Store, name: str) -> int:
        return self.pages if self.pages is not None else store.count(name)

    def parts(self, name: str, numbers: list[int]) -> list[Pages]:
        return [Pages(name, tuple(numbers[k : k + self.per_task])) for k in range(0, len(numbers), self.per_task)]


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = _Options(options)
        self.lists = self.options.lists
        self.tests: list[tuple[type, int]] = [(GreaterThanOrEqual, self.options.first), (LessThanOrEqual, self.options.last)]

    def partitions(self) -> list[Pages]:
        store, out = Store(self.options.path), []
        for name in store.lists():
            if self.lists is None or name in self.lists:
                end = store.end(name, self.options.announced(store, name))
                out += self.options.parts(name, [n for n in range(1, end + 1) if all(_COMPARED[kind](n, value) for kind, value in self.tests)])
        return out or [Pages("", ())]

    def read(self, partition: Pages) -> Iterator[tuple]:
        return _rows(self.options.path, partition, self.options.encoding)


class PushedReader(PageReader):
    """Spark asks readers with this method for nothing unless filter push-down is on."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            match f:
                case EqualTo(attribute=("list",), value=str(value)):
                    self.lists = {value} if self.lists is None else self.lists & {value}
                case In(attribute=("list",), value=values):
                    self.lists = set(values) if self.lists is None else self.lists & set(values)
                case EqualTo(attribute=("page",), value=int(value)) | GreaterThan(attribute=("page",), value=int(value)) | GreaterThanOrEqual(attribute=("page",), value=int(value)) | LessThan(attribute=("page",), value=int(value)) | LessThanOrEqual(attribute=("page",), value=int(value)):
                    self.tests.append((type(f), value))
                case _:
                    yield f


class PageStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = _Options(options)
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store = Store(self.options.path)
        self.seen = {name: store.end(name, self.options.announced(store, name), self.seen.get(name, 0)) for name in store.lists()}
        return dict(self.seen)

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        out = [p for name, last in sorted(end.items()) for p in self.options.parts(name, list(range(start.get(name, 0) + 1, last + 1)))]
        return out or [Pages("", ())]

    def read(self, partition: Pages) -> Iterator[tuple]:
        return _rows(self.options.path, partition, self.options.encoding)

    def commit(self, end: dict) -> None:
        """Pages stay where they are."""


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options)


class PushedPageFiles(PageFiles):
    @classmethod
    def name(cls) -> str:
        return f"{NAME}_pushed"

    def reader(self, schema) -> PushedReader:
        return PushedReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageFiles)
    spark.dataSource.register(PushedPageFiles)


def write_pages(pages, path: str) -> None:
    """Store (list, page, html) rows as the files of lists; tasks write their own rows."""

    def write(batches):
        store = Store(path)
        for batch in batches:
            for name, number, html in zip(*(batch.column(c).to_pylist() for c in ("list", "page", "html")), strict=True):
                store.write(name, number, (html or "").encode())
        yield from ()

    pages.select("list", "page", "html").mapInArrow(write, "done int").collect()
