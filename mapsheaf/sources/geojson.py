"""GeoJSON as a data source: ``df.write.format("feature_collections").save(out)``.

Rows have ``type`` and ``value``, the text of one feature (``geojson_lines``). Each task writes one
feature collection per type, a document of its own below ``<out>/type=<type>/``, and a further one
after each ``features_per_file`` features. Files are written below ``<out>/_staged-<job>`` and moved
to their place on commit only, those that the tasks Spark counts have named: what failed or
speculative attempts wrote is never seen, and goes with the staged folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StringType, StructType

from mapsheaf.functions.predicates import meets_box
from mapsheaf.session import ship_package
from mapsheaf.sources.export import geojson_lines

FEATURES_PER_FILE = 1_000_000


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    # Spark writes local paths with one slash.
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and path[6] != "/" else path)


@dataclass
class Written(WriterCommitMessage):
    """Files of one task below the staged folder, with the folder of their type."""

    files: list[str]


class _Collection:
    """One document that is being written."""

    def __init__(self, store: fs.FileSystem, folder: str, name: str):
        store.create_dir(folder, recursive=True)
        self.stream, self.features = store.open_output_stream(f"{folder}/{name}"), 0
        self.stream.write(b'{"type":"FeatureCollection","features":[\n')

    def add(self, values: list[str]) -> None:
        lead = ",\n" if self.features else ""
        self.stream.write((lead + ",\n".join(values)).encode())
        self.features += len(values)

    def close(self) -> None:
        self.stream.write(b"\n]}\n")
        self.stream.close()


class CollectionWriter(DataSourceArrowWriter):
    def __init__(self, out: str, overwrite: bool, features_per_file: int):
        self.out, self.overwrite, self.limit = out.rstrip("/"), overwrite, features_per_file
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, out = _store(self.out)
        attempt, files, opened = uuid.uuid4().hex, [], {}
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            # A document per type stays open: there are as many as types.
            for type_ in table.column("type").unique().to_pylist():
                same = table.filter(pc.equal(table.column("type"), type_))
                values = [v for v in same.column("value").to_pylist() if v is not None]
                while values:
                    if type_ not in opened:
                        name = f"part-{attempt}-{len(files)}.geojson"
                        folder = f"type={quote(type_, safe='')}"
                        opened[type_] = _Collection(store, f"{out}/_staged-{self.job}/{folder}", name)
                        files.append(f"{folder}/{name}")
                    document = opened[type_]
                    room = self.limit - document.features
                    document.add(values[:room])
                    values = values[room:]
                    if document.features == self.limit:
                        opened.pop(type_).close()
        for document in opened.values():
            document.close()
        return Written(files)

    def _published(self, store: fs.FileSystem, out: str) -> list[str]:
        found = store.get_file_info(fs.FileSelector(out, recursive=True, allow_not_found=True))
        return [f.path for f in found if f.is_file and f.path.endswith(".geojson") and "/_staged-" not in f.path]

    def commit(self, messages: list[Written | None]) -> None:
        store, out = _store(self.out)
        before = self._published(store, out) if self.overwrite else []
        for message in messages:
            for file in message.files if message else ():
                store.create_dir(f"{out}/{file.rsplit('/', 1)[0]}", recursive=True)
                store.move(f"{out}/_staged-{self.job}/{file}", f"{out}/{file}")
        # New files first: a reader may see both for a moment, never none.
        for path in before:
            store.delete_file(path)
        self._drop_staged(store, out)

    def abort(self, messages: list[Written | None]) -> None:
        self._drop_staged(*_store(self.out))

    def _drop_staged(self, store: fs.FileSystem, out: str) -> None:
        staged = f"{out}/_staged-{self.job}"
        if store.get_file_info(staged).type == fs.FileType.Directory:
            store.delete_dir(staged)


class FeatureCollections(DataSource):
    """Options: ``path`` (of ``save``) and ``features_per_file``."""

    @classmethod
    def name(cls) -> str:
        return "feature_collections"

    def schema(self) -> str:
        return "type string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> CollectionWriter:
        if {f.name: f.dataType for f in schema} != {"type": StringType(), "value": StringType()}:
            raise ValueError("rows to write have two texts: type and value")
        limit = int(self.options.get("features_per_file", FEATURES_PER_FILE))
        if limit < 1:
            raise ValueError("features_per_file must be 1 at least")
        return CollectionWriter(self.options["path"], overwrite, limit)


def export_collections(df: DataFrame, bbox, types: Iterable[str], out: str,
                       features_per_file: int = FEATURES_PER_FILE) -> None:
    """Write the features of ``types`` that meet ``bbox`` as documents that open as they are.

    Replaces what lies in ``out`` once the new documents are in place. A type without features gets none.
    """
    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(FeatureCollections)
    wanted = geojson_lines(df.where(F.col("type").isin(*types) & meets_box(bbox)))
    wanted.write.format(FeatureCollections.name()).option("features_per_file", features_per_file).mode("overwrite").save(out)
