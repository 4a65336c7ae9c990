"""Many small files as Spark data sources: in archives (``clip_archive``), read by ranges of members, written as few archives; and as
plain files in numbered folders (``clip_files``).

An archive is a zip file; its directory is the index. Reading lists the directories, without the contents, and deals the members out to
partitions of about ``PARTITION_BYTES``, so that one large archive keeps every core busy. A partition opens its archive once
and holds one member at a time. Only the columns of the schema that is asked for are made: without ``content`` nothing is
unpacked, and of Parquet members only the named columns are read. Writing packs the rows of a task into one archive; a
job's archives appear when all its tasks have ended.

Plain files lie at ``part=.../clip_id=.../``, at most ``FOLDER`` clips to a part. A task writes whole parts, and the job's end moves
these; a reading partition is a part, which its task lists. So the driver handles parts, never clips."""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

NAME = "clip_archive"
MEMBERS = "archive string, member string, clip_id string, size bigint, content binary"
#: Unpacked bytes of a partition, and archives whose directories are read side by side.
PARTITION_BYTES, LISTED = 32 << 20, 32
FILES, PART = "clip_files", "part="
#: Clips of a part, and files of a part that are handed on together.
FOLDER, TOGETHER = 1000, 100
# what Spark escapes in a folder's name, and its name for null
_ESCAPED, _NULL = re.compile(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]"""), "__HIVE_DEFAULT_PARTITION__"


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path that tasks can reach, and its place there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path)) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(path))


def clip_of(member: str, suffix: str) -> str:
    """The clip that a member is named after."""
    leaf = member.rsplit("/", 1)[-1]
    return leaf.removesuffix(suffix) if suffix else leaf.rsplit(".", 1)[0]


@dataclass
class Members(InputPartition):
    archive: str
    names: list[str]


class ArchiveReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.options = schema, options
        self.suffix = options.get("suffix", "")

    def _listed(self, store: fs.FileSystem, place: str) -> list[zipfile.ZipInfo]:
        with store.open_input_file(place) as file, zipfile.ZipFile(file) as archive:
            return [m for m in archive.infolist() if not m.is_dir() and m.filename.endswith(self.suffix)]

    def partitions(self) -> list[Members]:
        most = int(self.options.get("partitionbytes", PARTITION_BYTES))
        store, place = store_of(self.options["path"])
        found = store.get_file_info(fs.FileSelector(place, recursive=True)) if store.get_file_info(place).type == fs.FileType.Directory else [store.get_file_info(place)]
        paths = sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".zip") and not re.search(r"/[_.][^/]*/", f.path[len(place) :]))
        if not paths and found and found[0].type == fs.FileType.NotFound:
            raise FileNotFoundError(self.options["path"])
        out = []
        with ThreadPoolExecutor(LISTED) as pool:
            for path, members in zip(paths, pool.map(lambda p: self._listed(store, p), paths)):
                size, names = 0, []
                for m in members:
                    if names and size + m.file_size > most:
                        out.append(Members(path, names))
                        size, names = 0, []
                    names.append(m.filename)
                    size += m.file_size
                if names:
                    out.append(Members(path, names))
        return out

    def read(self, partition: Members | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are none
            return
        schema = to_arrow_schema(self.schema)
        store, _ = store_of(self.options["path"])
        with store.open_input_file(partition.archive) as file, zipfile.ZipFile(file) as archive:
            for name in partition.names:
                yield from self._rows(archive, partition.archive, name, schema)

    def _rows(self, archive: zipfile.ZipFile, path: str, name: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        one = {"archive": path, "member": name, "clip_id": clip_of(name, self.suffix), "size": archive.getinfo(name).file_size}
        if "content" in schema.names:
            one["content"] = archive.read(name)
        yield pa.RecordBatch.from_arrays([pa.array([one[f.name]], f.type) for f in schema], schema=schema)


class ParquetReader(ArchiveReader):
    """Members are Parquet files, whose rows come out; ``clip_id`` is the member's where it has none, missing columns are null."""

    def _rows(self, archive: zipfile.ZipFile, path: str, name: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        with pq.ParquetFile(io.BytesIO(archive.read(name))) as file:
            there = [c for c in schema.names if c in file.schema_arrow.names]
            at = 0
            for batch in file.iter_batches(columns=there):
                made = {"clip_id": pa.array([clip_of(name, self.suffix)] * batch.num_rows), "row": pa.array(range(at, at + batch.num_rows))}
                columns = [batch.column(f.name) if f.name in there else made.get(f.name, pa.nulls(batch.num_rows, f.type)) for f in schema]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)
                at += batch.num_rows


def folder_of(clip: str | None) -> str:
    """A clip's folder, named as Spark names it."""
    return "clip_id=" + (_ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", clip) if clip else _NULL)


def clip_of_folder(folder: str) -> str | None:
    name = folder.removeprefix("clip_id=")
    return None if name == _NULL else re.sub("%([0-9A-Fa-f]{2})", lambda c: chr(int(c[1], 16)), name)


@dataclass
class Part(InputPartition):
    path: str


def parts_of(path: str) -> list[str]:
    """The parts of plain files below ``path``; none where it has another layout, or is in a store that tasks don't reach this way."""
    try:
        store, place = store_of(path)
    except pa.ArrowInvalid:
        return []
    found = store.get_file_info(fs.FileSelector(place, allow_not_found=True)) if store.get_file_info(place).type == fs.FileType.Directory else []
    return sorted(f.path for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(PART))


class FileReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.path = schema, options["path"]

    def partitions(self) -> list[Part]:
        return [Part(p) for p in parts_of(self.path)]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there are none
            return
        schema, (store, _) = to_arrow_schema(self.schema), store_of(self.path)
        files = sorted(f.path for f in store.get_file_info(fs.FileSelector(partition.path, recursive=True)) if f.type == fs.FileType.File and f.base_name[0] not in "._")
        for at in range(0, len(files), TOGETHER):
            some = files[at : at + TOGETHER]
            made = {"clip_id": [clip_of_folder(f.rsplit("/", 2)[1]) for f in some]}
            if "content" in schema.names:
                made["content"] = [self._content(store, f) for f in some]
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in schema], schema=schema)

    def _content(self, store: fs.FileSystem, path: str) -> bytes:
        with store.open_input_stream(path) as file:
            return file.read()


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class ArchiveWriter(DataSourceWriter):
    """A task's archive is written to a hidden folder, and moved out of it when the job is done."""

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.suffix, self.overwrite, self.job = options["path"], options.get("suffix", ""), overwrite, uuid.uuid4().hex

    def _hidden(self, place: str) -> str:
        return f"{place.rstrip('/')}/_{self.job}"

    def write(self, iterator: Iterator) -> Written:
        store, place = store_of(self.path)
        name, file, archive = None, None, None
        for row in iterator:
            if archive is None:
                name = f"part-{uuid.uuid4().hex}.zip"
                store.create_dir(self._hidden(place), recursive=True)
                file = store.open_output_stream(f"{self._hidden(place)}/{name}")
                archive = zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED)
            content = row["content"]
            archive.writestr(f"{row['clip_id']}{self.suffix}", bytes(content) if isinstance(content, bytearray) else content)
        if archive is not None:
            archive.close()
            file.close()
        return Written([name] if name else [])

    def commit(self, messages: list[Written | None]) -> None:
        store, place = store_of(self.path)
        store.create_dir(place, recursive=True)
        old = [f.path for f in store.get_file_info(fs.FileSelector(place)) if f.path.endswith(".zip")] if self.overwrite else []
        for m in messages:
            for name in m.names if m is not None else ():
                self._move(store, f"{self._hidden(place)}/{name}", f"{place.rstrip('/')}/{name}")
        for path in old:
            store.delete_file(path)
        self._clear(store, place)

    def _move(self, store: fs.FileSystem, source: str, target: str) -> None:
        store.move(source, target)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*store_of(self.path))

    def _clear(self, store: fs.FileSystem, place: str) -> None:
        """Also what tasks that were run twice have left."""
        if store.get_file_info(self._hidden(place)).type == fs.FileType.Directory:
            store.delete_dir(self._hidden(place))


class FileWriter(ArchiveWriter):
    """A file of each row; whole parts are moved out of the hidden folder."""

    def write(self, iterator: Iterator) -> Written:
        store, place = store_of(self.path)
        names: list[str] = []
        for i, row in enumerate(iterator):
            if i % FOLDER == 0:
                names.append(f"{PART}p{uuid.uuid4().hex}")
            folder = f"{self._hidden(place)}/{names[-1]}/{folder_of(row['clip_id'])}"
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/{uuid.uuid4().hex}{self.suffix}") as file:
                file.write(bytes(row["content"]))
        return Written(names)

    def _move(self, store: fs.FileSystem, source: str, target: str) -> None:
        if store.type_name in ("local", "hdfs"):
            store.move(source, target)
            return
        for f in store.get_file_info(fs.FileSelector(source, recursive=True)):  # object stores have no folders to move
            if f.type == fs.FileType.File:
                place = target + f.path[len(source) :]
                store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                store.move(f.path, place)


class FileSource(DataSource):
    """Options: path, and suffix of the files to write. Files are added to those that are there."""

    @classmethod
    def name(cls) -> str:
        return FILES

    def schema(self) -> str:
        return "clip_id string, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return FileReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError(f"{FILES} can't overwrite")
        return FileWriter({k.lower(): v for k, v in self.options.items()}, False)


class ArchiveSource(DataSource):
    """Options: path (an archive, or a folder of them), suffix (of the members), partitionBytes, and kind: members (default), or parquet
    for the rows of Parquet members, where the schema is the caller's."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema: StructType) -> DataSourceReader:
        return (ParquetReader if self.options.get("kind") == "parquet" else ArchiveReader)(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ArchiveWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def read_archives(spark: SparkSession, path: str, schema: str = MEMBERS, **options: str) -> DataFrame:
    """Members of the archives below ``path``, with the columns of ``schema``."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(NAME).schema(schema).options(path=path, **options).load()


def write_archives(files: DataFrame, path: str, suffix: str = "", mode: str = "append") -> None:
    """(clip_id, content) as members of one archive per task, named by clip and ``suffix``. Members of one clip in two archives are both kept."""
    files.sparkSession.dataSource.register(ArchiveSource)
    files.select("clip_id", "content").write.format(NAME).mode(mode).options(path=path, suffix=suffix).save()


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(clip_id, content) of plain files that ``write_files`` wrote."""
    spark.dataSource.register(FileSource)
    return spark.read.format(FILES).option("path", path).load()


def write_files(files: DataFrame, path: str, suffix: str = "") -> None:
    """(clip_id, content) as a plain file of each row; ``path`` must not be there yet."""
    store, place = store_of(path)
    if store.get_file_info(place).type != fs.FileType.NotFound:
        raise FileExistsError(path)
    files.sparkSession.dataSource.register(FileSource)
    files.select("clip_id", files["content"].cast("binary").alias("content")).write.format(FILES).mode("append").options(path=path, suffix=suffix).save()
