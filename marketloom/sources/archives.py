"""ZIP archives by their members: what isn't asked for isn't read, and no member is held whole."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import ExitStack

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .landed import _file_system
from .readers import listing

#: Bytes of a member in one row.
PART = 4 << 20
#: Bytes of an archive whose members go to one task, which reads its directory once.
SPAN = 32 << 20
MEMBERS = "path string, member string, offset long, size long, compressed long, error string"


def opened(path: str):
    """A file for reads at any place; only what is read is fetched."""
    files, at = _file_system(path)
    return files.open_input_file(at)


def _directories(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            with opened(path) as f:
                try:
                    rows = [(path, m.filename, m.header_offset, m.file_size, m.compress_size, None) for m in zipfile.ZipFile(f).infolist() if not m.is_dir()]
                except (zipfile.BadZipFile, OSError, ValueError) as e:
                    rows = [(path, None, None, None, None, str(e) or "not an archive")]
            names = [c.split()[0] for c in MEMBERS.split(", ")]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def members(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """The members of all archives below a folder: path, member, offset, size, compressed, error.

    Files are listed, and of each only the directory at its end is read. What is no archive has one row with its error.
    """
    return listing(spark, path, pattern).select("path").mapInArrow(_directories, MEMBERS)


def _contents(batches) -> Iterator[pa.RecordBatch]:
    names = ["path", "member", "offset", "part", "content", "error"]

    def row(path, member, offset, part, content, error):
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([member]), pa.array([offset], pa.int64()), pa.array([part], pa.int32()), pa.array([content], pa.binary()), pa.array([error], pa.string())], names)

    last, held, z, places = None, ExitStack(), None, {}
    with held:
        for batch in batches:
            for path, member, offset in zip(*(batch.column(k).to_pylist() for k in range(3))):
                part = 0
                try:
                    if path != last:
                        # rows come archive by archive, so a directory is read once, not for each member
                        last, places = None, {}
                        held.close()
                        z = held.enter_context(zipfile.ZipFile(held.enter_context(opened(path))))
                        for m in z.infolist():
                            places.setdefault(m.header_offset, m)
                        last = path
                    if offset not in places:
                        raise KeyError(f"no member at {offset}")
                    with z.open(places[offset]) as m:
                        while (content := m.read(PART)) or not part:
                            yield row(path, member, offset, part, content, None)
                            part += 1
                except (zipfile.BadZipFile, OSError, EOFError, RuntimeError, NotImplementedError, KeyError) as e:
                    yield row(path, member, offset, part, None, str(e) or type(e).__name__)


def contents(asked: DataFrame) -> DataFrame:
    """The contents of members (path, member, offset): path, member, offset, part, content, error.

    A large archive's members are dealt to different tasks by the place where they begin, each of which reads the directory once and just its members' bytes; a member
    comes in parts of at most PART bytes, from 0. One that is encrypted, damaged or packed by an unknown method has its error in its last part;
    the parts before it are as far as it could be read.
    """
    rows = asked.where("member is not null").select("path", "member", "offset").repartition("path", F.floor(F.col("offset") / SPAN)).sortWithinPartitions("path", "offset")
    return rows.mapInArrow(_contents, "path string, member string, offset long, part int, content binary, error string")


def begins_with(spark: SparkSession, path: str, magic: bytes, pattern: str = "*") -> DataFrame:
    """Whether each file below a folder begins with the magic bytes: path, valid. No more of it than these is read."""

    def run(batches):
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                with opened(name) as f:
                    found.append(f.read(len(magic)) == magic)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.bool_())], ["path", "valid"])

    return listing(spark, path, pattern).select("path").mapInArrow(run, "path string, valid boolean")


def packed(rows: DataFrame, path: str) -> None:
    """Writes ZIP archives below a folder from rows (archive, member, content): an archive is made in one task, a member after the other.

    Archives are made under another name and then moved, so that a retried task leaves a whole one.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        files, at = _file_system(path)
        files.create_dir(at, recursive=True)
        name = part = out = z = None

        def close():
            if z:
                z.close()
                out.close()
                files.move(part, f"{at}/{name}")

        for batch in batches:
            for archive, member, content in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if archive != name:
                    close()
                    name, part = archive, f"{at}/.{uuid.uuid4().hex}"
                    out = files.open_output_stream(part)
                    z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                z.writestr(member, content)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["archive"])

    rows.select("archive", "member", "content").repartition("archive").sortWithinPartitions("archive", "member").mapInArrow(write, "archive string").write.format("noop").mode("overwrite").save()
