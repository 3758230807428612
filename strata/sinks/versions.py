"""Optimistic publishing: numbered publications of a table, each claimed by exactly one writer.

A table's base folder holds its version folders and, below ``_published``, one small file per
publication (``000000000007``) that says where the table's rows are from then on. A writer reads the
last publication, computes its result from that one's rows, writes the result, and then claims the
next number. A number can be claimed once: the file is written aside and put in place by a hard
link (local folders) or a rename that never replaces (HDFS), both atomic. The second writer from the
same publication gets ``PublishConflict`` and has to start again from the rows it has not seen.

Only after the claim is the catalog pointed at the new place. A writer that dies in between has
published; whoever comes next points the catalog at the last publication first. Appends name a hidden
folder that is moved into place by one directory rename, again by whoever comes next if need be, so
their rows are seen all or not at all. Object stores whose rename copies are not safe for this.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_published"


class PublishConflict(RuntimeError):
    """Another writer has published since the rows this result was computed from were read."""


@dataclass(frozen=True)
class Publication:
    number: int
    location: str
    fmt: str = "parquet"
    #: hidden folder below ``location`` that becomes visible with this publication
    added: str | None = None
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    #: partitions repointed by it (folder names below ``location``); finished when marked
    partitions: tuple[str, ...] = ()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(name, modification time in ms)`` of what lies directly below a folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with its whole content, or leave it alone and say False if it is there."""
    aside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    fs, p = _fs(spark, aside)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        if fs.getUri().getScheme() == "file":
            link = lambda x: spark._jvm.java.io.File(fs.makeQualified(x).toUri().getPath()).toPath()
            try:
                spark._jvm.java.nio.file.Files.createLink(link(target), link(p))
                return True
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" in str(e.java_exception):
                    return False
                raise
        return not fs.exists(target) and fs.rename(p, target)
    finally:
        fs.delete(p, False)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def last(spark: SparkSession, base: str) -> Publication | None:
    """The last publication below ``base``."""
    numbers = [int(name) for name, _ in folders(spark, f"{base}/{LOG}") if name.isdigit()]
    if not numbers:
        return None
    got = json.loads(_read_text(spark, f"{base}/{LOG}/{max(numbers):012d}"))
    return Publication(**got | {k: tuple(got[k]) for k in ("bucket_by", "partitions")})


def claim(spark: SparkSession, base: str, publication: Publication) -> None:
    """Make ``publication`` the table's state, or raise ``PublishConflict`` if its number is taken."""
    # a gap would mean that the state it follows was never published
    path = f"{base}/{LOG}/{publication.number:012d}"
    if not _put_once(spark, path, json.dumps(asdict(publication))):
        raise PublishConflict(f"{path} was published by another writer")


def show_added(spark: SparkSession, publication: Publication) -> None:
    """Make the rows of an append visible: one directory rename, repeatable."""
    if publication.added is None:
        return
    fs, hidden = _fs(spark, f"{publication.location}/{publication.added}")
    shown = spark._jvm.org.apache.hadoop.fs.Path(f"{publication.location}/{publication.added.lstrip('_')}")
    if fs.exists(hidden) and not fs.exists(shown) and not fs.rename(hidden, shown) and not fs.exists(shown):
        raise RuntimeError(f"{hidden} cannot be moved to {shown}")


def mark_finished(spark: SparkSession, base: str, number: int) -> None:
    _put_once(spark, f"{base}/{LOG}/{number:012d}.finished", "")


def is_finished(spark: SparkSession, base: str, publication: Publication) -> bool:
    return not publication.partitions or exists(spark, f"{base}/{LOG}/{publication.number:012d}.finished")
