"""Folders of flat marts: moves that never land inside another folder, and the record that
lets an interrupted switch to a compacted copy be brought to an end.

A flat mart that the catalog knows is switched by its ``LOCATION``: the copy lies in a folder
of its own (``<root>__v<id>``) and one catalog change makes readers see it.  The copy's
``_superseded`` file names the folder it replaces and the files that were read from it.

A mart without a catalog entry is switched by two moves under a record beside the folder
(``<root>__switch``).  Whoever writes next, or compacts next, reads the record first
(:func:`settle`), so rows are neither lost nor brought back, wherever a run ended.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemart.plans.mart import Mart

#: endings of the folders beside a flat mart, and the record inside a switched copy
STAGED, ASIDE, RECORD, SUPERSEDED = "__staged", "__compacting", "__switch", "_superseded"
VERSION = "__v"


class Folder:
    """One folder (or file) of the file system behind a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._p = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._p.getFileSystem(self._conf)

    def beside(self, ending: str) -> "Folder":
        return Folder(self.spark, self.path + ending)

    def child(self, name: str) -> "Folder":
        return Folder(self.spark, f"{self.path}/{name}")

    def qualified(self) -> str:
        """The path with its scheme, as file listings print it."""
        return self._fs.makeQualified(self._p).toString()

    def modified_ms(self) -> int:
        return int(self._fs.getFileStatus(self._p).getModificationTime())

    def make(self, empty_file: str | None = None) -> None:
        """Create the folder, with an empty file in it if one is named."""
        self._fs.mkdirs(self._p)
        if empty_file:
            self._fs.create(self.child(empty_file)._p, False).close()

    def exists(self) -> bool:
        return bool(self._fs.exists(self._p))

    def files(self) -> set[str]:
        """Names of the visible files in the folder (one flat mart's worth of metadata)."""
        if not self.exists():
            return set()
        names = [(st.isFile(), st.getPath().getName()) for st in self._fs.listStatus(self._p)]
        return {n for is_file, n in names if is_file and not n.startswith(("_", "."))}

    def folders(self) -> list["Folder"]:
        """The folders right below this one."""
        if not self.exists():
            return []
        return [Folder(self.spark, st.getPath().toString())
                for st in self._fs.listStatus(self._p) if st.isDirectory()]

    def below(self, starts: list[str]) -> list[str]:
        """Relative paths of the folders whose first name begins with the first of
        ``starts``, the next with the next, and so on; they come over as one text."""
        java = self._jvm.org.apache.hadoop.fs
        pattern = "/".join(re.sub(r"([\\\[\]{}*?^,])", r"\\\1", x) + "*" for x in starts)
        found = self._fs.globStatus(java.Path(self._p, pattern))
        if not found or not len(found):
            return []
        n = len(found)
        names = self.spark.sparkContext._gateway.new_array(self._jvm.java.lang.Object, n)
        self._jvm.java.lang.System.arraycopy(java.FileUtil.stat2Paths(found), 0, names, 0, n)
        text = self._jvm.java.util.Arrays.toString(names)
        root = self.qualified() + "/"
        return text[1 + len(root):-1].split(", " + root)  # a name holds no root: "/" is escaped

    def delete(self) -> None:
        if self.exists() and not self._fs.delete(self._p, True):
            raise RuntimeError(f"could not delete {self.path}")

    def move(self, target: "Folder") -> None:
        """Rename to ``target``; raises, and moves nothing, when the target exists."""
        java = self._jvm.org.apache.hadoop.fs
        rename = getattr(java, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        try:
            context = java.FileContext.getFileContext(self._p.toUri(), self._conf)
            context.rename(self._p, target._p, none)
            return
        except Py4JJavaError as exc:
            cause = exc.java_exception
            if "UnsupportedFileSystem" not in cause.getClass().getName():
                raise RuntimeError(f"could not move {self.path} to {target.path}: "
                                   f"{cause.getMessage()}") from exc
        if target.exists() or not self._fs.rename(self._p, target._p):
            raise RuntimeError(f"could not move {self.path} to {target.path}")

    def write_text(self, text: str) -> None:
        """Create the file; raises when it exists."""
        try:
            out = self._fs.create(self._p, False)
        except Py4JJavaError as exc:
            raise RuntimeError(f"{self.path} exists: another run is at work") from exc
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self) -> str:
        stream = self._fs.open(self._p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _move_files(source: Folder, target: Folder, names) -> None:
    for name in sorted(names):
        source.child(name).move(target.child(name))


# catalog marts -----------------------------------------------------------------------
def new_version(root: Folder) -> Folder:
    """A fresh folder beside ``root`` for the next version of its mart."""
    base = root.path.rsplit(VERSION, 1)[0] if VERSION in root.path.rsplit("/", 1)[-1] else root.path
    return Folder(root.spark, f"{base}{VERSION}{uuid.uuid4().hex[:12]}")


def supersede(copy: Folder, old: Folder, files: set[str]) -> None:
    """Record in ``copy`` which folder, with which files, it is a copy of."""
    copy.child(SUPERSEDED).write_text(json.dumps({"old": old.path, "files": sorted(files)}))


def _finish_location(current: Folder) -> None:
    """After a location switch: files that reached the old folder too late to be read are
    moved over, then the old folder goes."""
    record = current.child(SUPERSEDED)
    if not record.exists():
        return
    said = json.loads(record.read_text())
    old = Folder(current.spark, said["old"])
    if old.exists() and old.path != current.path:
        _move_files(old, current, old.files() - set(said["files"]))
        old.delete()
    record.delete()


# marts without a catalog entry ------------------------------------------------------------
def begin_switch(root: Folder, files: set[str]) -> None:
    root.beside(RECORD).write_text(json.dumps({"files": sorted(files)}))


def put_back(root: Folder) -> None:
    """The folder that was moved aside becomes the mart again, with the files that were
    written to a recreated root meanwhile; the copy goes."""
    aside = root.beside(ASIDE)
    if aside.exists():
        if root.exists():
            _move_files(root, aside, root.files())
            root.delete()
        aside.move(root)
    root.beside(STAGED).delete()
    root.beside(RECORD).delete()


def _finish_moves(root: Folder, schema) -> None:
    aside, staged, record = (root.beside(e) for e in (ASIDE, STAGED, RECORD))
    if not aside.exists():  # not begun, or ended: the root is the mart
        staged.delete()
        record.delete()
    elif staged.exists() or not root.exists():
        put_back(root)
    elif record.exists():  # the copy is in place; only the clearing up was left
        read = set(json.loads(record.read_text())["files"])
        _move_files(aside, root, aside.files() - read)
        aside.delete()
        record.delete()
    else:  # folders of a run that kept no record: the fuller one is the mart
        def rows(folder: Folder) -> int:
            return root.spark.read.schema(schema).parquet(folder.path).count()
        if rows(root) >= rows(aside):
            aside.delete()
        else:
            put_back(root)


def settle(spark: SparkSession, mart: Mart) -> Mart:
    """Bring an interrupted switch of a flat mart to an end and return the mart with the
    location it has now.  Every writer of the library calls this before it writes."""
    if mart.is_partitioned:
        return mart
    mart = mart.located(spark)
    root = Folder(spark, mart.path)
    if mart.table:
        _finish_location(root)
    else:
        _finish_moves(root, mart.schema)
    return mart


def unused_versions(spark: SparkSession, mart: Mart) -> list[str]:
    """Folders of versions that a stopped compaction left beside a registered mart and that
    the catalog does not point to.  Only call (and delete) while no compaction runs."""
    root = Folder(spark, mart.located(spark).path)
    base = root.path.rsplit(VERSION, 1)[0]
    found = root._fs.globStatus(root._jvm.org.apache.hadoop.fs.Path(base + VERSION + "*"))
    paths = [st.getPath().toString() for st in (found or [])]
    return sorted(p for p in paths if p.rsplit("/", 1)[-1] != root.path.rsplit("/", 1)[-1])
