"""Files as a verified, append-only data source: staged, read back, published once, never overwritten.

    spark.dataSource.register(VerifiedFiles)
    df.select("name", "content").write.format("verified_files").option("path", uri).mode("append").save()

Each task writes its rows as files under a staging folder of the write, reads them back and leaves a manifest of names and
SHA-256 digests.  The commit publishes them one by one: a name that is there with the same bytes is left alone, so writing
again does nothing; one with other bytes stops the commit before anything is published.  A failed task or commit leaves no
staged file.  With the option mirror, what was published is copied there, under the same rules, and verified.  Paths are
URIs of a file system that all executors share.  One write to a folder commits at a time.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "name string, content binary"
STAGING = "_staging"


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    fs, path = pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
    return fs, path.rstrip("/")


def read_bytes(fs: pafs.FileSystem, path: str) -> bytes:
    with fs.open_input_stream(path, compression=None) as f:
        return f.read()


def write_verified(fs: pafs.FileSystem, path: str, content: bytes) -> str:
    """Writes, reads back and returns the digest; a file that reads back otherwise is removed."""
    wanted = hashlib.sha256(content).hexdigest()
    with fs.open_output_stream(path, compression=None) as f:
        f.write(content)
    if hashlib.sha256(read_bytes(fs, path)).hexdigest() != wanted:
        fs.delete_file(path)
        raise OSError(f"{path} does not read back as written")
    return wanted


def exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def checked_name(name: str) -> str:
    if not name or name in (".", "..", STAGING) or "/" in name or "\\" in name or "\0" in name:
        raise ValueError(f"not a file name: {name!r}")
    return name


@dataclass
class Staged(WriterCommitMessage):
    manifest: str


class VerifiedWriter(DataSourceWriter):
    def __init__(self, options):
        self.uri, self.mirror = options["path"], options.get("mirror")
        self.batch = uuid.uuid4().hex
        fs, root = opened(self.uri)
        fs.create_dir(f"{root}/{STAGING}", recursive=True)
        write_verified(fs, self._going(root), b"")

    def _going(self, root: str) -> str:
        """A file that is there as long as the write may still commit."""
        return f"{root}/{STAGING}/{self.batch}.going"

    def write(self, iterator) -> Staged:
        fs, root = opened(self.uri)
        own = f"{root}/{STAGING}/{self.batch}/{uuid.uuid4().hex}"
        fs.create_dir(own, recursive=True)
        try:
            lines = []
            for k, row in enumerate(iterator):
                if row["content"] is None:
                    raise ValueError(f"{row['name']!r} has no content")
                at = f"{own}/{k}"
                lines.append(json.dumps([checked_name(row["name"]), at, write_verified(fs, at, bytes(row["content"]))]))
            write_verified(fs, f"{own}/manifest", "\n".join(lines).encode())
            # What was written before the write was given up is removed with it; what comes later is removed here.
            if not exists(fs, self._going(root)):
                raise RuntimeError("the write was given up")
        except BaseException:
            fs.delete_dir(own)
            raise
        return Staged(f"{own}/manifest")

    def _entries(self, messages) -> Iterator[tuple[str, str, str]]:
        fs, _ = opened(self.uri)
        for m in messages:
            if m is not None:
                for line in read_bytes(fs, m.manifest).decode().splitlines():
                    yield tuple(json.loads(line))

    def commit(self, messages) -> None:
        fs, root = opened(self.uri)
        digests: dict[str, str] = {}  # all names are known before the first is published
        for name, _, digest in self._entries(messages):
            there = f"{root}/{name}"
            if digests.setdefault(name, digest) != digest or exists(fs, there) and hashlib.sha256(read_bytes(fs, there)).hexdigest() != digest:
                self.abort(messages)
                raise FileExistsError(f"{name} is there with other bytes")
        for name, staged, _ in self._entries(messages):
            if not exists(fs, f"{root}/{name}"):
                fs.move(staged, f"{root}/{name}")
        if self.mirror:
            copies, to = opened(self.mirror)
            copies.create_dir(to, recursive=True)
            for name, digest in digests.items():
                if not exists(copies, f"{to}/{name}"):
                    write_verified(copies, f"{to}/{name}", read_bytes(fs, f"{root}/{name}"))
                elif hashlib.sha256(read_bytes(copies, f"{to}/{name}")).hexdigest() != digest:
                    raise FileExistsError(f"{name} is in the mirror with other bytes")
        self.abort(messages)

    def abort(self, messages) -> None:
        """Removes what is staged; what was published stays."""
        fs, root = opened(self.uri)
        with contextlib.suppress(FileNotFoundError):
            fs.delete_file(self._going(root))
        with contextlib.suppress(FileNotFoundError):
            fs.delete_dir(f"{root}/{STAGING}/{self.batch}")


@dataclass
class File(InputPartition):
    paths: list[str]


class VerifiedReader(DataSourceReader):
    """The published files, some for each partition."""

    def __init__(self, options):
        self.uri, self.at_once = options["path"], int(options.get("filesPerPartition", "64"))

    def partitions(self) -> list[File]:
        fs, root = opened(self.uri)
        found = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.type == pafs.FileType.File)
        return [File(found[k : k + self.at_once]) for k in range(0, len(found), self.at_once)]

    def read(self, partition: File):
        fs, _ = opened(self.uri)
        for path in partition.paths:
            yield path.rpartition("/")[2], read_bytes(fs, path)


class VerifiedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "verified_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> VerifiedReader:
        return VerifiedReader(self.options)

    def writer(self, schema, overwrite: bool) -> VerifiedWriter:
        if overwrite:
            raise ValueError("verified files are appended, never replaced")
        return VerifiedWriter(self.options)


class Transaction:
    """Tables that change together or not at all.

    Every put() writes a new version beside the others; leaving the block without an error publishes one small file that
    names all current versions, by a move that replaces it in one step.  After an error the new versions are removed and
    readers go on with the old file.  Archives and other append-only output stay outside.
    """

    def __init__(self, spark, root: str):
        self.spark, self.root, self.fresh = spark, root.rstrip("/"), {}

    def __enter__(self) -> Transaction:
        self.fresh = {}
        return self

    def current(self) -> dict[str, str]:
        fs, root = opened(self.root)
        return json.loads(read_bytes(fs, f"{root}/current.json")) if exists(fs, f"{root}/current.json") else {}

    def get(self, name: str):
        """The table as it was last published, or None."""
        version = self.current().get(name)
        return self.spark.read.parquet(f"{self.root}/{name}/{version}") if version else None

    def put(self, name: str, df) -> None:
        version = uuid.uuid4().hex
        self.fresh[checked_name(name)] = version
        df.write.parquet(f"{self.root}/{name}/{version}")

    def __exit__(self, kind, error, trace) -> None:
        fs, root = opened(self.root)
        if kind is None:
            new = f"{root}/current.{uuid.uuid4().hex}"
            fs.create_dir(root, recursive=True)
            write_verified(fs, new, json.dumps(self.current() | self.fresh, sort_keys=True).encode())
            fs.move(new, f"{root}/current.json")
            return
        for name, version in self.fresh.items():
            with contextlib.suppress(FileNotFoundError):
                fs.delete_dir(f"{root}/{name}/{version}")
