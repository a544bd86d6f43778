"""Files as tasks open them: local ones and those of any store that Arrow knows, a range at a time."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyarrow import fs

CHUNK = 8 << 20


def store(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path, and the path within it."""
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + re.sub(r"^(file:)?/+", "", path)
    return fs.FileSystem.from_uri(path)


def listed(path: str, suffix: str) -> Iterator[fs.FileInfo]:
    """Files below a folder, or the file itself, whose names end so; by name."""
    where, inner = store(path)
    found = where.get_file_info(inner)
    infos = [found] if found.is_file else where.get_file_info(fs.FileSelector(inner, recursive=True)) if found.type == fs.FileType.Directory else []
    yield from sorted((i for i in infos if i.is_file and i.path.endswith(suffix)), key=lambda i: i.path)


def digest(path: str) -> tuple[int, str]:
    """Bytes and SHA-256 of a file of any size."""
    where, inner = store(path)
    total, sha = 0, hashlib.sha256()
    with where.open_input_stream(inner) as f:
        while some := f.read(CHUNK):
            total += len(some)
            sha.update(some)
    return total, sha.hexdigest()


class Hashed:
    """A new file that knows its bytes and SHA-256 when it is closed; it gets its name then, so it is there whole or not at all."""

    def __init__(self, path: str, attempt: str):
        self.where, self.inner = store(path)
        self.beside = f"{self.inner}.{attempt}.part"
        self.where.create_dir(self.inner.rpartition("/")[0], recursive=True)
        self.out, self.bytes, self.sha = self.where.open_output_stream(self.beside, compression=None), 0, hashlib.sha256()

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)
        self.sha.update(data)

    def close(self) -> tuple[int, str]:
        self.out.close()
        self.where.move(self.beside, self.inner)
        return self.bytes, self.sha.hexdigest()


def small_file(path: str, content: bytes, attempt: str) -> None:
    out = Hashed(path, attempt)
    out.write(content)
    out.close()


def copied(source: str, target: str) -> bool:
    """Copies a file, if the target isn't there with as many bytes; whether it did."""
    (a, inner), (b, to) = store(source), store(target)
    found = b.get_file_info(to)
    if found.is_file and found.size == a.get_file_info(inner).size:
        return False
    out = Hashed(target, hashlib.sha256(source.encode()).hexdigest()[:12])
    with a.open_input_stream(inner) as f:
        while some := f.read(CHUNK):
            out.write(some)
    out.close()
    return True
