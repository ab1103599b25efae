"""Open archive files from inside a task, by the path Spark listed."""

from __future__ import annotations

import errno
import functools
import io
import uuid
from urllib.parse import quote

import pyarrow.fs as pafs

BUFFER = 4 << 20


def resolve(path: str):
    """(filesystem, path on it) for a path as Hadoop prints it (not URL-encoded)."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        scheme = "s3"
    if scheme in ("s3", "gs"):  # objects: the bucket is part of the path
        return _filesystem(scheme, rest.lstrip("/").partition("/")[0]), rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


@functools.lru_cache(maxsize=64)
def _filesystem(scheme: str, bucket: str):
    """File system of a bucket, looked up once in a task's process."""
    return pafs.FileSystem.from_uri(f"{scheme}://{bucket}/")[0]


class ImpossibleSeek(OSError):
    """A place in a file that cannot be: its reader was misled, storage is not at fault."""


class _RawFile(io.RawIOBase):
    """Arrow file with the error Python code expects from an impossible seek."""

    def __init__(self, file):
        self._file = file

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self._file.tell()

    def seek(self, offset, whence=io.SEEK_SET):
        base = {io.SEEK_SET: 0, io.SEEK_CUR: self._file.tell(), io.SEEK_END: self._file.size()}
        target = base[whence] + offset
        if target < 0:
            raise ImpossibleSeek(errno.EINVAL, "seek before the start of the file")
        return self._file.seek(min(target, self._file.size()))

    def readinto(self, buffer):
        return self._file.readinto(buffer)

    def close(self):
        if not self.closed:
            self._file.close()
        super().close()


def open_for_read(path: str) -> io.BufferedReader:
    """Seekable reader whose buffer turns neighbouring reads into one request."""
    fs, name = resolve(path)
    return io.BufferedReader(_RawFile(fs.open_input_file(name)), BUFFER)


def publish(path: str, write) -> None:
    """Create `path` through `write(stream)`; it appears only when complete.

    A retried or speculative task rewrites the same file with the same bytes.
    """
    fs, name = resolve(path)
    folder, _, leaf = name.rpartition("/")
    fs.create_dir(folder, recursive=True)
    hidden = f"{folder}/_{uuid.uuid4().hex}.{leaf}"
    with fs.open_output_stream(hidden, buffer_size=BUFFER) as out:
        write(out)
    try:
        fs.move(hidden, name)
    except OSError:
        # Some filesystems do not replace files: another attempt was first.
        if fs.get_file_info(name).type == pafs.FileType.NotFound:
            raise
        fs.delete_file(hidden)
