"""Task-side helpers: list a ZIP directory, read single entries by offset."""

from __future__ import annotations

import contextlib
import lzma
import struct
import zipfile
import zlib

import pyarrow as pa

from releasemill.sources.storage import ImpossibleSeek

CHUNK = 1 << 20
# What says that an archive is not what it should be.  Storage failures and mistakes of
# the code are neither.
FORMAT_ERRORS = (zipfile.BadZipFile, zlib.error, ImpossibleSeek)
# What the ZIP library raises on such archives.
LIBRARY_ERRORS = (
    EOFError, RuntimeError, NotImplementedError, ValueError, struct.error, lzma.LZMAError, zlib.error, ImpossibleSeek,
)
LOCAL_HEADER = "<4s5H3I2H"
LOCAL_HEADER_SIZE = 30
STORED, DEFLATED = 0, 8
ENCRYPTED = 1


@contextlib.contextmanager
def library():
    """For calls of the ZIP library alone: its many errors become the one for bad archives."""
    try:
        yield
    except pa.ArrowException:  # some are values errors too; they come from storage
        raise
    except LIBRARY_ERRORS as error:
        raise zipfile.BadZipFile(f"{type(error).__name__}: {error}") from error
    except OSError as error:
        if error.errno is None:  # bzip2 data
            raise zipfile.BadZipFile(str(error)) from error
        raise


def copy(body, out) -> None:
    """The bytes of an entry that the ZIP library opened."""
    while True:
        with library():
            data = body.read(CHUNK)
        if not data:
            return
        out.write(data)


def entry_kind(name: str) -> str | None:
    """Case-sensitive suffix decides; anything else is ignored."""
    if name.endswith(".zip"):
        return "zip"
    if name.endswith(".xml"):
        return "xml"
    if name.endswith((".xls", ".xlsx")):
        return "excel"
    return None


def list_directory(stream, parent=None, base=0, ord_base=0):
    """Entries of one ZIP in directory order, as dicts of ENTRY_STRUCT."""
    with library():
        zf = zipfile.ZipFile(stream)
    with zf:
        for pos, info in enumerate(zf.infolist()):
            kind = entry_kind(info.filename)
            if parent is not None and kind == "zip":
                kind = None  # one level of nesting only
            yield {
                "entry": info.filename,
                "parent": parent,
                "entry_ord": ord_base + pos,
                "kind": kind,
                "size": info.file_size,
                "packed": info.compress_size,
                "offset": base + info.header_offset,
                "method": info.compress_type,
                "flags": info.flag_bits,
                "crc": info.CRC,
            }


# The outer position fills the high half, the position inside a nested
# archive the low half, so one number orders all entries of an archive.
def outer_ord(position: int) -> int:
    return position << 32


def data_offset(stream, offset: int) -> int:
    stream.seek(offset)
    head = stream.read(LOCAL_HEADER_SIZE)
    if len(head) < LOCAL_HEADER_SIZE or head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("bad local header")
    fields = struct.unpack(LOCAL_HEADER, head)
    return offset + LOCAL_HEADER_SIZE + fields[9] + fields[10]


def inflate(stream, start: int, packed: int, method: int):
    """Bytes of one packed run, in chunks of bounded size."""
    stream.seek(start)
    left = packed
    if method == STORED:
        while left:
            data = stream.read(min(CHUNK, left))
            if not data:
                raise zipfile.BadZipFile("truncated entry")
            left -= len(data)
            yield data
        return
    if method != DEFLATED:
        raise zipfile.BadZipFile(f"compression method {method}")
    unpack = zlib.decompressobj(-15)
    while left and not unpack.eof:
        data = stream.read(min(CHUNK, left))
        if not data:
            raise zipfile.BadZipFile("truncated entry")
        left -= len(data)
        while data:
            yield unpack.decompress(data, 4 * CHUNK)
            data = unpack.unconsumed_tail
    yield unpack.flush()
    if not unpack.eof:
        raise zipfile.BadZipFile("truncated deflate stream")


def checked(chunks, entry):
    """Pass chunks through; fail at the end when size or checksum is off."""
    crc = size = 0
    for data in chunks:
        crc = zlib.crc32(data, crc)
        size += len(data)
        yield data
    if crc != entry["crc"] or size != entry["size"]:
        raise zipfile.BadZipFile(f"bad checksum for {entry['entry']}")


class ArchiveReader:
    """Reads the entries of one archive by the offsets in the manifest."""

    def __init__(self, stream):
        self._stream = stream

    def chunks(self, entry):
        if entry["flags"] & ENCRYPTED:
            raise zipfile.BadZipFile(f"{entry['entry']} is encrypted")
        if entry["method"] not in (STORED, DEFLATED):
            return self._by_library(entry)
        start = data_offset(self._stream, entry["offset"])
        return checked(inflate(self._stream, start, entry["packed"], entry["method"]), entry)

    def read(self, entry) -> bytes:
        return b"".join(self.chunks(entry))

    def _by_library(self, entry):
        # Rare methods (bzip2, lzma): let zipfile unpack this one entry.
        with library():
            zf = zipfile.ZipFile(self._stream)
        with zf:
            found = [i for i in zf.infolist() if i.header_offset == entry["offset"]]
            if not found:
                raise zipfile.BadZipFile(f"compression method {entry['method']}")
            with library():
                body = zf.open(found[0])
            with body:
                while True:
                    with library():
                        data = body.read(CHUNK)
                    if not data:
                        return
                    yield data
