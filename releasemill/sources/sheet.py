"""Task-side helper: rows of the first worksheet of an .xlsx file."""

from __future__ import annotations

import contextlib
import functools
import io
import itertools
import math
import posixpath
import re
import struct
import xml.etree.ElementTree as ET
import zipfile
import zlib
from datetime import datetime, timedelta
from xml.parsers import expat

from releasemill.model import SHEET_NULLS
from releasemill.sources import sheetblocks

# --- fixed values of the OOXML format ----------------------------------------
REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
BUILTIN_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
EPOCH_1900 = datetime(1899, 12, 30)
EPOCH_1904 = datetime(1904, 1, 1)

DATE_LETTERS = re.compile(r"[dmyhs]", re.IGNORECASE)
FORMAT_LITERALS = re.compile(r'"[^"]*"|\\.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)
CELL_REF = re.compile(r"([A-Z]+)(\d+)")

# Sheets as the usual programs write them: rows that hold nothing but cells of one value
# each, without prefixes, comments or sections.  Any other is read as a tree.
CHUNK = 2 << 20
# Of a longer piece the cells are taken all at once, of others row by row.
BLOCK_BYTES = 64 << 10
LONGEST_ROW_BYTES = 16 << 20
PIECE_ROWS = 8192
ROW_END = b"</row>"
ROW_START = re.compile(rb"[<:]row[\s/>]")
ROW_OPEN = re.compile(r'\s*<row((?: [\w:]+="[^"<>&]*")*) ?(/?)>')
ROW_NUMBER = re.compile(r' r="([^"]*)"')
CELL = re.compile(
    r'<c(?: r="([A-Z]+)[0-9]+")?(?: s="([0-9]+)")?(?: t="([A-Za-z]+)")?'
    r'(?:/>|(><v>|><is><t(?: xml:space="preserve")?>)([^<]*)</[vt]>(?:</is>)?</c>)'
)
# How often `<` occurs in a cell, by what precedes its value.
CELL_TAGS = {"": 1, "><v>": 4, "><is><t>": 6, '><is><t xml:space="preserve">': 6}
CHARSET = re.compile(rb"""\s*<\?xml[^>]*?encoding=["']([^"']*)["']""")
REFERENCE = re.compile("&(?:(amp|lt|gt|quot|apos)|#([0-9]+)|#x([0-9a-fA-F]+));")
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
NULL_TEXTS = frozenset(SHEET_NULLS)
MISSING = NULL_TEXTS | {None}


class SheetError(Exception):
    """A workbook is not what it should be."""


class _Unusual(Exception):
    """A sheet is not of the usual form, or is broken: only the tree tells."""


# What the ZIP and XML libraries raise on such workbooks.
LIBRARY_ERRORS = (
    zipfile.BadZipFile, zlib.error, struct.error, EOFError, ET.ParseError, RuntimeError, NotImplementedError, ValueError,
)


@contextlib.contextmanager
def library():
    """For calls of these libraries alone."""
    try:
        yield
    except LIBRARY_ERRORS as error:
        raise SheetError(f"{type(error).__name__}: {error}") from error


def _nodes(body):
    """Elements of a part in the order of their ends."""
    found = ET.iterparse(body)
    while True:
        try:
            _, node = next(found)
        except StopIteration:
            return
        except LIBRARY_ERRORS as error:
            raise SheetError(f"{type(error).__name__}: {error}") from error
        yield node


def _whole(text) -> int:
    try:
        return int(text)
    except (TypeError, ValueError):
        raise SheetError(f"{text!r} is no whole number") from None


def _local(node) -> str:
    return node.tag.rpartition("}")[2]


def _named(node, name):
    return [child for child in node.iter() if _local(child) == name]


def _inline_text(node) -> str:
    """Text of a string item; phonetic runs do not count."""
    parts = []
    for child in node:
        if _local(child) == "t":
            parts.append(child.text or "")
        elif _local(child) == "r":
            parts += [t.text or "" for t in child if _local(t) == "t"]
    return "".join(parts)


@functools.lru_cache(maxsize=20_000)
def _column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - 64
    return number - 1


class Workbook:
    """First worksheet of an .xlsx; every cell comes out as text or None."""

    def __init__(self, data: bytes):
        with library():
            self._zip = zipfile.ZipFile(io.BytesIO(data))
        self._names = set(self._zip.namelist())
        book = self._tree("xl/workbook.xml")
        properties = _named(book, "workbookPr")
        self._epoch = (
            EPOCH_1904
            if properties and properties[0].get("date1904") in ("1", "true")
            else EPOCH_1900
        )
        targets = {link.get("Id"): link.get("Target") for link in self._tree("xl/_rels/workbook.xml.rels")}
        sheets = _named(book, "sheet")
        target = targets.get(sheets[0].get(REL_ID)) if sheets else None
        if target is None:
            raise SheetError("the workbook names no sheet")
        self._sheet = posixpath.join("/xl", target)[1:]
        self._strings = self._read_strings() if "xl/sharedStrings.xml" in self._names else []
        self._dates = self._read_date_styles() if "xl/styles.xml" in self._names else set()

    def _open(self, name):
        if name not in self._names:
            raise SheetError(f"there is no part {name!r}")
        with library():
            return self._zip.open(name)

    def _tree(self, name):
        with self._open(name) as body, library():
            return ET.fromstring(body.read())

    def _read_strings(self):
        strings = []
        with self._open("xl/sharedStrings.xml") as body:
            for node in _nodes(body):
                if _local(node) == "si":
                    strings.append(_inline_text(node))
                    node.clear()
        return strings

    def _read_date_styles(self):
        styles = self._tree("xl/styles.xml")
        custom = {
            _whole(fmt.get("numFmtId")): FORMAT_LITERALS.sub("", fmt.get("formatCode", ""))
            for fmt in _named(styles, "numFmt")
        }
        dates = set()
        for group in _named(styles, "cellXfs"):
            for index, style in enumerate(group):
                code = _whole(style.get("numFmtId", 0))
                if code in custom:
                    is_date = bool(DATE_LETTERS.search(custom[code]))
                else:
                    is_date = code in BUILTIN_DATE_FORMATS
                if is_date:
                    dates.add(index)
        return dates

    def _cell_text(self, cell):
        value = None
        for child in cell:
            if _local(child) == "v":
                value = child.text
            elif _local(child) == "is":
                value = _inline_text(child)
        return self._value_text(cell.get("t", "n"), value, cell.get("s", 0))

    def _value_text(self, kind, value, style):
        if value is None or kind == "e":
            return None
        if kind == "s":
            place = _whole(value)
            if not 0 <= place < len(self._strings):
                raise SheetError(f"there is no string {place}")
            value = self._strings[place]
        elif kind == "b":
            value = "True" if value == "1" else "False"
        elif kind == "n":
            value = self._number_text(value, _whole(style))
        return None if value in NULL_TEXTS else value

    def _number_text(self, value, style):
        try:
            number = float(value)
        except ValueError:
            raise SheetError(f"{value!r} is no number") from None
        if not math.isfinite(number):
            raise SheetError(f"{value!r} is no number")
        if style in self._dates:
            try:
                moment = self._epoch + timedelta(microseconds=round(number * 86_400_000_000))
            except OverflowError:
                raise SheetError(f"{value!r} is no date") from None
            return moment.isoformat(sep=" ")
        # Whole numbers carry no fraction, whatever the other cells hold.
        return str(int(number)) if number == int(number) else repr(number)

    def rows(self):
        """(row number, {column number: text}) for every row with a cell."""
        for piece in self.pieces():
            yield from piece.rows() if isinstance(piece, sheetblocks.Block) else piece

    def pieces(self):
        """The rows in order: lists of them and, of long usual sheets, blocks.  The first row is in a list."""
        seen = 0
        try:
            for piece in self._usual_pieces():
                seen += len(piece)
                yield piece
            return
        except _Unusual:
            pass
        rows = itertools.islice(self._tree_rows(), seen, None)
        while piece := list(itertools.islice(rows, PIECE_ROWS)):
            yield piece

    def _usual_pieces(self):
        """The rows of `_tree_rows` up to the first that is not of the usual form.

        The parser only proves the sheet well-formed; patterns take the cells.
        """
        parser = expat.ParserCreate(namespace_separator="}")
        reader = sheetblocks.Reader(self._strings, self._number_text, SheetError)
        held, row_number, begun, header = b"", -1, False, True

        def prove(data, last=False):
            try:
                parser.Parse(data, last)
            except expat.ExpatError as error:
                raise _Unusual from error

        with self._open(self._sheet) as body:
            while True:
                try:
                    with library():
                        data = body.read(CHUNK)
                except SheetError as error:
                    raise _Unusual from error
                held += data
                if data and len(held) > LONGEST_ROW_BYTES:
                    raise _Unusual
                pieces = []
                if not begun:
                    start = ROW_START.search(held)
                    if start is None and data:
                        continue
                    head = held[: start.start()] if start else held
                    charset = CHARSET.match(head)
                    if any(odd in head for odd in (b"<!", b"\xef\xbb\xbf", b"\0")):
                        raise _Unusual
                    if charset and charset[1].lower() != b"utf-8":
                        raise _Unusual
                    prove(head)
                    held, begun = held[len(head):], True
                first = held.find(ROW_END) + len(ROW_END)
                if header and first >= len(ROW_END):
                    pieces, held = [held[:first]], held[first:]
                end = held.rfind(ROW_END) + len(ROW_END)
                if end >= len(ROW_END):
                    pieces, held = [held[:end], *pieces], held[end:]
                while pieces:
                    piece = pieces.pop()
                    # In text a line end of any kind is a line feed.
                    if b"\r" in piece:
                        piece = piece.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
                    if len(piece) >= BLOCK_BYTES and not header:
                        block = reader.block(piece, row_number, prove)
                        if block is not None:
                            row_number = int(block.numbers[-1])
                            yield block
                            continue
                        cut = piece.find(ROW_END, len(piece) // 2) + len(ROW_END)
                        if cut < len(piece):
                            pieces += [piece[cut:], piece[:cut]]
                            continue
                    prove(piece)
                    header = False
                    try:
                        texts = piece.decode().split(ROW_END.decode())[:-1]
                    except UnicodeDecodeError as error:
                        raise _Unusual from error
                    rows = []
                    for text in texts:
                        rows += self._usual_cells(text, row_number)
                        row_number = rows[-1][0]
                    yield rows
                if not data:
                    if b"<!" in held or ROW_START.search(held):
                        raise _Unusual
                    prove(held, True)
                    return

    def _usual_cells(self, text, row_number):
        """The row that ends with `text`, after any without content before it."""
        closed, at = "/", 0
        while closed:
            opened = ROW_OPEN.match(text, at)
            if opened is None:
                raise _Unusual
            attributes, closed = opened.groups()
            number = ROW_NUMBER.search(attributes)
            row_number = _whole(number[1]) - 1 if number else row_number + 1
            at = opened.end()
            if closed:
                yield row_number, {}
        cells, column, tags = {}, -1, 0
        for letters, style, kind, mark, value in CELL.findall(text, at):
            column = _column_number(letters) if letters else column + 1
            tags += CELL_TAGS[mark]
            if "&" in value:
                value = REFERENCE.sub(_referred, value)
            if kind == "inlineStr" or kind == "str":
                cells[column] = value
            elif value:
                cells[column] = self._value_text(kind or "n", value, style or 0)
            elif mark and mark != "><v>":
                raise _Unusual
            else:
                cells[column] = None
        if tags != text.count("<", at):
            raise _Unusual
        yield row_number, {c: value for c, value in cells.items() if value not in MISSING}

    def _tree_rows(self):
        row_number = -1
        with self._open(self._sheet) as body:
            for node in _nodes(body):
                if _local(node) != "row":
                    continue
                row_number = _whole(node.get("r", row_number + 2)) - 1
                cells, column = {}, -1
                for cell in node:
                    ref = CELL_REF.fullmatch(cell.get("r", ""))
                    column = _column_number(ref.group(1)) if ref else column + 1
                    cells[column] = self._cell_text(cell)
                node.clear()
                yield row_number, {c: text for c, text in cells.items() if text is not None}


def _referred(reference) -> str:
    name, decimal, hexadecimal = reference.groups()
    return ENTITIES[name] if name else chr(int(decimal) if decimal else int(hexadecimal, 16))


def _header_names(cells, width):
    """Blank headers get a positional name, repeated ones a number."""
    names, seen = [], {}
    for column in range(width):
        name = cells.get(column) or f"Unnamed: {column}"
        repeats = seen.get(name, 0)
        seen[name] = repeats + 1
        names.append(f"{name}.{repeats}" if repeats else name)
    return names


def records(data: bytes):
    """One dict per row under the header; an empty cell has no key.

    Rows keep their place: a blank row between two others is an empty dict.
    """
    for part in parts(data):
        yield from part.dicts() if isinstance(part, sheetblocks.Records) else part


def parts(data: bytes):
    """The same records in order: iterables of dicts and, of long usual sheets, `Records`."""
    pieces = Workbook(data).pieces()
    rows = next(pieces, [])
    first, header = rows[0] if rows else (0, {})
    if first:  # the header row is blank, so names are positional
        header = {}
    else:
        rows = rows[1:]
    names = _header_names(header, max(header, default=-1) + 1)
    expected = 1
    for piece in itertools.chain([rows], pieces):
        if isinstance(piece, sheetblocks.Block):
            part = piece.records(names, expected)
            if part is not None:
                expected = part.expected
                yield part
                continue
            piece = piece.rows()
        part, expected = _dicts(piece, names, expected)
        yield part


def _dicts(rows, names, expected):
    """Records of the rows, with the blank ones before each, and the row expected next."""
    parts = []
    for number, cells in rows:
        if not cells:
            continue
        blank = range(number - expected)
        expected = number + 1
        parts.append(({} for _ in blank))
        parts.append((
            {
                names[column] if column < len(names) else f"Unnamed: {column}": cells[column]
                for column in sorted(cells)
            },
        ))
    return itertools.chain.from_iterable(parts), expected
