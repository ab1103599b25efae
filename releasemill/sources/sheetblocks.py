"""Task-side helper: many rows of a usual sheet at once, as arrays instead of a dict for each row.

Of a sheet's text only the values differ from cell to cell; the markup between two of them is
one of few runs once row numbers are taken out.  Every distinct run is matched strictly and once.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from releasemill.model import LAYOUT_SEP, SHEET_NULLS

LESS, GREATER, QUOTE, AMPERSAND = b"<>\"&"
NULL_TEXTS = pa.array(SHEET_NULLS, pa.string())
# Characters that the parser refuses.
REFUSED = (b"\xef\xbf\xbe", b"\xef\xbf\xbf")
SEEN_BYTES = 4096
BLANKS = (9, 10)
# An ampersand itself comes last, or what follows it would be taken for a reference.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
PLAIN_WHOLE = "^(0|-?[1-9][0-9]{0,14})$"

PIECES = re.compile(
    r'(?P<row><row(?P<attributes>(?: [\w:]+="[^"<>&]*")*) ?(?P<closed>/?)>)'
    r'|(?P<end></row>)'
    r'|<c(?: r="(?P<letters>[A-Z]+)[0-9]+")?(?: s="(?P<style>[0-9]+)")?(?: t="(?P<kind>[A-Za-z]+)")?'
    r'(?:/>|>(?P<opened><v>|<is><t(?: xml:space="preserve")?>)(?P<shut></v></c>|</t></is></c>)?)'
)
CLOSES = {"</v></c>": 1, "</t></is></c>": 2}
ROW_NUMBER = re.compile(r' r="([^"]*)"')
# The number of a row whose first attribute it is, taken out before.
TAKEN = ' r="0"'
# Runs known at most, columns of a layout and blank rows in one block: beyond, rows are read one by one.
KNOWN_RUNS = 20_000
LAYOUT_WORDS, WORD_BITS = 4, 62
# Text that the shared strings of a block may come to.
MOST_BYTES = 32 << 20
RAW_KINDS = ("inlineStr", "str")


class _Run:
    """What the markup between two values says."""

    __slots__ = ("begins", "opens", "rows", "rises", "column", "first", "before", "kind", "style", "lesses", "tags")

    def __init__(self):
        self.begins = self.opens = 0  # how the value before it ends, how the one after it begins
        self.rows = []  # rows begun: -1 the next one, -2 its number was taken out, else the number
        self.rises = True  # the next column counts from the one before
        self.column = 0
        self.first, self.before = -1, 0  # first column named before a row's end, cells before that
        self.kind = self.style = ""
        self.lesses = 0
        self.tags = []


def _column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _parsed(text: str, first: bool, last: bool) -> _Run | None:
    """The run between two values, `first` before all of a piece, `last` behind them; None if it is not usual."""
    run, at = _Run(), 0
    run.lesses = text.count("<")
    inside = not first
    if not first:
        for end, mode in CLOSES.items():
            if text.startswith(end):
                run.begins, at = mode, len(end)
        if not at:
            return None
    # Columns rise in a row, or cells would replace each other.
    column, named, opened = 0, -1, False
    while at < len(text):
        found = PIECES.match(text, at)
        if found is None or opened:
            return None
        at = found.end()
        if found["row"]:
            if inside:
                return None
            attributes = found["attributes"]
            number = ROW_NUMBER.search(attributes)
            if number is None:
                run.rows.append(-1)
            elif attributes.startswith(TAKEN):
                run.rows.append(-2)
            elif re.fullmatch("[1-9][0-9]{0,8}", number[1]):
                run.rows.append(int(number[1]) - 1)
            else:
                return None
            run.tags.append(f"<row{attributes}/>")
            inside = not found["closed"]
            column, named, run.rises = -1, -1, False
        elif found["end"]:
            if not inside:
                return None
            inside = False
        else:
            if not inside:
                return None
            if found["letters"]:
                at_column = _column_number(found["letters"])
                if not run.rises or named >= 0:
                    if at_column <= column:
                        return None
                elif run.first < 0:
                    run.first, run.before = at_column, column
                column = named = at_column
            else:
                column += 1
            kind = found["kind"] or "n"
            if found["opened"]:
                mode = 1 if found["opened"] == "<v>" else 2
                if found["shut"]:
                    if CLOSES[found["shut"]] != mode or mode == 2 and kind not in RAW_KINDS:
                        return None
                else:
                    run.opens, run.kind, run.style = mode, kind, found["style"] or "0"
                    opened = True
    if opened == last or inside == last:
        return None
    if run.rises and named >= 0:
        run.rises = False
    run.column = column
    return run


class Block:
    """Rows of a sheet: their numbers, and of each value the row's place, the column and the text.

    Values stand row by row with rising columns; a missing one is null.
    """

    def __init__(self, numbers, row, column, values):
        self.numbers, self.row, self.column, self.values = numbers, row, column, values

    def __len__(self):
        return len(self.numbers)

    def rows(self):
        """(row number, {column number: text}) for every row."""
        found = [(number, {}) for number in self.numbers.tolist()]
        for row, column, value in zip(self.row.tolist(), self.column.tolist(), self.values.to_pylist()):
            if value is not None:
                found[row][1][column] = value
        return found

    def records(self, names, expected):
        """`Records` under these headers from the row `expected` on; None if rows must be read one by one."""
        held = pc.is_valid(self.values).to_numpy(zero_copy_only=False)
        row, column = self.row[held], self.column[held]
        width = int(column.max(initial=-1)) + 1
        if width > LAYOUT_WORDS * WORD_BITS:
            return None
        names = [*names, *(f"Unnamed: {c}" for c in range(len(names), width))]
        if len(set(names)) < len(names):
            return None
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        full = row[starts]
        numbers = self.numbers[full]
        gaps = np.maximum(np.diff(numbers, prepend=expected - 1) - 1, 0)
        if gaps.sum() > len(self.numbers):
            return None
        # Blank rows between others are records without fields.
        place = np.arange(len(full)) + np.cumsum(gaps)
        count = int(place[-1]) + 1 if len(full) else 0
        dense = np.zeros(len(self.numbers), np.int64)
        dense[full] = place
        layouts, shape = _layouts(column, starts, names)
        shapes = np.full(count, len(layouts), np.int64)
        shapes[place] = shape
        layout = pa.array([*layouts, ""], pa.string()).take(pa.array(shapes))
        last = int(numbers[-1]) + 1 if len(full) else expected
        return Records(count, names, dense[row], column, self.values.filter(pa.array(held)), layout, last)


def _layouts(column, starts, names):
    """Distinct layouts of the rows that begin at `starts`, and the place of each row's among them."""
    if not len(starts):
        return [], np.zeros(0, np.int64)
    words = [
        np.add.reduceat(np.where(column // WORD_BITS == word, np.int64(1) << column % WORD_BITS, 0), starts)
        for word in range(int(column.max()) // WORD_BITS + 1)
    ]
    if len(words) == 1:
        _, chosen, shape = np.unique(words[0], return_index=True, return_inverse=True)
    else:
        _, chosen, shape = np.unique(np.stack(words, axis=1), axis=0, return_index=True, return_inverse=True)
    ends = np.append(starts[1:], len(column))
    layouts = [LAYOUT_SEP.join(names[c] for c in column[starts[i]:ends[i]]) for i in chosen]
    return layouts, shape.reshape(-1)


class Records:
    """Records of a block: `count` places, and of each value its place, column and text, none missing."""

    def __init__(self, count, names, place, column, values, layout, expected):
        self.count, self.names, self.place, self.column = count, names, place, column
        self.values, self.layout, self.expected = values, layout, expected

    def bytes(self) -> int:
        return self.values.nbytes

    def columns(self, known):
        """`{name: texts}` of the fields among `known`, and a map of all others."""
        order = np.argsort(self.column.astype(np.int16), kind="stable")
        ends = np.cumsum(np.bincount(self.column, minlength=len(self.names)))
        found, rest = {}, np.zeros(len(self.names), bool)
        for number, (name, start, end) in enumerate(zip(self.names, itertools.chain([0], ends), ends)):
            if name not in known:
                rest[number] = True
                continue
            if start == end:
                continue
            at = np.full(self.count, -1, np.int64)
            at[self.place[order[start:end]]] = order[start:end]
            found[name] = self.values.take(pa.array(at, mask=at < 0))
        others = rest[self.column]
        offsets = np.zeros(self.count + 1, np.int32)
        np.cumsum(np.bincount(self.place[others], minlength=self.count), out=offsets[1:])
        keys = pa.array(self.names, pa.string()).take(pa.array(self.column[others]))
        values = self.values.filter(pa.array(others))
        return found, pa.MapArray.from_arrays(pa.array(offsets), keys, values)

    def dicts(self):
        """The same as a dict for each record."""
        found = [{} for _ in range(self.count)]
        for place, column, value in zip(self.place.tolist(), self.column.tolist(), self.values.to_pylist()):
            found[place][self.names[column]] = value
        return found


def _filled(known, value):
    """`value` where `known`, elsewhere counted on by one for each step (`value` is then the step)."""
    total = np.cumsum(np.where(known, 0, value))
    last = np.maximum.accumulate(np.where(known, np.arange(len(value)), -1))
    base = np.where(known, value, 0) - total
    return total + base[last]


def _without_row_numbers(piece: bytes):
    """The piece with one digit for the row number of a cell or a row, and the numbers of rows.

    Without such numbers the piece as it is and None; if some are odd, twice None.
    """
    # A sheet names its cells and rows from the start, or most likely not at all.
    if not any(piece.find(tag, 0, SEEN_BYTES) >= 0 for tag in (b'<c r="', b'<row r="')):
        return piece, None
    buffer = np.frombuffer(piece + bytes(32), np.uint8).copy()
    opened = np.flatnonzero(buffer == LESS)
    drop = np.zeros(len(buffer), bool)
    drop[len(piece):] = True

    def starting(text):
        at = opened
        for place, byte in enumerate(text):
            if place:
                at = at[buffer[at + place] == byte]
        return at + len(text)

    def digits(at, most):
        end, number = at.copy(), np.zeros(len(at), np.int64)
        for _ in range(most):
            digit = buffer[end].astype(np.int64) - 48
            is_digit = (digit >= 0) & (digit <= 9)
            if not is_digit.any():
                break
            number = np.where(is_digit, number * 10 + digit, number)
            end = end + is_digit
        whole = (end > at) & (buffer[end] == QUOTE)
        return at[whole], end[whole], number[whole], whole

    def taken(at, end):
        buffer[at] = 48
        for step in range(1, int((end - at).max(initial=0))):
            inside = at + step
            drop[inside[inside < end]] = True

    cells = starting(b'<c r="')
    start = cells
    for _ in range(3):
        cells = cells + ((buffer[cells] >= 65) & (buffer[cells] <= 90))
    at, end, _, _ = digits(cells[cells > start], 7)
    rows, row_end, numbers, whole = digits(starting(b'<row r="'), 9)
    if not whole.all():
        return None, None
    taken(at, end)
    taken(rows, row_end)
    return buffer[~drop].tobytes(), numbers - 1


def _segments(piece: bytes):
    """Markup and values of a piece in turn, markup first and last; None if `<` and `>` stand elsewhere too."""
    buffer = np.frombuffer(piece, np.uint8)
    less, greater = buffer == LESS, buffer == GREATER
    # A value begins or ends where just one of `>` and `<` meets the other's place.
    bounds = np.flatnonzero(greater[:-1] != less[1:])
    if not less[0] or not greater[-1] or len(bounds) % 2:
        return None
    begins = greater[bounds]
    if not begins[::2].all() or begins[1::2].any():
        return None
    offsets = np.empty(len(bounds) + 2, np.int32)
    offsets[0], offsets[-1] = 0, len(piece)
    np.add(bounds, 1, out=offsets[1:-1], casting="unsafe")
    array = pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(piece)]
    )
    evens = pa.array(np.arange(0, len(offsets) - 1, 2, dtype=np.int32))
    odds = pa.array(np.arange(1, len(offsets) - 1, 2, dtype=np.int32))
    return array.take(evens), array.take(odds), int(np.count_nonzero(less)), int(np.count_nonzero(greater))


def _texts(values):
    """The values as text with its references resolved, or None if some are not usual."""
    texts = values.cast(pa.string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(data[ends[0]:ends[-1]] == AMPERSAND) + ends[0]
    if not len(at):
        return texts
    place = np.searchsorted(ends, at, side="right")
    resolved, found = np.zeros(len(at), bool), []
    for reference, text in ENTITIES:
        same = at + len(reference) <= ends[place]
        for step, byte in enumerate(reference[1:].encode(), 1):
            same &= data[np.minimum(at + step, len(data) - 1)] == byte
        if same.any():
            found.append((reference, text))
            resolved |= same
    if not resolved.all():
        return None
    referring = np.zeros(len(texts), bool)
    referring[place - 1] = True
    referring = pa.array(referring)
    replaced = texts.filter(referring)
    for reference, text in found:
        replaced = pc.replace_substring(replaced, reference, text)
    return pc.replace_with_mask(texts, referring, replaced)


class Reader:
    """Reads the pieces of one sheet.

    `strings` are the shared ones; `number_text(value, style)` gives the text of a number and
    raises `error`; `prove` gets the tags of rows, once each, and raises if they are not well-formed.
    """

    def __init__(self, strings, number_text, error):
        self._strings = pa.array(strings, pa.string())
        self._lengths = pc.binary_length(self._strings).to_numpy(zero_copy_only=False)
        self._number_text, self._error = number_text, error
        self._runs = {}

    def block(self, piece: bytes, row_number: int, prove) -> Block | None:
        """The rows of a piece that begins with a row and ends with one; None if it is not usual."""
        buffer = np.frombuffer(piece, np.uint8)
        if buffer.min() < 32:
            if np.count_nonzero(buffer < 32) != sum(np.count_nonzero(buffer == each) for each in BLANKS):
                return None
        if buffer.max() >= REFUSED[0][0] and any(each in piece for each in REFUSED):
            return None
        plain, taken = _without_row_numbers(piece)
        segments = _segments(plain) if plain else None
        if segments is None:
            return None
        markup, values, lesses, greaters = segments
        runs = self._known(markup, prove)
        if runs is None:
            return None
        codes, known = runs
        count = np.bincount(codes, minlength=len(known))
        if int(count @ [run.lesses for run in known]) != lesses or lesses != greaters:
            return None
        begins, opens = (np.array([getattr(run, name) for run in known], np.int8)[codes] for name in ("begins", "opens"))
        if (opens[:-1] != begins[1:]).any():
            return None
        placed = _row_numbers(codes, known, taken, row_number)
        if placed is None:
            return None
        numbers, row = placed
        column = _columns(codes, known, row)
        texts = self._cell_texts(codes, known, values) if column is not None else None
        if texts is None:
            return None
        missing = pc.is_in(texts, NULL_TEXTS)
        return Block(numbers, row, column, pc.if_else(missing, pa.scalar(None, pa.string()), texts))

    def _known(self, markup, prove):
        """Number of each run among the distinct ones, and these; None if one is not usual."""
        coded = markup.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).copy()
        texts = coded.dictionary.to_pylist()
        # The first and the last run have a value on one side only.
        first, last = texts[codes[0]], texts[codes[-1]]
        codes[0], codes[-1] = len(texts), len(texts) + 1
        if len(codes) == 1:
            return None
        used = np.bincount(codes, minlength=len(texts) + 2) > 0
        wanted = [(text, False, False) for text in texts] + [(first, True, False), (last, False, True)]
        if len(self._runs) > KNOWN_RUNS:
            self._runs.clear()
        known = []
        for is_used, key in zip(used.tolist(), wanted):
            if not is_used:
                known.append(_Run())
                continue
            run = self._runs.get(key)
            if run is None:
                try:
                    run = _parsed(key[0].decode(), *key[1:])
                except UnicodeDecodeError:
                    run = None
                if run is None or run.kind == "s" and not len(self._strings):
                    return None
                for tag in run.tags:
                    prove(tag)
                self._runs[key] = run
            known.append(run)
        return codes, known

    def _cell_texts(self, codes, known, values):
        """Texts of the values by their kinds, null for errors; None if one is broken or not usual."""
        try:
            texts = _texts(values)
            if texts is None:
                return None
            kinds = [(run.kind, run.style) if run.kind == "n" else (run.kind, "") for run in known]
            distinct = list(dict.fromkeys(kinds))
            if all(kind in RAW_KINDS or not kind for kind, _ in distinct):
                return texts
            of_run = np.array([distinct.index(kind) for kind in kinds])
            of_value = of_run[codes[:-1]]
            for number, (kind, style) in enumerate(distinct):
                chosen = pa.array(of_value == number)
                if kind in RAW_KINDS or not kind or not pc.any(chosen).as_py():
                    continue
                found = self._of_kind(kind, style, texts.filter(chosen))
                if found is None:
                    return None
                texts = pc.replace_with_mask(texts, chosen, found)
            return texts
        except (pa.ArrowInvalid, self._error):
            return None

    def _of_kind(self, kind, style, texts):
        if kind == "e":
            return pa.nulls(len(texts), pa.string())
        if kind == "s":
            if not pc.all(pc.match_substring_regex(texts, "^[0-9]{1,9}$")).as_py():
                return None
            places = texts.cast(pa.int64()).to_numpy()
            # One string may be in many cells.
            if places.max() >= len(self._strings) or self._lengths[places].sum() > MOST_BYTES:
                return None
            return self._strings.take(pa.array(places))
        if kind == "b":
            return pc.if_else(pc.equal(texts, "1"), "True", "False")
        if kind == "n":
            style = int(style)
            # The text of a whole number is the number, except in a style for dates.
            if self._number_text("1", style) == "1":
                other = pc.invert(pc.match_substring_regex(texts, PLAIN_WHOLE))
            else:
                other = pa.repeat(True, len(texts))
            numbers = [self._number_text(text, style) for text in texts.filter(other).to_pylist()]
            return pc.replace_with_mask(texts, other, pa.array(numbers, pa.string()))
        return texts


def _row_numbers(codes, known, taken, row_number):
    """Number of each row of the runs, and for each value the place of its row among them.

    None if the numbers taken out are not those of these rows.
    """
    begun = np.array([len(run.rows) for run in known])
    told = np.array([number for run in known for number in run.rows], np.int64)
    counts = begun[codes]
    ends = np.cumsum(counts)
    within = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    numbers = told[np.repeat((np.cumsum(begun) - begun)[codes], counts) + within]
    follows, is_taken = numbers == -1, numbers == -2
    if is_taken.sum() != (0 if taken is None else len(taken)):
        return None
    if taken is not None:
        numbers[is_taken] = taken
    numbers[follows] = 1
    numbers = np.append(row_number, numbers)
    return _filled(np.append(True, ~follows), numbers)[1:], ends[:-1] - 1


def _columns(codes, known, row):
    """Column of each value, or None if columns do not rise in a row."""
    before = codes[:-1]
    rises = np.array([run.rises for run in known])[before]
    step = np.array([run.column for run in known], np.int64)[before]
    column = _filled(~rises, step)
    same = np.append(False, row[1:] == row[:-1])
    if (same & (column <= np.append(-1, column[:-1]))).any():
        return None
    # Cells without a value must not name a column that came before.
    first = np.array([run.first for run in known], np.int64)[codes[1:]]
    passed = np.array([run.before for run in known], np.int64)[codes[1:]]
    if ((first >= 0) & (first <= column + passed)).any():
        return None
    return column
