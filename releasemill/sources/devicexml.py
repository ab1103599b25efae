"""Task-side helper: clean one XML document and yield its device records."""

from __future__ import annotations

import codecs
import re
import xml.etree.ElementTree as ET

# --- fixed values: what the cleaning step removes or escapes ----------------
ILLEGAL_CONTROLS = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
CONTROL_BYTES = bytes([*range(9), 11, 12, *range(14, 32)])
BARE_AMPERSAND = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9a-fA-F]+);)")
CHARSETS = ("utf-8", "gbk")

# The end of a chunk that may be the beginning of an entity.
OPEN_ENTITY = re.compile(r"&[#\w]*")


def decode_charset(data: bytes) -> str:
    """Strict UTF-8, then strict GBK, then UTF-8 without its bad bytes."""
    for charset in CHARSETS:
        try:
            return data.decode(charset)
        except UnicodeDecodeError:
            continue
    return data.decode("utf-8", errors="ignore")


def repair_entities(text: str) -> str:
    return BARE_AMPERSAND.sub("&amp;", text.replace("&nbsp;", " "))


def clean_text(text: str) -> str:
    return repair_entities(ILLEGAL_CONTROLS.sub("", text))


def local_name(tag: str) -> str:
    return tag.rpartition("}")[2]


def device_fields(device) -> dict[str, str]:
    """Direct children only; the leading text of each; the last duplicate wins."""
    return {
        local_name(child.tag) if "}" in child.tag else child.tag: (child.text or "").strip()
        for child in device
    }


def _without_controls(text: str, data: bytes) -> str:
    """Text decoded from `data`, searched only if those bytes hold a control.

    In both charsets a control character is always a byte of its own.
    """
    if len(data.translate(None, CONTROL_BYTES)) == len(data):
        return text
    return ILLEGAL_CONTROLS.sub("", text)


def _tree(*texts):
    parser = ET.XMLParser()
    # Text rather than bytes: a stale charset in the declaration is ignored.
    for text in texts:
        parser.feed(text)
    return parser.close()


def _fields_of(devices):
    return [fields for fields in map(device_fields, devices) if fields]


def records(data: bytes):
    """Records of a document small enough to hold.  Raises on malformed XML."""
    root = _tree(repair_entities(_without_controls(decode_charset(data), data)))
    holder = root.find("devices")
    if holder is not None:
        devices = holder.findall("device")
    else:
        devices = (
            device
            for child in root
            if local_name(child.tag) == "devices"
            for device in child
            if local_name(device.tag) == "device"
        )
    return _fields_of(devices)


def _clean_chunks(open_chunks, decoder):
    """The cleaned text of a document, piece by piece."""
    held = ""
    for data in open_chunks():
        held += _without_controls(decoder.decode(data), data)
        last = held.rfind("&")
        cut = last if last >= 0 and OPEN_ENTITY.fullmatch(held, last) else len(held)
        yield repair_entities(held[:cut])
        held = held[cut:]
    yield repair_entities(held + decoder.decode(b"", final=True))


def _stream_decoder(open_chunks):
    """Decoder factory for the first charset that fits the whole document."""
    for charset in CHARSETS:
        factory = codecs.getincrementaldecoder(charset)
        decoder = factory()
        try:
            for data in open_chunks():
                decoder.decode(data)
            decoder.decode(b"", final=True)
            return factory
        except UnicodeDecodeError:
            continue
    return lambda: codecs.getincrementaldecoder("utf-8")(errors="ignore")


def _walk(texts, on_holder):
    """Yield (holder number, device) while reading; parsed parts are dropped.

    `on_holder(number, tag)` tells whether the devices of that direct child of
    the root are wanted.
    """
    parser = ET.XMLPullParser(events=("start", "end"))
    path, number, wanted = [], -1, False

    def drain():
        nonlocal number, wanted
        for event, node in parser.read_events():
            if event == "start":
                path.append(node)
                if len(path) == 2:
                    number += 1
                    wanted = on_holder(number, node.tag)
                continue
            path.pop()
            if len(path) == 2:
                if wanted and local_name(node.tag) == "device":
                    yield node
                path[-1].remove(node)
            elif len(path) == 1:
                path[-1].remove(node)

    for text in texts:
        parser.feed(text)
        yield from drain()
    parser.close()
    yield from drain()


def stream_records(open_chunks):
    """Records of a document of any size, in bounded memory.

    Reads the document twice: the first reading proves it well-formed and finds
    the `devices` element to use, so no record of a broken document gets out.
    `open_chunks()` starts a new reading of its bytes.
    """
    factory = _stream_decoder(open_chunks)
    holders = []

    def note(number, tag):
        if tag == "devices" and "plain" not in holders:
            holders[:] = ["plain", number]
        return False

    for _ in _walk(_clean_chunks(open_chunks, factory()), note):
        pass
    plain = holders[1] if holders else None

    def choose(number, tag):
        if plain is not None:
            return number == plain
        return local_name(tag) == "devices"

    for device in _walk(_clean_chunks(open_chunks, factory()), choose):
        if plain is not None and device.tag != "device":
            continue
        fields = device_fields(device)
        if fields:
            yield fields


# --- documents large enough to be parsed by several tasks -----------------------

DEVICE_START = re.compile(r"<device[\s/>]")
DEVICE_END = "</device>"
MARKER = "cut-here"


def cut_document(open_chunks, size, limit):
    """Cleaned text of a document in segments of whole devices, about `size` long.

    Yields `(segment, None)` and at last `(None, fits)`.  With `fits`, and if
    every segment is well-formed by itself, the segments hold exactly the
    records of the document: each then starts and ends between two children of
    the element its devices are taken from.  Otherwise (a comment across a cut,
    a namespace, broken XML, a device longer than `limit`) the document has to
    be read as one stream.
    """
    texts = _clean_chunks(open_chunks, _stream_decoder(open_chunks)())
    held, head = "", None
    for text in texts:
        held += text
        if head is None:
            start = DEVICE_START.search(held)
            if start is None and len(held) <= limit:
                continue
            if start is None:
                break
            head, held = held[:start.start()], held[start.start():]
        if len(held) < size:
            continue
        end = held.rfind(DEVICE_END)
        if end >= 0:
            end += len(DEVICE_END)
            yield held[:end], None
            held = held[end:]
        elif len(held) > limit:
            break
    else:
        if head is not None:
            end = held.rfind(DEVICE_END) + len(DEVICE_END) if DEVICE_END in held else 0
            if end:
                yield held[:end], None
            yield None, _frame_fits(head, held[end:])
            return
    yield None, False


def _frame_fits(head, tail):
    """Whether devices between `head` and `tail` are the ones to take."""
    try:
        holder = _tree(head, f"<{MARKER}/>", tail).find("devices")
    except ET.ParseError:
        return False
    if holder is None or all(child.tag != MARKER for child in holder):
        return False
    return not _fields_of(holder.findall("device"))


def segment_records(segment: str):
    """Records of one segment.  Raises when it is not well-formed by itself."""
    return _fields_of(_tree("<devices>", segment, "</devices>").findall("device"))
