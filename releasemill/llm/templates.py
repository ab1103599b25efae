"""Benchmark decontamination by templates.

Words become template words: numbers, quantities, names and units turn into typed
placeholders whose values are kept as slots.  Windows of template words of the
documents are hash-joined with those of the benchmark.  A document holds an item if
nearby windows cover enough of the item and equal slot values of the item meet equal
values in the document, so a question with other numbers or names is found as well.
Names are told by their case, so texts are also compared in a second form without
names, all words in lower case; either form may find an item.  An item too short for
windows in that form is searched as the whole sequence of its words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from releasemill.llm.frames import row_key, slices, utf8, without
from releasemill.workspace import materialise

WINDOW = 5
SIMILARITY = 0.8
AGREEMENT = 0.9

# Bits of the filter that documents' windows must pass before they are shuffled.
FILTER_BITS = 1 << 24
# Words that a task remembers.
MEMORY = 400_000

# Unit names.
UNITS = frozenset(
    "mg kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes"
    " mm cm dm km metre metres meter meters kilometre kilometres kilometer kilometers inch inches"
    " foot feet yard yards mile miles ml cl dl litre litres liter liters gallon gallons pint pints"
    " second seconds minute minutes hour hours day days week weeks month months year years"
    " sec secs min mins hr hrs percent degree degrees celsius fahrenheit kelvin volt volts watt watts"
    " kw kwh mw ghz mhz khz hz kb mb gb tb byte bytes bit bits dollar dollars euro euros cent cents"
    " usd eur gbp mph kmh kph joule joules newton newtons pascal".split()
)
SHORT_UNITS = frozenset("m g l s h v w k c f b n j t".split())  # only right behind a number
NUMBER = re.compile(r"[+\-−]?[$€£¥]?\d[\d.,:/]*(?P<unit>[^\W\d_]*|%|°[cf]?)[$€£¥]?", re.I)
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
SIGNED = re.compile(r"[+\-−]?[$€£¥]?\d")
UNIT_BYTES = frozenset(unit.encode() for unit in UNITS)
ASCII_EDGES = bytes(b for b in range(128) if not chr(b).isalnum())
TEXT_EDGES = ASCII_EDGES.decode()

SKIPPED, NUM, QTY, NAME, UNIT = 0, 1, 2, 3, 4
PLACEHOLDERS = {NUM: "<number>", QTY: "<quantity>", NAME: "<name>", UNIT: "<unit>"}
_LARGE = 1 << 8  # hashes of plain words are above all codes
_MARK = np.uint64(1 << 9)  # of the plain code of a word that its case makes a name
# Forms of a text: names as placeholders, no names, each word as it is in lower case.
NAMED, PLAIN, WHOLE = 0, 1, 2
_BASE = np.uint64(0x9E3779B97F4A7C15)


def template_word(word: bytes) -> tuple[int, str]:
    """Code of a word and its text: placeholder codes, 0 for bare punctuation, else a hash."""
    text = word.decode("utf-8", "replace")
    number = SIGNED.search(text)
    if number and not text[: number.start()].strip("([{\"'“‘"):
        core = text[number.start() :].rstrip(".,;:!?)]}\"'”’")
        found = NUMBER.fullmatch(core)
        if found:
            unit = found["unit"].lower()
            if not unit:
                return NUM, core
            if unit in UNITS or unit in SHORT_UNITS or unit[0] in "%°":
                return QTY, core
    core = EDGES.sub("", text)
    if not core:
        return SKIPPED, ""
    if core[0].isupper() and not core.isupper() or len(core) == 1 and core.isupper() and core != "I":
        return NAME, core
    lowered = core.lower()
    if lowered in UNITS:
        return UNIT, lowered
    return _hashed(lowered), lowered


def _hashed(lowered: str | bytes) -> int:
    return (xxhash.xxh64_intdigest(lowered) | _LARGE) & ~int(_MARK)


def _plain_word(word: bytes) -> tuple[int, str]:
    """As `template_word`, but never a name."""
    code, text = template_word(word)
    if code == NAME:
        text = text.lower()
        code = UNIT if text in UNITS else _hashed(text)
    return code, text


def _marked_code(word: bytes) -> int:
    """Plain code of a word, marked where its case makes it a name."""
    core = word.strip(ASCII_EDGES)
    if core.isalpha() and core.isascii():
        # The common case of `template_word`: no digits, and edges as they are there.
        lowered = core.lower()
        code = UNIT if lowered in UNIT_BYTES else _hashed(lowered)
        upper = core.isupper()
        name = core[:1].isupper() and not upper or len(core) == 1 and upper and core != b"I"
        return code | int(_MARK) if name else code
    core = word.decode("utf-8", "replace").strip(TEXT_EDGES)
    if core.isalpha():
        # So are other letters; what is no letter goes the long way.
        lowered = core.lower()
        code = UNIT if lowered in UNITS else _hashed(lowered)
        upper = core.isupper()
        name = core[0].isupper() and not upper or len(core) == 1 and upper
        return code | int(_MARK) if name else code
    code, text = template_word(word)
    if code != NAME:
        return code
    text = text.lower()
    return (UNIT if text in UNITS else _hashed(text)) | int(_MARK)


class Words(dict):
    """Marked codes of words, remembered."""

    def __init__(self):
        super().__init__()
        self.literal: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        code = self[word] = _marked_code(word)
        return code

    def whole(self, word: bytes) -> int:
        """Hash of a word as it is in lower case."""
        code = self.literal.get(word)
        if code is None:
            if len(self.literal) >= MEMORY:
                self.literal.clear()
            code = self.literal[word] = _hashed(_plain_word(word)[1].lower())
        return code


class Template:
    """Template words of a text in one form, with the places of the words they stand for.

    `like`, a template of the same text, saves coding its words again.
    """

    def __init__(self, text: bytes | None, known: Words, form: int = NAMED, like: Template | None = None):
        self.form = form
        if like is None:
            self.words = (text or b"").split()
            self.marked = np.fromiter(map(known.__getitem__, self.words), dtype=np.uint64, count=len(self.words))
        else:
            self.words, self.marked = like.words, like.marked
        place = np.flatnonzero(self.marked)
        codes = self.marked[place]
        if form == NAMED:
            codes = np.where(codes & _MARK, np.uint64(NAME), codes)
        else:
            codes = codes & ~_MARK
        if form == WHOLE:
            for k in np.flatnonzero(codes < _LARGE).tolist():
                codes[k] = known.whole(self.words[place[k]])
        # A unit behind a number makes it a quantity; names in a row are one.
        if len(codes) > 1:
            before = np.concatenate([[SKIPPED], codes[:-1]])
            unit = (codes == UNIT) & (before == NUM)
            codes[np.flatnonzero(unit) - 1] = QTY
            first = ~(unit | (codes == NAME) & (before == NAME))
            codes, self.first = codes[first], place[first]
            ends = np.flatnonzero(first)[1:] - 1
            self.last = place[np.append(ends, len(place) - 1)]
        else:
            self.first = self.last = place
        self.codes = codes

    def hashes(self, size: int = WINDOW) -> np.ndarray:
        """A hash of the window at each place."""
        count = len(self.codes) - size + 1
        if count <= 0 or not size:
            return np.empty(0, dtype=np.uint64)
        total = np.full(count, self.form, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                total = total * _BASE + self.codes[k : k + count]
            return total ^ (total >> np.uint64(29))

    def window(self, at: int, size: int = WINDOW) -> tuple[str, list[str]]:
        """Template text and slots (type and value, of placeholders only) of a window."""
        parts, slots = [], []
        for k in range(at, at + size):
            words = self.words[self.first[k] : self.last[k] + 1]
            code = int(self.codes[k])
            if code < _LARGE:
                parts.append(PLACEHOLDERS[code])
                slots.append(" ".join(filter(None, (template_word(w)[1] for w in words))).lower())
            else:
                parts.append(_plain_word(words[0])[1].lower())
        return " ".join(parts), slots


def _forms(text: bytes | None, known: Words, lengths: list[int] | None):
    """(template, size of its windows) for each way to cut a text into windows.

    `lengths` are those of the whole sequences to look for; None stands for an item,
    which is a whole sequence itself if it is too short for other windows.
    """
    named = Template(text, known)
    plain = Template(text, known, PLAIN, named)
    if len(named.codes) >= WINDOW:
        yield named, WINDOW
    if len(plain.codes) >= WINDOW:
        yield plain, WINDOW
    if lengths or lengths is None and len(plain.codes) < WINDOW:
        whole = Template(text, known, WHOLE, named)
        for size in [len(whole.codes)] if lengths is None else lengths:
            yield whole, size


_FIELDS = "form int, window long, length long, template string, places array<int>, slots array<array<string>>"


def windows(frame: DataFrame, text: str, passes: bytes | None = None, lengths: list[int] | None = None) -> DataFrame:
    """`frame` without `text`, with a row for each different window of template words in each form.

    `places` tells where the window stands, `slots` its values at each place.  With
    `passes`, a bit set, only windows whose hash has its bit, and `lengths` are the
    sizes of whole sequences.  `length` is the number of windows of the text, of a
    whole sequence that of its words.
    """
    kept = [c for c in frame.columns if c != text]
    schema = frame.sparkSession.createDataFrame([], _FIELDS).schema
    whole = frame.select(*kept).schema
    for field in schema:
        whole = whole.add(field)

    def run(batches):
        known = Words()
        bits = None if passes is None else np.frombuffer(passes, dtype=np.uint8)
        for batch in slices(batches):
            row, kind, hashed, length, texts, places, slots = [], [], [], [], [], [], []
            for number, value in enumerate(batch.column(text).to_pylist()):
                for template, size in _forms(value, known, lengths):
                    hashes = template.hashes(size)
                    if bits is None:
                        found = range(len(hashes))
                    else:
                        bit = hashes & np.uint64(len(bits) * 8 - 1)
                        held = (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
                        found = np.flatnonzero(held).tolist()
                    own: dict[str, tuple[int, list, list]] = {}
                    for place in found:
                        spoken, values = template.window(place, size)
                        _, at, said = own.setdefault(spoken, (int(hashes[place].view(np.int64)), [], []))
                        at.append(place)
                        said.append(values)
                    for spoken, (code, at, said) in own.items():
                        row.append(number)
                        kind.append(template.form)
                        hashed.append(code)
                        length.append(size if template.form == WHOLE else len(hashes))
                        texts.append(spoken)
                        places.append(at)
                        slots.append(said)
            chosen = batch.select(kept).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *chosen.columns, pa.array(kind, pa.int32()), pa.array(hashed, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(texts, pa.string()),
                    pa.array(places, pa.list_(pa.int32())), pa.array(slots, pa.list_(pa.list_(pa.string()))),
                ],
                names=whole.names,
            )

    return frame.mapInArrow(run, whole)


def _bit_set(benchmark_windows: DataFrame) -> bytes:
    """Filter of the benchmark's window hashes; its size is fixed, more windows only fill it."""
    bit = F.col("window").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("bit")
    places = benchmark_windows.select(bit).distinct().toPandas()["bit"].to_numpy()
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    np.bitwise_or.at(bits, places >> 3, (1 << (places & 7)).astype(np.uint8))
    return bits.tobytes()


# --- regions --------------------------------------------------------------------------


def _codes(values: list[list[str]], known: dict[str, int]) -> np.ndarray:
    """`places x slots` numbers of slot values."""
    return np.array([[known.setdefault(v, len(known)) for v in line] for line in values], dtype=np.int64)


def aligned(region: list[dict], windows: int, drift: int) -> tuple[float, float]:
    """Share of an item's windows, and of its slots, that one alignment of a region explains.

    `region` holds each window's places and slots in document and item.  A window that
    an item repeats meets each of its places, so all shifts are weighed: by their
    windows and by the slots that follow one value for each value of the item.  Windows
    count within `drift` of the best shift, and each place of the item is matched once,
    at the shift nearest to it.
    """
    known: dict[str, int] = {}
    shifts, of, pairs = [], [], []
    for number, window in enumerate(region):
        at, item_at = np.array(window["places"]), np.array(window["item_places"])
        value, item_value = _codes(window["slots"], known), _codes(window["item_slots"], known)
        shift = at[:, None] - item_at[None, :]
        p, q = np.divmod(np.arange(shift.size), len(item_at))
        shifts.append(shift.ravel())
        of.append(np.stack([np.full(shift.size, number), item_at[q]], axis=1))
        pairs.append((item_value[q], value[p]))
    shift, of = np.concatenate(shifts), np.concatenate(of)
    places, place = np.unique(shift, return_inverse=True)
    votes = np.bincount(place)
    # Slots of all matches: (match, value of the item, value of the document).
    edges = np.cumsum([0, *map(len, shifts)])
    match = np.concatenate([np.repeat(np.arange(a, a + len(i)), i.shape[1]) for a, (i, _) in zip(edges, pairs)])
    item_value, value = (np.concatenate([part[side].ravel() for part in pairs]) for side in (0, 1))
    most, _ = _following(place[match], item_value, value, len(places))
    best = places[np.argmax(votes + most)]  # the smallest of equal shifts
    away = np.abs(shift - best)
    near = away <= drift
    covered = len(np.unique(of[near, 0]))
    order = np.lexsort((shift, away))
    order = order[near[order]]
    _, first = np.unique(of[order, 1], return_index=True)
    chosen = np.zeros(len(shift), dtype=bool)
    chosen[order[first]] = True
    own = chosen[match]
    most, every = _following(np.zeros(own.sum(), dtype=np.int64), item_value[own], value[own], 1)
    return covered / windows, float(most[0] / every[0]) if every[0] else 1.0


def _following(group: np.ndarray, item_value: np.ndarray, value: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group: slots that follow the most frequent value for their item's value, and all slots."""
    every = np.bincount(group, minlength=groups)
    if not len(group):
        return np.zeros(groups), every
    kinds = int(max(item_value.max(), value.max())) + 1
    triples, count = np.unique((group * kinds + item_value) * kinds + value, return_counts=True)
    pairs = triples // kinds
    starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    return np.bincount(pairs[starts] // kinds, np.maximum.reduceat(count, starts), groups), every


def _judged(regions: DataFrame, names: list[str]) -> DataFrame:
    """`names`, `similarity`, `slot_agreement` of each region."""
    schema = regions.select(*names).schema.add("similarity", "double").add("slot_agreement", "double")

    def run(batches):
        for batch in slices(batches, 64):
            rows = batch.select(["region_windows", "windows", "span"]).to_pylist()
            found = [aligned(r["region_windows"], r["windows"], _drift(r["span"])) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array([f[0] for f in found], pa.float64()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=schema.names,
            )

    return regions.mapInArrow(run, schema)


def _drift(span):
    """How far a copy's windows may be from its alignment: the item's length, small items excepted."""
    return max(span, 2 * WINDOW)


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str], similarity: float = SIMILARITY,
                 agreement: float = AGREEMENT, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """`keep` columns, `item_id`, `similarity`, `slot_agreement` of each document and item it holds.

    similarity is the share of the item's distinct windows found near each other in
    the document and must reach `similarity`; slot_agreement is the share of its slots
    that follow one value for each value of the item, each place of the item matched once,
    and must reach `agreement`.  An item is held by one row, whatever other rows share its
    `keep` columns; what rows equal in them hold is told once.  Both are of the better
    form of the texts.  An item of fewer than five template words without names is held
    where its words follow each other, numbers as they are, case aside.  Items without
    words (null, empty) are in nothing.

    Equal windows of a text are one row with their places, so a window that a document
    and an item repeat meets once.
    """
    items = materialise(
        windows(
            benchmark.select(F.col(f"`{item_id}`").alias("__item"), utf8(item_text).alias("__text")),
            "__text",
        ),
        "items",
    )
    lengths = sorted(r["length"] for r in items.where(F.col("form") == WHOLE).select("length").distinct().collect())
    sizes = items.groupBy(F.col("__item").alias("__of"), F.col("form").alias("__form")).agg(
        F.count_distinct("template").alias("windows"), F.max("length").alias("span")
    )
    items = materialise(
        items.join(sizes, F.col("__item").eqNullSafe(F.col("__of")) & (F.col("form") == F.col("__form")))
        .select("__item", "form", "window", "template", F.col("places").alias("item_places"),
                F.col("slots").alias("item_slots"), "windows", "span"),
        "items",
    )
    source = docs.select(
        *[F.col(f"`{c}`") for c in keep], row_key(f"`{text}`").alias("__row"), utf8(text).alias("__text")
    )
    found = windows(source, "__text", _bit_set(items), lengths).drop("length")
    met = materialise(found.join(items, ["form", "window", "template"]), "matches")
    # A document is cut into regions three drifts wide; they overlap by half, so that a
    # passage half as long again as its item lies whole in one.
    width = 3 * F.greatest(F.col("span"), F.lit(2 * WINDOW))
    regions = F.concat(
        F.transform("places", lambda p: 2 * F.floor(p / width)),
        F.transform("places", lambda p: 2 * F.floor(p / width + 0.5) + 1),
    )
    group = [*keep, "__row", "__item", "form"]
    covered = materialise(
        met.select(*group, "windows", "template", F.explode(F.array_distinct(regions)).alias("region"))
        .groupBy(*group, "windows", "region").agg(F.count_distinct("template").alias("covered"))
        .where(F.col("covered") >= F.lit(similarity) * F.col("windows"))
        .select(*[F.col(c).alias(f"__of_{c}") for c in group], "region"),
        "covered",
    )
    start = F.when(F.col("region") % 2 == 0, F.col("region") / 2).otherwise((F.col("region") - 1) / 2 - 0.5) * width
    inside = F.filter(
        F.arrays_zip("places", "slots"), lambda w: (w["places"] >= start) & (w["places"] < start + width)
    )
    same = [met[c].eqNullSafe(covered[f"__of_{c}"]) for c in group]
    own = F.struct(
        "template", F.col("inside.places").alias("places"), F.col("inside.slots").alias("slots"),
        "item_places", "item_slots",
    )
    # A region holds no more windows than it is wide.
    whole = (
        met.join(covered, same).withColumn("inside", inside).where(F.size("inside") > 0)
        .groupBy(*group, "region", "windows", "span").agg(F.collect_set(own).alias("region_windows"))
    )
    judged = _judged(whole, [*keep, "__item"])
    return (
        judged.where((F.col("similarity") >= similarity) & (F.col("slot_agreement") >= agreement))
        .groupBy(*keep, "__item")
        .agg(F.max("similarity").alias("similarity"), F.max("slot_agreement").alias("slot_agreement"))
        .withColumnRenamed("__item", item_id)
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, all columns as they are."""
    keyed = docs.withColumn("__key", row_key())
    hits = contaminated(keyed, benchmark, ["doc_id", "__key"])
    return without(keyed, hits, ["doc_id", "__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
