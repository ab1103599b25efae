"""Token counts of texts, each distinct pre-token counted once.

A text's tokens are the sum over its pre-tokens.  Tasks turn documents into
pre-token frequencies; the pieces of each distinct pre-token are counted once and
joined to the frequencies.  Pre-tokens that a sample shows to be frequent are joined
from a table of bounded size inside the tasks, all others by a shuffle join.  No
token ids are kept.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from releasemill.llm.frames import nullable, slices
from releasemill.workspace import materialise

# Rows from which frequent pre-tokens are taken, and how many are kept; any choice
# gives the same counts.
SAMPLE_ROWS = 20_000
FREQUENT = 100_000

# Pre-tokens of a long text handled at once.
AT_ONCE = 1 << 18
# Rows that a task hands on at once.
ROWS_AT_ONCE = 20_000

# Characters on whose class every Unicode version agrees; texts with others are split by the
# library's own pre-tokenizer.
AGREED = (
    "\u0000-\u024f\u0391-\u03a1\u03a3-\u03c9\u0410-\u044f\u2010-\u2027\u20ac"
    "\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
)
UNSURE = regex.compile(f"[^{AGREED}]")


class Splitter:
    """Pre-tokens of texts as a byte-level tokenizer file asks for.

    Strings of its added tokens are cut out first, as the library does by default,
    and are pre-tokens of their own.
    """

    def __init__(self, specification: str, pattern: str):
        parts = json.loads(specification)
        pre = parts["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True):
            raise ValueError("only byte-level tokenizers with the usual pattern are supported")
        if pre.get("add_prefix_space") or parts.get("normalizer"):
            raise ValueError("a prefix space or normaliser would make counts depend on context")
        added = parts.get("added_tokens", [])
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take neighbouring characters are not supported")
        self.added = frozenset(t["content"] for t in added)
        self.pattern = regex.compile(pattern)
        longest = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.specification, self.own = specification, None

    def split(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens, in lists of bounded length."""
        segments = [text]
        if self.special and any(token in text for token in self.added):
            segments = self.special.split(text)
        for segment in segments:
            if segment in self.added:
                yield [segment]
            elif UNSURE.search(segment):
                yield self.by_library(segment)
            elif len(segment) <= AT_ONCE:
                yield self.pattern.findall(segment)
            else:
                part = []
                for match in self.pattern.finditer(segment):
                    part.append(match.group())
                    if len(part) == AT_ONCE:
                        yield part
                        part = []
                yield part

    def by_library(self, text: str) -> list[str]:
        if self.own is None:
            self.own = tokenizer(self.specification)
        return [text[a:b] for _, (a, b) in self.own.pre_tokenizer.pre_tokenize_str(text)]

    def __getstate__(self):
        return self.__dict__ | {"own": None}


def tokenizer(specification: str) -> Tokenizer:
    # Spark runs as many tasks as there are cores; threads of the library would only add memory.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_str(specification)
    library.no_truncation()
    library.no_padding()
    return library


def piece_counts(library: Tokenizer, tokens: list[str]) -> list[int]:
    """Pieces of each pre-token, by the library."""
    return [
        len(coded)
        for start in range(0, len(tokens), 4096)
        for coded in library.encode_batch_fast(tokens[start : start + 4096], add_special_tokens=False)
    ]


def _frequent(texts: DataFrame, splitter: Splitter, limit: int) -> list[str]:
    """The pre-tokens that occur most often in a sample of rows."""
    rows = texts.count()
    if not rows:
        return []
    sample = texts.sample(fraction=min(1.0, SAMPLE_ROWS / rows), seed=7)

    def run(batches):
        for batch in slices(batches):
            found: Counter[str] = Counter()
            for text in batch.column("__text").to_pylist():
                for tokens in splitter.split(text or ""):
                    found.update(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())],
                names=["term", "n"],
            )

    top = (
        sample.select("__text").mapInArrow(run, "term string, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).where("n > 1")
        .orderBy(F.desc("n"), "term").limit(limit)
    )
    return [row.term for row in top.collect()]


def token_counts(docs: DataFrame, specification: str, pattern: str, limit: int,
                 id_column: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """`id, n_bytes, n_tokens, over_limit` of every row.

    Null counts as empty: no bytes, no tokens.  Repeated rows all come back, an
    empty table gives none.  `specification` is the tokenizer file's content.
    """
    splitter = Splitter(specification, pattern)
    source = docs.select(F.col(f"`{id_column}`").alias("__id"), F.col(text).cast("string").alias("__text"))
    head = _frequent(source, splitter, frequent)
    known = dict(zip(head, piece_counts(tokenizer(specification), head)))
    shared = docs.sparkSession.sparkContext.broadcast(known)

    schema = (
        nullable(source.select("__id").schema).add("row", "long").add("n_bytes", "long").add("n_known", "long")
        .add("term", "string").add("frequency", "long")
    )

    def run(batches):
        counts = shared.value
        row = TaskContext.get().partitionId() << 33

        def others(owner, terms, often, kind):
            """A row for each pre-token of a document that is not known."""
            none = pa.nulls(len(terms), pa.int64())
            columns = [
                pa.nulls(len(terms), kind), pa.array(owner, pa.int64()), none, none,
                pa.array(terms, pa.string()), pa.array(often, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in slices(batches):
            ids = batch.column("__id")
            sizes, sums, owner, terms, often = [], [], [], [], []
            for number, text in enumerate(batch.column("__text")):
                text = text.as_py() or ""
                found: Counter[str] = Counter()
                for tokens in splitter.split(text):
                    found.update(tokens)
                total = 0
                for term, n in found.items():
                    pieces = counts.get(term)
                    if pieces is None:
                        owner.append(row + number)
                        terms.append(term)
                        often.append(n)
                    else:
                        total += pieces * n
                sizes.append(len(text.encode()))
                sums.append(total)
                if len(terms) > ROWS_AT_ONCE:
                    yield others(owner, terms, often, ids.type)
                    owner, terms, often = [], [], []
            yield others(owner, terms, often, ids.type)
            none = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(range(row, row + len(ids)), pa.int64()),
                    pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                    none.cast(pa.string()), none.cast(pa.int64()),
                ],
                names=schema.names,
            )
            row += len(ids)

    split = materialise(source.mapInArrow(run, schema), "pretokens")
    rare = split.where("term is not null").select("row", "term", "frequency")

    def count(batches):
        library = None
        for batch in slices(batches, 4096):
            library = library or tokenizer(specification)
            terms = batch.column("term")
            pieces = pa.array(piece_counts(library, terms.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([terms, pieces], names=["term", "pieces"])

    pieces = rare.select("term").distinct().mapInArrow(count, "term string, pieces long")
    sums = (
        rare.join(pieces, "term")
        .groupBy("row").agg(F.sum(F.col("frequency") * F.col("pieces")).alias("n_rare"))
    )
    n_tokens = F.col("n_known") + F.coalesce("n_rare", F.lit(0))
    return (
        split.where("term is null").select("__id", "row", "n_bytes", "n_known")
        .join(sums, "row", "left")
        .select(
            F.col("__id").alias(id_column), "n_bytes", n_tokens.alias("n_tokens"),
            (n_tokens > limit).alias("over_limit"),
        )
    )
