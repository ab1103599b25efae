"""Language-model scores by the likelihood of subword lattices.

Every way to cut a word (behind a boundary mark) into pieces of an existing
vocabulary is a path; a path's weight is the product of its pieces' probabilities.
The sum over all paths, by a forward recursion on logarithms, is the word's probability in
pieces.  The vocabulary's own scores give the first piece probabilities; expected piece
counts over the distinct training words, by forward and backward sums, the next ones.
Words of the training texts have one more path, the whole word, whose weight is its
discounted share of the training tokens; the discounts are the weight of all piece
paths.  No piece crosses a boundary mark, so a text's probability is the product over
its words and the end, and each distinct word's sum is computed once.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releasemill.llm.frames import nullable, slices, utf8
from releasemill.workspace import materialise

BOUNDARY = "▁"
ROUNDS = 2
# Taken from each training word's count, in favour of the piece paths.
DISCOUNT = 0.6
# Weight of the vocabulary's own scores against counts, in pieces.
PRIOR_PIECES = 1000.0
# Ranks turn into first weights by 1 / (rank + RANK_SHIFT).
RANK_SHIFT = 10.0

# Words joined inside tasks, from a table of this many; all others by a shuffle join.
FREQUENT = 100_000
# Distinct words that a task counts before it hands the counts on.
COUNTED_AT_ONCE = 300_000
WORDS_AT_ONCE = 8192
# Code points of words handled as one array.
POINTS_AT_ONCE = 1 << 18
PADDING = 0x110000  # no character

_BASE = np.uint64(0x9E3779B97F4A7C15)
LN10 = float(np.log(10.0))


# --- vocabulary ------------------------------------------------------------------------


@dataclass
class Vocabulary:
    """Pieces, log probabilities of pieces, of single bytes and of the end."""

    pieces: list[str]
    logs: np.ndarray  # of the pieces, then of the 256 bytes, then of the end

    @property
    def size(self) -> int:
        return len(self.pieces) + 257


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces that lower-cased words can hold, weighted by the file's own scores.

    Scores that are negative ranks, as in a BPE file, are taken by Zipf's law;
    other scores are log probabilities.
    """
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores = [], []
    for k in range(library.get_piece_size()):
        if library.is_control(k) or library.is_unknown(k) or library.is_unused(k) or library.is_byte(k):
            continue
        piece = library.id_to_piece(k)
        if piece.lower() != piece or BOUNDARY in piece[1:]:
            continue
        pieces.append(piece)
        scores.append(library.get_score(k))
    scores = np.array(scores, dtype=np.float64)
    if len(scores) and (scores == np.round(scores)).all() and len(set(scores)) > len(scores) // 2:
        logs = -np.log(RANK_SHIFT - scores)
    else:
        logs = scores
    least = logs.min() if len(logs) else 0.0
    logs = np.concatenate([logs, np.full(256, least - 1.0), [least]])
    top = logs.max()
    return Vocabulary(pieces, logs - top - np.log(np.exp(logs - top).sum()))


@dataclass
class Arcs:
    """The arcs of one length: places by words."""

    length: int
    entry: np.ndarray  # -1: none, -2: bytes
    weight: np.ndarray
    live: list[bool]  # places where some word has one


class Lattice:
    """Sums over the segmentations of many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.logs, self.first_byte = vocabulary.logs, len(vocabulary.pieces)
        self.size = vocabulary.size
        # For each length the hashes of what pieces begin with, and the piece that this is (-1: none).
        beginnings: dict[int, dict[str, int]] = {}
        for k, piece in enumerate(vocabulary.pieces):
            for length in range(1, len(piece)):
                beginnings.setdefault(length, {}).setdefault(piece[:length], -1)
            beginnings.setdefault(len(piece), {})[piece] = k
        self.tables = []
        for length in range(1, max(beginnings, default=0) + 1):
            texts, own = list(beginnings[length]), np.array(list(beginnings[length].values()))
            points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            hashes = np.zeros(len(texts), dtype=np.uint64)
            for column in points.reshape(len(texts), length).T:
                hashes = self._longer(hashes, column)
            hashes = self._mixed(hashes)
            order = np.argsort(hashes)
            self.tables.append((hashes[order], own[order]))
        self.characters: dict[int, tuple[list[int], float]] = {}

    @staticmethod
    def _longer(hashes: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Hashes of texts that are one point longer."""
        with np.errstate(over="ignore"):
            return hashes * _BASE + (points.astype(np.uint64) + np.uint64(1))

    @staticmethod
    def _mixed(hashes: np.ndarray) -> np.ndarray:
        return hashes ^ (hashes >> np.uint64(31))

    def _character(self, point: int) -> tuple[list[int], float]:
        """Byte entries of a character that is no piece, and their log probability."""
        if point not in self.characters:
            if len(self.characters) > 100_000:
                self.characters.clear()
            own = [self.first_byte + b for b in chr(point).encode("utf-8", "surrogatepass")]
            self.characters[point] = own, float(self.logs[own].sum())
        return self.characters[point]

    def arcs(self, points: np.ndarray) -> list[Arcs]:
        """Arcs of each length that some word has; a place is followed only while a piece may go on there."""
        rows, size = points.shape
        row, place = np.nonzero(points != PADDING)
        hashes, found = np.zeros(len(row), dtype=np.uint64), []
        for length, (known, own) in enumerate(self.tables or [(np.zeros(0, np.uint64), np.zeros(0, int))], 1):
            if length > size:
                break
            inside = place + length <= size
            row, place, hashes = row[inside], place[inside], hashes[inside]
            hashes = self._longer(hashes, points[row, place + length - 1])
            entry = np.full((size - length + 1, rows), -1, dtype=np.int32)
            weight = np.full((size - length + 1, rows), -np.inf)
            at = np.minimum(np.searchsorted(known, self._mixed(hashes)), max(0, len(known) - 1))
            begins = known[at] == self._mixed(hashes) if len(known) else np.zeros(len(row), dtype=bool)
            pieces = np.full(len(row), -1, dtype=np.int64)
            pieces[begins] = own[at[begins]]
            whole = pieces >= 0
            entry[place[whole], row[whole]] = pieces[whole]
            weight[place[whole], row[whole]] = self.logs[pieces[whole]]
            if length == 1 and not whole.all():
                own_points, which = np.unique(points[row[~whole], place[~whole]], return_inverse=True)
                weights = np.array([self._character(int(p))[1] for p in own_points])
                weight[place[~whole], row[~whole]] = weights[which]
                entry[place[~whole], row[~whole]] = -2
            if whole.any() or length == 1:
                found.append(Arcs(length, entry, weight, np.isfinite(weight).any(axis=1).tolist()))
            row, place, hashes = row[begins], place[begins], hashes[begins]
            if not len(row):
                break
        return found

    def forward(self, arcs: list[Arcs], rows: int, size: int) -> np.ndarray:
        """Log of the sum over all paths from the start to each place."""
        alpha = np.full((size + 1, rows), -np.inf)
        alpha[0] = 0.0
        for end in range(1, size + 1):
            for own in arcs:
                start = end - own.length
                if start < 0:
                    break
                if own.live[start]:
                    np.logaddexp(alpha[end], alpha[start] + own.weight[start], out=alpha[end])
        return alpha

    def backward(self, arcs: list[Arcs], sizes: np.ndarray, size: int) -> np.ndarray:
        """Log of the sum over all paths from each place to the word's end."""
        beta = np.full((size + 1, len(sizes)), -np.inf)
        beta[sizes, np.arange(len(sizes))] = 0.0
        for start in range(size - 1, -1, -1):
            for own in arcs:
                if start + own.length > size:
                    break
                if own.live[start]:
                    np.logaddexp(beta[start], beta[start + own.length] + own.weight[start], out=beta[start])
        return beta

    def groups(self, words: list[bytes]):
        """Places of words of like length, their lengths, and code points behind the boundary mark, padded.

        Shorter words of one length go together, longer ones within an eighth of their length; a
        group holds at most POINTS_AT_ONCE points, or one word.
        """
        texts = [BOUNDARY + w.decode("utf-8", "replace") for w in words]
        by_length: dict[int, list[int]] = {}
        for k, text in enumerate(texts):
            step = max(1, (1 << len(text).bit_length()) >> 4)
            by_length.setdefault(-(-len(text) // step) * step, []).append(k)
        for length, places in by_length.items():
            most = max(1, POINTS_AT_ONCE // length)
            for first in range(0, len(places), most):
                own = places[first : first + most]
                sizes = np.array([len(texts[k]) for k in own])
                size = int(sizes.max())
                points = np.full((len(own), size), PADDING, dtype=np.uint32)
                joined = "".join(texts[k] for k in own).encode("utf-32-le", "surrogatepass")
                points[np.arange(size) < sizes[:, None]] = np.frombuffer(joined, dtype="<u4")
                yield np.array(own), sizes, points

    def log_sums(self, words: list[bytes]) -> np.ndarray:
        """Log probability of each word, summed over its segmentations."""
        out = np.empty(len(words))
        for places, sizes, points in self.groups(words):
            alpha = self.forward(self.arcs(points), *points.shape)
            out[places] = alpha[sizes, np.arange(len(sizes))]
        return out

    def expected(self, words: list[bytes]) -> np.ndarray:
        """Expected number of uses of each entry in these words."""
        total = np.zeros(self.size)
        for _, sizes, points in self.groups(words):
            rows, size = points.shape
            arcs = self.arcs(points)
            alpha, beta = self.forward(arcs, rows, size), self.backward(arcs, sizes, size)
            sums = alpha[sizes, np.arange(rows)]
            for own in arcs:
                place, row = np.nonzero(own.entry != -1)
                entry = own.entry[place, row]
                usage = np.exp(alpha[place, row] + own.weight[place, row] + beta[place + own.length, row] - sums[row])
                pieces = entry >= 0
                total += np.bincount(entry[pieces], usage[pieces], self.size)
                if own.length == 1 and not pieces.all():
                    rest = points[row[~pieces], place[~pieces]]
                    own_points, which = np.unique(rest, return_inverse=True)
                    for point, uses in zip(own_points.tolist(), np.bincount(which, usage[~pieces])):
                        for byte in self._character(point)[0]:
                            total[byte] += uses
        return total


# --- training --------------------------------------------------------------------------


def word_counts(source: DataFrame, text: str, training: str) -> DataFrame:
    """`word, n, c`: occurrences of every word in all rows and in training rows."""

    def run(batches):
        every: Counter[bytes] = Counter()
        taught: Counter[bytes] = Counter()

        def counted():
            words = list(every)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.binary()),
                    pa.array(map(every.__getitem__, words), pa.int64()),
                    pa.array(map(taught.__getitem__, words), pa.int64()),
                ],
                names=["word", "n", "c"],
            )
            every.clear()
            taught.clear()
            return batch

        for batch in slices(batches):
            rows = zip(batch.column(text).to_pylist(), batch.column(training).to_pylist())
            for value, teaches in rows:
                words = (value or b"").lower().split()
                every.update(words)
                if teaches:
                    taught.update(words)
            if len(every) > COUNTED_AT_ONCE:
                yield counted()
        yield counted()

    return (
        source.select(text, training).mapInArrow(run, "word binary, n long, c long")
        .groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    )


def trained(counts: DataFrame, texts: int, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Vocabulary:
    """Piece probabilities from expected counts over the distinct training words.

    `counts` is `word, c`; each word with c > 0 counts once, as the piece paths stand
    for new and rare words.  With `texts`, training texts, the end counts as one
    more word.  Only the expected counts, one for each vocabulary entry, reach the driver.
    """
    first = np.exp(vocabulary.logs)
    for _ in range(rounds):
        current = vocabulary

        def run(batches, current=current):
            lattice = Lattice(current)
            total = np.zeros(lattice.size)
            for batch in slices(batches, WORDS_AT_ONCE):
                total += lattice.expected(batch.column("word").to_pylist())
            entries = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(entries, pa.int64()), pa.array(total[entries], pa.float64())],
                names=["entry", "uses"],
            )

        uses = (
            counts.where("c > 0").select("word").mapInArrow(run, "entry long, uses double")
            .groupBy("entry").agg(F.sum("uses").alias("uses")).toPandas()
        )
        total = PRIOR_PIECES * first
        total[uses["entry"].to_numpy(dtype=np.int64)] += uses["uses"].to_numpy(dtype=np.float64)
        total[-1] += texts > 0
        vocabulary = Vocabulary(current.pieces, np.log(total / total.sum()))
    return vocabulary


# --- scores ----------------------------------------------------------------------------


def scored(docs: DataFrame, held_out: Column, vocabulary: Vocabulary, id_column: str = "doc_id",
           text: str = "text", rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """`id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score` of every row.

    Tokens are lower-cased words and one end for each text; null counts as empty
    and has the end alone.  Rows held out teach nothing.  base_score is the smoothed
    unigram log10 probability of the tokens, score the model's log10 probability of
    the text, lattice_score that of the lattice alone under the vocabulary's own scores.  Repeated rows all come back and count as often as they occur; an
    empty table gives none; without training rows the vocabulary's own scores hold.
    """
    source = docs.select(
        F.col(f"`{id_column}`").alias("__id"), held_out.alias("held_out"), (~held_out).alias("__teaches"),
        utf8(text).alias("__text"),
    )
    counts = materialise(word_counts(source, "__text", "__teaches"), "words")
    ends = source.where("__teaches").count()
    words, distinct = counts.where("c > 0").agg(F.sum("c"), F.count("*")).first()
    total, distinct = (words or 0) + ends, distinct + (ends > 0)
    model = trained(counts, ends, vocabulary, rounds)

    def whole(count, pieces):
        """log10 of the sum over the whole-word path and the piece paths (natural logs)."""
        if not total:
            return pieces / LN10
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(count - DISCOUNT, 0.0) / total)
        return np.logaddexp(own, np.log(DISCOUNT * distinct / total) + pieces) / LN10

    def sums(batches):
        lattice, plain = Lattice(model), Lattice(vocabulary)
        for batch in slices(batches, WORDS_AT_ONCE):
            often = batch.column("c").to_numpy(zero_copy_only=False)
            words = batch.column("word").to_pylist()
            values, own = whole(often, lattice.log_sums(words)), plain.log_sums(words) / LN10
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64()), pa.array(own, pa.float64())],
                names=["word", "n", "c", "sum", "plain"],
            )

    valued = materialise(counts.mapInArrow(sums, "word binary, n long, c long, sum double, plain double"), "sums")
    top = valued.orderBy(F.desc("n"), "word").limit(frequent).select("word", "c", "sum", "plain").collect()
    shared = docs.sparkSession.sparkContext.broadcast(
        {bytes(row["word"]): (row["c"], row["sum"], row["plain"]) for row in top}
    )

    def base(count):
        """Smoothed log10 probability of a token; numbers or arrays."""
        return np.log10((count + 0.1) / (total + 0.1 * (distinct + 1)))

    # Of the pieces that may follow a finished word, the end.
    opens = [k for k, piece in enumerate(model.pieces) if piece[0] == BOUNDARY]

    def end_log(logs):
        return logs[-1] - np.log(np.exp(logs[[*opens, -1]]).sum())

    end_base, end_sum = float(base(ends)), float(whole(ends, end_log(model.logs)))
    end_plain = float(end_log(vocabulary.logs) / LN10)
    schema = (
        nullable(source.select("__id", "held_out").schema).add("row", "long").add("n_tokens", "long")
        .add("known", "long").add("base", "double").add("sum", "double").add("plain", "double")
        .add("word", "binary").add("frequency", "long")
    )

    def run(batches):
        values = {w: (c > 0, float(base(c)), s, own) for w, (c, s, own) in shared.value.items()}
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            rows, owner, rest, often = [], [], [], []
            for number, value in enumerate(batch.column("__text").to_pylist()):
                tokens = (value or b"").lower().split()
                known, low, high, plain = int(ends > 0), end_base, end_sum, end_plain
                for word, n in Counter(tokens).items():
                    held = values.get(word)
                    if held is None:
                        owner.append(row + number)
                        rest.append(word)
                        often.append(n)
                    else:
                        known += n * held[0]
                        low += n * held[1]
                        high += n * held[2]
                        plain += n * held[3]
                rows.append((row + number, len(tokens) + 1, known, low, high, plain))
            row += batch.num_rows
            more = len(rest)
            ids, held = batch.column("__id"), batch.column("held_out")
            numbers, sizes, knowns, lows, highs, plains = zip(*rows)
            # A row for each document, then one for each of its less frequent words.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([ids, pa.nulls(more, ids.type)]),
                    pa.concat_arrays([held, pa.nulls(more, held.type)]),
                    pa.array([*numbers, *owner], pa.int64()),
                    pa.array([*sizes, *[None] * more], pa.int64()),
                    pa.array([*knowns, *[None] * more], pa.int64()),
                    pa.array([*lows, *[None] * more], pa.float64()),
                    pa.array([*highs, *[None] * more], pa.float64()),
                    pa.array([*plains, *[None] * more], pa.float64()),
                    pa.array([*[None] * len(rows), *rest], pa.binary()),
                    pa.array([*[None] * len(rows), *often], pa.int64()),
                ],
                names=schema.names,
            )

    split = materialise(source.drop("__teaches").mapInArrow(run, schema), "texts")
    token = F.log10((F.col("c") + 0.1) / F.lit(total + 0.1 * (distinct + 1)))
    rare = (
        split.where("word is not null").select("row", "word", "frequency")
        .join(valued.select("word", "c", F.col("sum").alias("word_sum"), F.col("plain").alias("word_plain")), "word")
        .groupBy("row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("frequency")).otherwise(0)).alias("more_known"),
            F.sum(F.col("frequency") * token).alias("more_base"),
            F.sum(F.col("frequency") * F.col("word_sum")).alias("more_sum"),
            F.sum(F.col("frequency") * F.col("word_plain")).alias("more_plain"),
        )
    )
    return (
        split.where("word is null").select("__id", "held_out", "row", "n_tokens", "known", "base", "sum", "plain")
        .join(rare, "row", "left")
        .select(
            F.col("__id").alias(id_column), "held_out", "n_tokens",
            (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
            (F.col("sum") + F.coalesce("more_sum", F.lit(0.0))).alias("score"),
            (F.col("plain") + F.coalesce("more_plain", F.lit(0.0))).alias("lattice_score"),
        )
    )
