"""Toxicity by compression distance with two zstandard dictionaries.

One dictionary is trained on ordinary labelled texts, one on those windows of toxic
texts that recur among them and are rare in ordinary ones.  A window is a word between
blanks.  Its compressed length with either dictionary is measured in front of a
carrier that both hold, so that only the window's own cost differs.  A text's
features are the shares of windows that the toxic dictionary shortens by at least
1, 2, ... bytes; a logistic curve fitted on other labelled rows turns them into a
score with its threshold at 0.5.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from releasemill.llm.frames import extended, utf8

# Labelled rows used at most: for the dictionaries, and for the thresholds.
TOXIC_ROWS, ORDINARY_ROWS = 2000, 4000
TOXIC_CALIBRATION_ROWS, ORDINARY_CALIBRATION_ROWS = 1500, 6000

TOXIC_BYTES, ORDINARY_BYTES = 1 << 15, 110 << 10
# Share of toxic texts in which a window must occur to be learnt (two texts at least).
RECURRING = 0.005
# How many times more often in toxic than in ordinary texts, beyond chance; labels may be wrong.
TOXIC_RATIO = 5
GAINS = tuple(range(1, 9))

# Bytes that occur in no UTF-8 text in this order; both dictionaries end with them.
CARRIER = bytes(range(0xF8, 0x100)) * 1 + bytes(range(0x80, 0x90))
# Windows whose lengths a task remembers, and words of a text handled at once.
MEMORY = 300_000
AT_ONCE = 1 << 18


def _windows(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Trained dictionary; of few samples their plain text."""
    if len(samples) >= 16 and sum(map(len, samples)) >= 4096:
        try:
            return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
        except zstandard.ZstdError:  # too uniform to train on
            pass
    return b"".join(samples)[-size:]


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None = None  # of the features, the last for the constant


class Meter:
    """Bytes that the toxic dictionary saves on windows, remembered."""

    def __init__(self, model: Model):
        parameters = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0,
            write_dict_id=0, window_log=18, hash_log=17, chain_log=17, search_log=9, min_match=4,
            target_length=64, strategy=zstandard.STRATEGY_LAZY2,
        )

        def compressor(content: bytes):
            held = zstandard.ZstdCompressionDict(
                content + b" " + CARRIER + b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            return zstandard.ZstdCompressor(compression_params=parameters, dict_data=held).compress

        self.toxic, self.ordinary = compressor(model.toxic), compressor(model.ordinary)
        self.known: dict[bytes, int] = {}

    def gain(self, window: bytes) -> int:
        saved = self.known.get(window)
        if saved is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            framed = b" " + window + b" " + CARRIER
            saved = len(self.ordinary(framed)) - len(self.toxic(framed))
            self.known[window] = saved
        return saved

    def features(self, text: bytes | None) -> list[float]:
        """Square roots of the shares of windows with at least each of GAINS."""
        windows = _windows(text)
        counts = np.zeros(GAINS[-1] + 1, dtype=np.int64)
        for start in range(0, len(windows), AT_ONCE):
            part = windows[start : start + AT_ONCE]
            gains = np.fromiter(map(self.gain, part), dtype=np.int64, count=len(part))
            counts += np.bincount(np.clip(gains, 0, GAINS[-1]), minlength=len(counts))
        above = np.cumsum(counts[::-1])[::-1][GAINS[0] :]
        return np.sqrt(above / max(1, len(windows))).tolist()


def score(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = features @ weights[:-1] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_thresholds(features: np.ndarray, labels: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps, with a small penalty on scaled weights."""
    scale = np.maximum(features.std(axis=0), 1e-6)
    x = np.hstack([features / scale, np.ones((len(features), 1))])
    weights, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) - ridge @ weights
        bend = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        weights += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return np.append(weights[:-1] / scale, weights[-1])


def featured(frame: DataFrame, model: Model, text: str, name: str = "features") -> DataFrame:
    """`frame` with `text` (bytes) replaced by its features."""

    def make():
        meter = Meter(model)
        return lambda texts: [[meter.features(t) for t in texts]]

    return extended(frame, text, [(name, ArrayType(DoubleType()), pa.list_(pa.float64()))], make)


def _learnt(toxic: list[bytes | None], ordinary: list[bytes | None]) -> set[bytes]:
    """Windows that recur in toxic texts and whose document rate there is far above that in ordinary ones."""
    rows = Counter(w for text in toxic for w in set(_windows(text)))
    least = max(2, round(RECURRING * len(toxic)))
    rows = {w: count for w, count in rows.items() if count >= least}
    common = Counter(w for text in ordinary for w in set(_windows(text)) if w in rows)
    # Two standard deviations less, so that few rows prove nothing against an ordinary text.
    return {
        w for w, count in rows.items()
        if not common[w] or (count - 2 * count**0.5) * len(ordinary) >= TOXIC_RATIO * common[w] * len(toxic)
    }


def fit(docs: DataFrame, labels: DataFrame, training: Column, text: str = "text") -> Model:
    """Dictionaries and thresholds from bounded samples of the labelled rows.

    `training` is a condition on `labels` (doc_id, toxic).  Samples are the rows
    with the smallest hashes of their id.  Without toxic or without ordinary rows
    the model has no weights and scores 0.
    """
    known = labels.where(training & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    hashed = known.select(
        F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic"),
        F.xxhash64("doc_id").alias("__hash"),
    ).distinct()

    def taken(label: int, rows: int) -> DataFrame:
        return hashed.where(F.col("__toxic") == label).orderBy("__hash", "__id").limit(rows)

    def texts(part: DataFrame, seed: int) -> DataFrame:
        """Rows of the sample for the dictionaries (0) or the thresholds (1)."""
        chosen = part.where(F.pmod(F.xxhash64(F.col("__hash")), F.lit(5)).isin([3, 4] if seed else [0, 1, 2]))
        return docs.select(F.col("doc_id").alias("__doc"), utf8(text).alias("__text")).join(
            F.broadcast(chosen), F.col("__doc") == F.col("__id")
        ).select("__toxic", "__text")

    toxic = taken(1, TOXIC_ROWS + TOXIC_CALIBRATION_ROWS)
    ordinary = taken(0, ORDINARY_ROWS + ORDINARY_CALIBRATION_ROWS)
    both = toxic.unionByName(ordinary)
    # In a fixed order, as the dictionaries depend on it.
    sample = sorted(texts(both, 0).collect(), key=lambda row: (row["__toxic"], row["__text"] or b""))
    # Word lists are not kept: they take many times the text's size.
    toxic_texts = [row["__text"] for row in sample if row["__toxic"]]
    ordinary_texts = [row["__text"] for row in sample if not row["__toxic"]]
    del sample
    if not toxic_texts or not ordinary_texts:
        return Model(b"", b"")
    learnt = _learnt(toxic_texts, ordinary_texts)
    chosen = ([w for w in _windows(text) if w in learnt] for text in toxic_texts)
    toxic_samples = [b" " + b" ".join(words) + b" " for words in chosen if words]
    # A mislabelled text must not teach the words as ordinary ones.
    others = ([w for w in _windows(text) if w not in learnt] for text in ordinary_texts)
    ordinary_samples = [b" " + b" ".join(words) + b" " for words in others]
    ordinary_samples = [sample for sample in ordinary_samples if sample.strip()]

    model = Model(
        _dictionary(toxic_samples, TOXIC_BYTES), _dictionary(ordinary_samples, ORDINARY_BYTES)
    )
    held = featured(texts(both, 1), model, "__text").collect()
    if len({row["__toxic"] for row in held}) < 2:  # too few rows to keep some apart
        held = featured(texts(both, 0), model, "__text").collect()
    held.sort(key=lambda row: (row["__toxic"], row["features"]))
    features = np.array([row["features"] for row in held])
    model.weights = fit_thresholds(features, np.array([float(row["__toxic"]) for row in held]))
    return model


def scored(docs: DataFrame, model: Model, text: str, name: str = "score") -> DataFrame:
    """`docs` with `text` replaced by its score from 0 to 1; null counts as empty."""

    def make():
        meter = Meter(model)

        def compute(texts):
            if model.weights is None:
                return [[0.0] * len(texts)]
            return [score(np.array([meter.features(t) for t in texts]), model.weights).tolist()]

        return compute

    return extended(docs.withColumn(text, utf8(text)), text, [(name, "double", pa.float64())], make)


def is_held_out(doc_id: str, folds: int) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id is never held out."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == 0, F.lit(False))


def judged(docs: DataFrame, labels: DataFrame, folds: int = 5, text: str = "text") -> DataFrame:
    """`doc_id, held_out, score, predicted` of every row of `docs`.

    Rows of `labels` whose id is held out teach nothing.  Rows without a label,
    ids without a text and repeated rows are fine; empty texts get the score of no
    windows.
    """
    model = fit(docs, labels, ~is_held_out("doc_id", folds), text)
    source = docs.select("doc_id", is_held_out("doc_id", folds).alias("held_out"), F.col(text).alias("__text"))
    return scored(source, model, "__text").withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """The rows of `docs` that score below 0.5, all columns as they are."""
    model = fit(docs, labels, ~is_held_out("doc_id", folds))
    marked = scored(docs.withColumn("__text", F.col("text")), model, "__text", "__score")
    return marked.where("__score < 0.5").drop("__score")
