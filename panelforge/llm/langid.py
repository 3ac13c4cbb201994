"""Language identification by a string kernel.

The kernel is the blended spectrum of presence: for each order 1 to 4, the
cosine of the sets of byte n-grams of two lower-cased texts (anything but
letters counts as a space), averaged over the orders.  N-grams are hashed into
a fixed number of places for each order.  A Nystroem map on landmark texts and
one-versus-rest ridge regression on its features give a score for each
language.  As the kernel is an inner product, landmarks and regression fold
into one matrix, and a batch of texts is scored by one matrix product an order.

Fitting uses a bounded sample (``PER_LANGUAGE``, ``LANDMARKS``): its n-gram
sets, a few kilobytes a text, are what the driver receives.  Texts are read
whole, in fitting and in prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Hash places (as powers of two) of the orders 1 to 4.
PLACES = (8, 12, 13, 13)
#: Bounds of the sample: labelled texts of each language, and landmarks in all.
PER_LANGUAGE, LANDMARKS = 400, 192
RIDGE = 0.1
#: Steepness of the softmax that turns regression scores into 0 to 1.
STEEPNESS = 4.0
UNKNOWN = "und"

_STARTS = np.cumsum([0, *(1 << p for p in PLACES)])
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def presence(texts: pa.Array) -> np.ndarray:
    """texts x places: 1 where the text has an n-gram of that hash (uint8)."""
    low = pc.fill_null(pc.utf8_lower(texts.cast(pa.string())), "")
    low = low.cast(pa.large_string())
    n = len(low)
    out = np.zeros((n, _STARTS[-1]), np.uint8)
    offsets = np.frombuffer(low.buffers()[1], np.int64)[low.offset:low.offset + n + 1]
    start, end = int(offsets[0]), int(offsets[-1])
    if start == end:
        return out
    flat, block = out.reshape(-1), 1 << 21
    for lo in range(start, end, block):             # a text longer than a block goes through in several
        hi = min(end, lo + block)
        data = _LETTER[np.frombuffer(low.buffers()[2], np.uint8)[lo:min(end, hi + 3)]].astype(np.uint32)
        at = np.arange(lo, lo + len(data))
        doc = np.searchsorted(offsets, at, side="right") - 1
        stop, row = offsets[doc + 1], doc * _STARTS[-1]
        code = np.zeros(len(data), np.uint32)
        for k, bits in enumerate(PLACES):
            size = min(hi - lo, len(data) - k)
            if size <= 0:
                break
            code = (code[:len(data) - k] << np.uint32(8)) | data[k:]
            place = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits) if k else code
            good = at[:size] + k < stop[:size]
            flat[(row[:size] + _STARTS[k] + place[:size])[good]] = 1
    return out


def scaled(sets: np.ndarray) -> np.ndarray:
    """Presence as kernel features: unit length for each order, and over all orders together."""
    out = sets.astype(np.float32)
    for a, b in zip(_STARTS, _STARTS[1:], strict=False):
        norm = np.sqrt(out[:, a:b].sum(1, keepdims=True) * len(PLACES))
        np.divide(out[:, a:b], norm, out=out[:, a:b], where=norm > 0)
    return out


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray         # places x languages
    bias: np.ndarray

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language and its share (softmax), by matrix products over 128 texts at a time."""
        best, share = [], []
        for i in range(0, len(texts), 128):
            raw = scaled(presence(texts.slice(i, 128))) @ self.weights + self.bias
            p = np.exp(STEEPNESS * (raw - raw.max(1, keepdims=True)))
            p /= p.sum(1, keepdims=True)
            best.append(p.argmax(1))
            share.append(p.max(1))
        return np.concatenate(best), np.concatenate(share)


def solve(sets: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem features on landmarks (as many of each language as there is room for), then ridge regression."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(languages))])
    x = scaled(sets)
    z = x[chosen]
    value, vector = np.linalg.eigh((z @ z.T).astype(np.float64))
    keep = value > 1e-6 * max(value.max(), 1e-12)
    root = vector[:, keep] / np.sqrt(value[keep])
    phi = (x @ z.T).astype(np.float64) @ root
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # every language weighs the same, however many texts it has
    weight = (1.0 / np.bincount(y, minlength=len(languages)))[y][:, None] * len(y) / len(languages)
    mean, bias = (phi * weight).mean(0), (target * weight).mean(0)
    centred = phi - mean
    beta = np.linalg.solve(centred.T @ (centred * weight) + ridge * np.eye(phi.shape[1]),
                           centred.T @ ((target - bias) * weight))
    return Model(tuple(languages), (z.T @ (root @ beta)).astype(np.float32), (bias - mean @ beta).astype(np.float32))


def fit(df: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
        per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit on at most ``per_language`` texts of each label, those whose key hashes lowest.  None: no labelled text.

    Rows without a label, text or letter are not used.
    """
    rows = df.filter(F.col(label).isNotNull() & has_letter(F.col(text)))
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return None
    # a first cut by the hash alone, so that no language's texts are sorted as a whole
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 4 * per_language / n + 64 / n)))])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(7), F.coalesce(F.col(key).cast("string"), F.lit(""))), 11)
    rows = rows.select(F.col(label).alias("label"), F.col(text).alias("text"), draw.alias("draw"))
    rows = rows.filter(F.col("draw") <= share[F.col("label")] * F.lit(float(1 << 53)))
    rank = F.row_number().over(W.partitionBy("label").orderBy("draw", F.md5("text")))
    rows = rows.withColumn("rank", rank).filter(F.col("rank") <= per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            for part in (b.slice(i, 64) for i in range(0, b.num_rows, 64)):
                packed = np.packbits(presence(part.column("text")), axis=1)
                yield pa.RecordBatch.from_arrays([part.column("label"), part.column("rank"),
                                                  pa.array([p.tobytes() for p in packed], pa.binary())],
                                                 names=["label", "rank", "bits"])

    got = sorted((r["label"], r["rank"], bytes(r["bits"])) for r in rows.select("label", "rank", "text").mapInArrow(
        run, "label string, rank int, bits binary").collect())
    if not got:
        return None
    sets = np.unpackbits(np.frombuffer(b"".join(x[2] for x in got), np.uint8).reshape(len(got), -1), axis=1)
    return solve(sets[:, :_STARTS[-1]], [x[0] for x in got])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(df: DataFrame, model: Model | None, text: str = "text", pred: str = "lang_pred", score: str = "score"
            ) -> DataFrame:
    """``df`` with the predicted language and its score (0 to 1).

    Null texts and texts without a letter get ``und`` and 0, as do all texts without a model.  Columns of ``df``
    named as the new ones, in any case, are replaced.
    """
    if model is None:
        return df.drop(pred, score).withColumns({pred: F.lit(UNKNOWN), score: F.lit(0.0)})
    held = df.sparkSession.sparkContext.broadcast(model)    # places x languages, whatever the input
    kept = [f for f in df.schema.fields if f.name.lower() not in (pred.lower(), score.lower())]
    names = np.array(model.languages, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            best, share = held.value.scores(b.column(text))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(names[best], pa.string()), pa.array(share.astype(np.float64))],
                names=[*b.schema.names, pred, score])

    out = df.select(*[df[f"`{f.name}`"] for f in kept]).mapInArrow(
        run, T.StructType([*kept, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]))
    known = has_letter(F.col(text))
    return out.withColumns({pred: F.when(known, F.col(pred)).otherwise(UNKNOWN),
                            score: F.when(known, F.col(score)).otherwise(0.0)})


def held_out(key: str = "doc_id") -> Column:
    """Documents kept from fitting: the CRC-32 of the key as text is 2 modulo 4 (null key: as the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2
