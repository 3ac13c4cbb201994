"""Quality of documents by a linear-chain conditional random field over their lines.

Every line is good or bad.  Its score comes from the line and its neighbours: pairs of successive byte classes, the
classes of the line before and after, word and line repetition, lengths and place.  The chain adds scores of successive
labels.  Forward and backward sums give each line's probability of being good, and their mean, weighted by length, is
the document's quality.  For learning, the lines of a document have the label of the document, and every document
weighs the same.

Learning uses a bounded sample (``PER_LABEL`` documents of each label, drawn by a hash of the key).  Its texts are
written once; each evaluation of the likelihood and its gradient is one Spark job over them, and only the sums, as many
as the model has weights, reach the driver, where L-BFGS chooses the next weights.  Scores go by pairs of bytes and
by line, so nothing of the size lines x features is ever held.

Defined results: a null text is the empty text, which is one empty line and gets the score of such a line; without
labelled rows every score is 0.5.  Texts are read whole, whatever their length.  Labels other than 0 and 1 and labels
without a document are not used; a document that is labelled twice counts twice.  Repeated and null keys are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, slices, text_of

#: Bound of the sample: documents of each label.
PER_LABEL = 1500
#: Strength of the squared penalty on weights, and evaluations of the likelihood.
PENALTY, EVALUATIONS = 1e-4, 30
_SLICE = 1 << 20

# Classes of bytes: lower case, upper case, digit, space, the marks . , ! ?, quotes and hyphen, brackets, bar,
# signs, other marks, bytes of letters beyond ASCII, controls, and the end of a line.
_LOWER, _UPPER, _DIGIT, _SPACE, _QUOTE, _BRACKET, _BAR, _SIGN, _MARK, _WIDE, _CONTROL, _END = (
    0, 1, 2, 3, 8, 9, 10, 11, 12, 13, 14, 15)
_CLASS = np.full(256, _CONTROL, np.uint8)
for _bytes, _kind in ((range(97, 123), _LOWER), (range(65, 91), _UPPER), (range(48, 58), _DIGIT), (b" \t", _SPACE),
                      (b".", 4), (b",", 5), (b"!", 6), (b"?", 7), (b"'\"-`", _QUOTE), (b"()[]{}<>", _BRACKET),
                      (b"|", _BAR), (b"#$%&*", _SIGN), (b":;/\\=+_~^@", _MARK), (range(128, 256), _WIDE),
                      (b"\n", _END)):
    _CLASS[list(_bytes)] = _kind
_KINDS = 16
#: Layout of the weights: pairs, classes before, classes after, single features, transitions (00, 01, 10, 11).
_PAIRS, _BEFORE, _AFTER_ = slice(0, 256), slice(256, 272), slice(272, 288)
_SINGLE = ("bias", "length", "words", "word_length", "repeated_words", "distinct_words", "as_before", "seen", "empty",
           "first", "last", "repeated_before", "repeated_after", "distinct_before", "distinct_after")
_SINGLES = slice(288, 288 + len(_SINGLE))
_CHAIN = slice(_SINGLES.stop, _SINGLES.stop + 4)
SIZE = _CHAIN.stop
#: Shares of pairs and classes are small numbers; this brings them to the scale of the others.
_SHARE = 4.0
_POWERS = np.random.default_rng(11).integers(1, 1 << 63, 1024, dtype=np.uint64) | np.uint64(1)


def _logadd(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


@dataclass
class Lines:
    """Lines of some texts, each ended by one newline byte: what their scores need."""

    code: np.ndarray            # pair of classes from each byte on, but from no line's end
    pair_line: np.ndarray       # line of each pair
    kind: np.ndarray            # class of each byte
    line: np.ndarray            # line of each byte
    size: np.ndarray            # bytes of each line with its end
    doc: np.ndarray             # text of each line
    start: np.ndarray           # first line of each text
    count: np.ndarray           # lines of each text
    single: np.ndarray          # lines x single features

    def shifted(self, values: np.ndarray, by: int) -> np.ndarray:
        """The value of the line before (1) or after (-1) in the same text, else 0."""
        out = np.zeros_like(values)
        if by > 0:
            out[1:] = values[:-1]
            out[self.start] = 0
        else:
            out[:-1] = values[1:]
            out[self.start + self.count - 1] = 0
        return out


def lines_of(texts: pa.Array) -> Lines:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ended = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    n = len(ended)
    offsets = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset:ended.offset + n + 1]
    data = np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    size = ends - starts + 1
    line = np.repeat(np.arange(len(ends), dtype=np.int32), size)
    doc = np.searchsorted(offsets[1:] - offsets[0], ends, side="right")
    count = np.bincount(doc, minlength=n)
    start = np.cumsum(count) - count
    kind = _CLASS[data]
    begins = np.flatnonzero(data[:-1] != 10)
    code = kind[begins] * np.uint8(_KINDS) + kind[begins + 1]

    # words: runs of bytes other than white space; hashes by byte and place
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    place = np.arange(len(data)) - np.repeat(starts, size)
    mixed = (data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 1023]
    line_hash = np.add.reduceat(mixed, starts)
    words = np.bincount(line[first], minlength=len(ends)).astype(np.float64)
    repeated, distinct = np.zeros(len(ends)), np.ones(len(ends))
    if len(first):
        reach = np.diff(np.append(first, len(data)))
        place = np.arange(first[0], len(data)) - np.repeat(first, reach)
        mixed = np.where(inside[first[0]:], (data[first[0]:].astype(np.uint64) + np.uint64(1)) * _POWERS[place & 1023], 0)
        word = np.add.reduceat(mixed, first - first[0])
        own = line[first]
        same = (word[1:] == word[:-1]) & (own[1:] == own[:-1])
        repeated = np.bincount(own[1:][same], minlength=len(ends)) / np.maximum(words, 1)
        key = np.sort((word >> np.uint64(24)) | (own.astype(np.uint64) << np.uint64(40)))
        fresh = np.append(True, key[1:] != key[:-1])
        distinct = np.where(words > 0, np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(ends))
                            / np.maximum(words, 1), 1.0)
    order = np.lexsort((line_hash, doc))
    same = (line_hash[order][1:] == line_hash[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    seen = np.zeros(len(ends))
    seen[order[1:][same]] = 1.0
    blank = (size == 1).astype(float)
    out = Lines(code, line[begins], kind, line, size, doc, start, count, np.empty((len(ends), len(_SINGLE))))
    hashes = line_hash.view(np.int64)
    as_before = ((out.shifted(hashes, 1) == hashes) & (np.arange(len(ends)) != start[doc])).astype(float)
    is_first, is_last = np.zeros(len(ends)), np.zeros(len(ends))
    is_first[start], is_last[start + count - 1] = 1.0, 1.0
    length = np.log1p(size - 1.0) / 4
    for k, column in enumerate((
            np.ones(len(ends)), length, np.log1p(words) / 3, (size - 1.0 - words) / np.maximum(words, 1) / 10, repeated,
            1 - distinct, as_before, seen * (1 - blank), blank, is_first, is_last, out.shifted(repeated, 1),
            out.shifted(repeated, -1), out.shifted(1 - distinct, 1), out.shifted(1 - distinct, -1))):
        out.single[:, k] = np.minimum(column, 4.0)
    return out


def emissions(x: Lines, w: np.ndarray) -> np.ndarray:
    """Log-odds of good over bad of every line by itself."""
    n = len(x.size)
    share = _SHARE / x.size
    own = np.bincount(x.pair_line, weights=w[_PAIRS][x.code], minlength=n) * share
    before = np.bincount(x.line, weights=w[_BEFORE][x.kind], minlength=n) * share
    after = np.bincount(x.line, weights=w[_AFTER_][x.kind], minlength=n) * share
    return own + x.shifted(before, 1) + x.shifted(after, -1) + x.single @ w[_SINGLES]


def emission_gradient(x: Lines, g: np.ndarray) -> np.ndarray:
    """Gradient by the weights of the emissions, for a gradient by each line's emission."""
    out = np.zeros(SIZE)
    share = _SHARE / x.size
    out[_PAIRS] = np.bincount(x.code, weights=(g * share)[x.pair_line], minlength=256)
    out[_BEFORE] = np.bincount(x.kind, weights=(x.shifted(g, -1) * share)[x.line], minlength=_KINDS)
    out[_AFTER_] = np.bincount(x.kind, weights=(x.shifted(g, 1) * share)[x.line], minlength=_KINDS)
    out[_SINGLES] = g @ x.single
    return out


def forward_backward(x: Lines, u: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-odds of the forward and of the backward sums at every line, and each text's log partition.

    All texts of the batch advance by a line together, longest first.
    """
    t00, t01, t10, t11 = chain
    order = np.argsort(-x.count, kind="stable")
    starts, counts = x.start[order], x.count[order]
    ahead, back = u.copy(), np.zeros_like(u)
    log_z = np.zeros(len(counts))               # of the bad label so far
    live = np.searchsorted(-counts, -np.arange(1, counts.max(initial=0) + 1), side="right")     # texts with so many lines
    for t in range(1, len(live)):
        at = starts[:live[t]] + t
        before = ahead[at - 1]
        bad = _logadd(before + t10, t00)
        log_z[:live[t]] += bad
        ahead[at] += _logadd(before + t11, t01) - bad
    for t in range(len(live) - 1, 0, -1):
        at = starts[:live[t]] + t
        after = u[at] + back[at]
        back[at - 1] = _logadd(after + t11, t10) - _logadd(after + t01, t00)
    log_z += _logadd(ahead[starts + counts - 1], 0.0)
    out = np.empty_like(log_z)
    out[order] = log_z
    return ahead, back, out


def loss(x: Lines, good: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum over texts of the negative log-likelihood a line of their labels, and its gradient."""
    chain, y = w[_CHAIN], good[x.doc]
    u = emissions(x, w)
    ahead, back, log_z = forward_backward(x, u, chain)
    each = 1.0 / x.count
    weight = each[x.doc]
    stay = np.where(good == 1, chain[3], chain[0])
    total = float(((log_z - (x.count - 1) * stay) * each).sum() - (weight * y * u).sum())
    grad = emission_gradient(x, weight * (1 / (1 + np.exp(-np.clip(ahead + back, -500, 500))) - y))
    later = np.flatnonzero(np.arange(len(u)) != x.start[x.doc])
    a, b = ahead[later - 1], u[later] + back[later]
    pair = np.stack([np.full(len(later), chain[0]), chain[1] + b, chain[2] + a, chain[3] + a + b])
    pair = np.exp(pair - pair.max(0))
    grad[_CHAIN] = (pair / pair.sum(0) * weight[later]).sum(1)
    own = np.bincount(good.astype(int), weights=(x.count - 1) * each, minlength=2)
    grad[_CHAIN] -= [own[0], 0, 0, own[1]]
    return total, grad


def marginals(texts: pa.Array, w: np.ndarray) -> tuple[Lines, np.ndarray]:
    """The lines of ``texts`` and each one's probability of being good."""
    x = lines_of(texts)
    ahead, back, _ = forward_backward(x, emissions(x, w), w[_CHAIN])
    return x, 1 / (1 + np.exp(-np.clip(ahead + back, -500, 500)))


def qualities(texts: pa.Array, w: np.ndarray) -> np.ndarray:
    """Mean of the lines' probabilities, weighted by their bytes with their ends."""
    x, p = marginals(texts, w)
    return np.minimum(np.bincount(x.doc, weights=p * x.size) / np.bincount(x.doc, weights=x.size), 1.0)


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, evaluations: int, memory: int = 10
             ) -> np.ndarray:
    """L-BFGS with halved steps until the value falls enough."""
    x, (value, grad) = start, f(start)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < evaluations and np.abs(grad).max() > 1e-5:
        step, scales = grad.copy(), []
        for s, y in reversed(past):
            scales.append((s @ step) / (s @ y))
            step -= scales[-1] * y
        if past:
            step *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        else:
            step /= max(1.0, np.linalg.norm(grad))
        for (s, y), scale in zip(past, reversed(scales), strict=True):
            step += (scale - (y @ step) / (s @ y)) * s
        length = 1.0
        while used < evaluations:
            tried = x - length * step
            new, new_grad = f(tried)
            used += 1
            if new <= value - 1e-4 * length * (grad @ step):
                break
            length /= 2
        else:
            break
        s, y = tried - x, new_grad - grad
        if s @ y > 1e-12:
            past = [*past, (s, y)][-memory:]
        x, value, grad = tried, new, new_grad
    return x


def _sampled(rows: DataFrame, per_label: int) -> DataFrame:
    """At most ``per_label`` rows (key, good, ..) of each label, those whose keys hash lowest.

    A first cut by the hash alone, so that neither label is sorted as a whole.
    """
    counts = {r[0]: r[1] for r in rows.groupBy("good").count().collect()}
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(11), F.coalesce(F.col("key").cast("string"), F.lit(""))), 11)
    share = F.lit(0.0)
    for good, n in counts.items():
        share = F.when(F.col("good") == good, min(1.0, 4 * per_label / n + 64 / n)).otherwise(share)
    rows = rows.withColumn("draw", draw).filter(F.col("draw") <= share * F.lit(float(1 << 53)))
    rest = [c for c in rows.columns if c not in ("key", "good", "draw")]
    rank = F.row_number().over(W.partitionBy("good").orderBy("draw", *[F.md5(c) for c in rest]))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= per_label).drop("rank", "draw")


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        per_label: int = PER_LABEL, evaluations: int = EVALUATIONS) -> np.ndarray | None:
    """Weights learned from documents with a label of 0 or 1 under the same key; None if there are none."""
    marked = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("good"))
    marked = marked.filter(F.col("key").isNotNull() & F.col("good").isin(0, 1))
    texts = docs.select(F.col(f"`{key}`").alias("key"), text_of(F.col(f"`{text}`")).alias("text"))
    # at most per_label keys of each label, so the broadcast side is bounded; a key may have any number of documents
    chosen = cut_lineage(_sampled(marked, 2 * per_label), "labels")
    sample = cut_lineage(_sampled(texts.join(F.broadcast(chosen), "key").select("key", "good", "text"), per_label)
                         .select("good", "text").repartition(8, F.xxhash64("text")), "sample")
    n = sample.count()
    if not n:
        return None

    def evaluate(w: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, grad = 0.0, np.zeros(SIZE)
            for b in slices(batches, "text", _SLICE):
                one = loss(lines_of(b.column("text")), b.column("good").to_numpy(), w)
                total, grad = total + one[0], grad + one[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SIZE + 1, dtype=np.int32)), pa.array(np.append(grad, total))],
                                             names=["cell", "part"])

        parts = sample.mapInArrow(run, "cell int, part double").groupBy("cell").agg(F.sum("part")).collect()
        out = np.zeros(SIZE + 1)
        for cell, part in parts:
            out[cell] = part
        return out[-1] / n + PENALTY / 2 * float(w @ w), out[:-1] / n + PENALTY * w

    return minimise(evaluate, np.zeros(SIZE), evaluations)


def score(df: DataFrame, weights: np.ndarray | None, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with each text's quality, 0 to 1; a column of that name, in any case, is replaced."""
    kept = [f for f in df.schema.fields if f.name.lower() != out.lower()]
    rows = df.select(*[df[f"`{f.name}`"] for f in kept])
    if weights is None:
        return rows.withColumn(out, F.lit(0.5))
    at = [f.name for f in kept].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, _SLICE):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(qualities(b.column(at), weights))],
                                             names=[*b.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))


def held_out(key: str = "doc_id") -> Column:
    """Documents kept from learning: the CRC-32 of the key as text is 1 modulo 3 (null key: as the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1
