"""Quality classifier: n-gram indicators scaled by log-count ratios of the classes (naive Bayes), and a
linear hinge-loss model fitted to them by dual coordinate descent."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import columns_of, id_hash_mod, read_table, stored
from cardwatch.llm.registry import query

FIT_ROWS_PER_CLASS = 3000  # labelled documents used for fitting, of each label, at most
FIT_FEATURES = 20_000_000  # features of all of these, at most; documents are taken in hash order
BITS = 18
SMOOTHING = 1.0
COST = 1.0
SWEEPS = 40
TOLERANCE = 1e-3
BLOCK_BYTES = 1 << 20  # bytes of text turned into features in one go
SEED = 13
_OVERLAP = 4  # tokens of a block that the next block of a text starts with
_SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_BASE = 0x2545F4914F6CDD1D


def _byte_tables():
    """Per byte: its class (0 blank, 1 of a word, 2 a token of its own) and its value in a word, with
    small letters for capitals and 0 for digits. Bytes over 127 are of a word."""
    kind, value = np.full(256, 2, np.uint8), np.arange(256, dtype=np.uint64) + np.uint64(1)
    kind[[9, 11, 12, 13, 32]] = 0  # a line feed is a token
    for first, last in ((48, 57), (65, 90), (97, 122), (128, 255)):
        kind[first : last + 1] = 1
    value[65:91] += np.uint64(32)
    value[48:58] = value[48]
    return kind, value


_KIND, _VALUE = _byte_tables()
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2 ** 64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        _POWERS[:] = [
            np.cumprod(np.append(np.uint64(1), np.full(size - 1, np.uint64(base))), dtype=np.uint64)
            for base in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _POWERS


def tokens(data: np.ndarray, first: np.ndarray):
    """Starts, ends, word hashes and shapes of the tokens of UTF-8 bytes; ``first`` are the places
    where a text begins.

    A token is a run of letters and digits, or any other byte but a blank. Its shape says how it is
    written: the byte itself, or the case, whether digits are in it, a step of its length, and
    whether it repeats the token before.
    """
    kind = _KIND[data]
    word = kind == 1
    opens = kind == 2
    opens[1:] |= word[1:] & ~word[:-1]
    opens[:1] |= word[:1]
    inner = first[first < len(data)]
    opens[inner] |= word[inner]
    starts = np.flatnonzero(opens)
    closes = kind == 2
    closes[:-1] |= word[:-1] & ~word[1:]
    closes[-1:] |= word[-1:]
    before = inner[inner > 0] - 1
    closes[before] |= word[before]
    ends = np.flatnonzero(closes) + 1

    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[: len(data)], out=sums[1:])
    words = (sums[ends] - sums[starts]) * inverse[starts]

    def count(mask):
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(mask, out=total[1:])
        return total[ends] - total[starts]

    upper = count((data >= 65) & (data <= 90))
    lower = count((data >= 97) & (data <= 122))
    digits = count((data >= 48) & (data <= 57)) > 0
    length = ends - starts
    case = np.where(upper == 0, 0, np.where(lower > 0, np.where(upper == 1, 1, 2), np.where(length == 1, 1, 3)))
    step = np.searchsorted([2, 3, 6, 10, 16, 30], length, side="right")
    shape = 256 + case + 4 * digits + 8 * step
    single = kind[starts] == 2
    shape[single] = data[starts[single]]
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[np.searchsorted(starts, inner)[np.searchsorted(starts, inner) < len(starts)]] = False
    return starts, ends, words, shape + 512 * again


def _slots(values: np.ndarray) -> np.ndarray:
    """Feature numbers of 64-bit hashes."""
    mixed = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(64 - BITS - 8) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _grams(text: np.ndarray, words: np.ndarray, shapes: np.ndarray):
    """(text, feature) of the one- and two-word n-grams and of shape n-grams up to three."""
    salt = [np.uint64(s) for s in _SALTS]
    shapes = shapes.astype(np.uint64) + np.uint64(1)
    pair = text[1:] == text[:-1]
    three = pair[1:] & pair[:-1]
    found = [
        (text, words * salt[0]),
        (text[1:][pair], (words[:-1] * salt[1] + words[1:] * salt[2])[pair]),
        (text, shapes * salt[3]),
        (text[1:][pair], (shapes[:-1] * salt[4] + shapes[1:] * salt[0] + salt[1])[pair]),
    ]
    if len(text) > 2:
        triple = shapes[:-2] * salt[2] + shapes[1:-1] * salt[3] + shapes[2:] * salt[4] + salt[0]
        found.append((text[2:][three], triple[three]))
    return np.concatenate([t for t, _ in found]), _slots(np.concatenate([v for _, v in found]))


def feature_blocks(texts: pa.Array):
    """(first text, end, numbers of the texts, features): the distinct features of whole texts,
    ordered by text, for some neighbouring texts at a time; a null text counts as empty.

    Texts are read in blocks of ``BLOCK_BYTES``: many short ones, or a part of a long one. The next
    part starts a few tokens earlier, so that no n-gram is lost. A word longer than a block counts as
    one word a block.
    """
    if not len(texts):
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1)
        start, stop = int(offsets[at]), int(offsets[end])
        if stop - start <= BLOCK_BYTES:
            keys = _block_keys(data[start:stop], offsets[at:end] - start, at)
        else:
            keys = _long_keys(data[start:stop], at)
        yield at, end, keys >> BITS, keys & ((1 << BITS) - 1)
        at = end


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all blocks."""
    none = np.zeros(0, np.int64)
    found = [(text, slots) for _, _, text, slots in feature_blocks(texts)]
    return np.concatenate([none, *(t for t, _ in found)]), np.concatenate([none, *(s for _, s in found)])


def _block_keys(data, first, number):
    starts, _, words, shapes = tokens(data, first)
    text = np.searchsorted(first, starts, side="right") - 1 + number
    text, slots = _grams(text, words, shapes)
    return np.unique(text << BITS | slots)


def _long_keys(data, number):
    keys, start = [], 0
    nothing = np.zeros(0, np.int64)
    while True:
        part = data[start : start + BLOCK_BYTES]
        starts, _, words, shapes = tokens(part, nothing)
        last = start + len(part) >= len(data)
        keep = len(starts)
        if not last and keep > 2 * _OVERLAP:
            keep -= 1  # the last token may go on
        skip = 2 if start and keep > _OVERLAP else 0
        text, slots = _grams(np.full(keep - skip, number), words[skip:keep], shapes[skip:keep])
        keys.append(np.unique(text << BITS | slots))
        if last:
            return np.unique(np.concatenate(keys))
        start += int(starts[keep - _OVERLAP]) if keep > 2 * _OVERLAP else len(part)


@dataclass
class QualityModel:
    """A score of 1 / (1 + exp(-slope * margin - shift)), where the margin is the model's value of a
    text's scaled features at unit length. Without two labels to learn from all scores are 0.5."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 0.0
    shift: float = 0.0

    def margins(self, text: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        ratio = self.ratio[slots].astype(float)
        value = np.bincount(text, weights=ratio * self.weights[slots], minlength=n)
        length = np.sqrt(np.bincount(text, weights=ratio * ratio, minlength=n))
        return value / np.maximum(length, 1e-12) + self.bias

    def score(self, text: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        z = self.slope * self.margins(text, slots, n) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def log_count_ratio(text: np.ndarray, slots: np.ndarray, good: np.ndarray) -> np.ndarray:
    """log of the share of a feature among the good texts' features over that among the others'; 0
    for a feature that is in no text."""
    found = [np.bincount(slots[mine], minlength=1 << BITS) for mine in (good[text], ~good[text])]
    shares = [(SMOOTHING + c) / (SMOOTHING * len(c) + c.sum()) for c in found]
    return np.where(found[0] + found[1], np.log(shares[0] / shares[1]), 0.0)


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, width: int
) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and dual values of min |w|^2 / 2 + sum cost max(0, 1 - y (w x + b)).

    ``rows`` are sparse (columns, values); the bias is the weight of a constant 1. One dual variable
    at a time is set to its best value between 0 and its cost, in a new order every sweep, until no
    projected gradient exceeds ``TOLERANCE``.
    """
    w, b = np.zeros(width), 0.0
    alpha = np.zeros(len(rows))
    norm = np.array([v @ v + 1 for _, v in rows])
    rng = np.random.default_rng(SEED)
    for _ in range(SWEEPS):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            columns, values = rows[i]
            gradient = y[i] * (w[columns] @ values + b) - 1
            if alpha[i] <= 0:
                gradient = min(gradient, 0.0)
            elif alpha[i] >= cost[i]:
                gradient = max(gradient, 0.0)
            worst = max(worst, abs(gradient))
            if gradient:
                new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
                move = (new - alpha[i]) * y[i]
                alpha[i] = new
                w[columns] += move * values
                b += move
        if worst < TOLERANCE:
            break
    return w, b, alpha


def _linear(text, slots, good, picked, cost) -> QualityModel:
    """Ratios and hinge-loss weights from the picked texts; ``text`` is ordered."""
    mine = picked[text]
    ratio = log_count_ratio(text[mine], slots[mine], good)
    bounds = np.searchsorted(text, np.arange(len(good) + 1))
    rows = []
    numbers = np.flatnonzero(picked)
    for i in numbers:
        columns = slots[bounds[i] : bounds[i + 1]]
        values = ratio[columns]
        rows.append((columns, values / max(np.sqrt(values @ values), 1e-12)))
    y = np.where(good[numbers], 1.0, -1.0)
    w, b, _ = dual_coordinate_descent(rows, y, cost[numbers], 1 << BITS)
    return QualityModel(ratio, w, b)


def fit(text: np.ndarray, slots: np.ndarray, good: np.ndarray, share: float = 0.5) -> QualityModel:
    """Fit on distinct (text, feature) pairs ordered by text. ``share`` is the share of good texts
    outside the sample, to which the scores are calibrated.

    Both classes cost alike. The margins for the calibration are those of models that have not seen
    the text: each half is judged by the other half's model.
    """
    n = len(good)
    if good.all() or not good.any():
        return QualityModel(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0)
    weight = np.where(good, 0.5 / good.mean(), 0.5 / (1 - good.mean()))
    half = np.zeros(n, bool)
    for side in (good, ~good):
        half[np.flatnonzero(side)[::2]] = True
    model = _linear(text, slots, good, np.ones(n, bool), COST * weight)
    margins = model.margins(text, slots, n)
    if min(good.sum(), (~good).sum()) > 1:
        for picked in (half, ~half):
            other = _linear(text, slots, good, picked, COST * weight)
            margins[~picked] = other.margins(text, slots, n)[~picked]
    outside = np.where(good, share / good.mean(), (1 - share) / (1 - good.mean()))
    model.slope, model.shift = calibrate(margins, good, outside)
    return model


def calibrate(margins: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve with the least weighted log loss, by Newton's method;
    targets stay a little inside 0 and 1, so the curve stays finite where classes part."""
    target = np.where(good, 1 - 1 / (good.sum() + 2), 1 / ((~good).sum() + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.zeros(2)

    def loss(at):
        z = at @ x
        return float((weight * (np.logaddexp(0, z) - target * z)).sum()) + 1e-9 * at @ at

    for _ in range(100):
        p = 1 / (1 + np.exp(-(at @ x)))
        gradient = x @ (weight * (p - target)) + 2e-9 * at
        curve = (x * (weight * p * (1 - p))) @ x.T + 1e-9 * np.eye(2)
        move, step = np.linalg.solve(curve, gradient), 1.0
        while step > 1e-6 and loss(at - step * move) > loss(at):
            step /= 2
        at = at - step * move
        if np.abs(step * move).max() < 1e-8:
            break
    return float(max(at[0], 0.0)), float(at[1])


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = FIT_ROWS_PER_CLASS):
    """(text, slots, good, share): features and labels of at most ``per_class`` documents a label.

    Ids are drawn by a hash of the id. Of an id with several labels the least counts, of an id with
    several texts the least text. Rows with a null id or label take no part. The drawn ids are the
    only thing broadcast; texts become features where they are read.
    """
    marked = (
        columns_of(labels, "doc_id", "quality")
        .dropna()
        .groupBy("doc_id")
        .agg((F.min("quality") > 0).alias("good"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    counts = {r["good"]: r["count"] for r in marked.groupBy("good").count().collect()}
    empty = np.zeros(0, np.int64)
    if not counts:
        return empty, empty, np.zeros(0, bool), 0.5
    first = [marked.where(F.col("good") == g).orderBy("h", "doc_id").limit(per_class) for g in counts]
    drawn = first[0] if len(first) == 1 else first[0].unionByName(first[1])
    texts = columns_of(docs, "doc_id", "text").join(F.broadcast(stored(drawn, "drawn-ids")), "doc_id")
    texts = texts.groupBy("doc_id", "good", "h").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def run(batches):
        for batch in batches:
            text, slots = features(batch.column("text"))
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(slots.astype(np.int32)))
            columns = [batch.column("h"), batch.column("doc_id"), batch.column("good"), lists]
            yield pa.RecordBatch.from_arrays(columns, ["h", "doc_id", "good", "slots"])

    key = docs.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(run, f"h bigint, doc_id {key}, good boolean, slots array<int>")
    found = stored(found, "fit-features")
    rows = sorted(found.select("h", "doc_id", F.size("slots").alias("n")).collect())
    room = np.cumsum([r["n"] for r in rows]) <= FIT_FEATURES
    if not room.all():
        last = rows[int(room.argmin())]["h"]
        found = found.where(F.col("h") < last)
    table = found.orderBy("h", "doc_id").toArrow().combine_chunks()
    lists = table.column("slots").combine_chunks()
    text = np.repeat(np.arange(len(table)), pc.list_value_length(lists).to_numpy())
    share = counts.get(True, 0) / sum(counts.values())
    good = table.column("good").to_numpy().astype(bool)
    return text, lists.flatten().to_numpy().astype(np.int64), good, share


def score(docs: DataFrame, model: QualityModel, *keep: str) -> DataFrame:
    """``keep``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for every row, from the whole
    text alone. Texts that are null, empty or without a token get the same score; an empty table
    gives no rows."""
    data = columns_of(docs, *dict.fromkeys([*keep, "text"]))
    fields = [f for f in data.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    names = [f.name for f in fields] + ["score", "predicted"]
    # Both products of a feature, as the workers need no more; about 1 MB each.
    ratio, weights = model.ratio.astype(np.float32), model.weights.astype(np.float32)
    rest = (model.bias, model.slope, model.shift)

    def run(batches):
        scorer = QualityModel(ratio, weights, *rest)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for at, end, text, slots in feature_blocks(batch.column("text")):
                scores[at:end] = scorer.score(text - at, slots, end - at)
            columns = [batch.column(f.name) for f in fields]
            columns += [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return data.mapInArrow(run, schema + ", score double, predicted int")


@query("op13_quality_classifier")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = id_hash_mod("doc_id", 3) == 1
    sample = training_sample(
        docs.where(~held_out), read_table(spark, folder, "labels").where(~held_out)
    )
    return score(docs, fit(*sample), "doc_id").withColumn("held_out", held_out)
