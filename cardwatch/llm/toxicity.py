"""Toxicity: a classifier on word parts, regularised by counterfactual swaps of identity terms."""

from __future__ import annotations

import re
import zlib
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import columns_of, id_hash_mod, read_table, stored
from cardwatch.llm.registry import query

FIT_ROWS_PER_CLASS = 1500  # labelled rows used for fitting, of each label
FIT_WORDS = 5_000_000  # distinct words of all these texts, at most; texts are taken in hash order
PARTS = 1 << 18
GRAMS = (4, 5)
STEPS = 150
RATE = 0.1
RIDGE = 1e-5
SWAP_WEIGHT = 5.0
SWAPS_PER_TEXT = 4
CACHED_WORDS = 300_000
_WORD = re.compile(r"[^\W\d_]+")

# Terms that name groups of people, each of which may stand in for any other.
IDENTITY_TERMS = (
    "women men woman man girls boys mothers fathers black white brown asian african european "
    "american arab latino indigenous jewish jews jew muslim muslims christian christians hindu "
    "hindus buddhist buddhists catholic catholics atheist atheists gay lesbian bisexual transgender "
    "queer straight disabled blind deaf autistic elderly young old immigrant immigrants refugee "
    "refugees migrants foreigners "
    "femmes hommes noirs blancs arabes juifs musulmans chrétiens athées homosexuels immigrés "
    "réfugiés étrangers handicapés "
    "frauen männer schwarze weiße juden muslime christen atheisten schwule lesben ausländer "
    "flüchtlinge behinderte "
    "mujeres hombres negros blancos árabes judíos musulmanes cristianos ateos homosexuales "
    "inmigrantes refugiados extranjeros discapacitados"
).split()


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words of the whole text; null has none."""
    return set(_WORD.findall((text or "").lower()))


def parts_of(word: str) -> list[int]:
    """The word and its character n-grams, marked at both ends, hashed."""
    marked = f"<{word}>"
    parts = {marked}
    for n in GRAMS:
        parts.update(marked[i : i + n] for i in range(len(marked) - n + 1))
    return [zlib.crc32(p.encode()) & (PARTS - 1) for p in parts]


@dataclass
class Toxicity:
    """Score 1 - exp(-sum of word rates): one bad word is enough, a long clean text stays clean.

    The rate of a word whose parts say nothing is what every word has; it is taken off, so words
    that the fit has not seen add nothing, however many there are.
    """

    weights: np.ndarray
    bias: float
    _rates: dict[str, float] = field(default_factory=dict, repr=False)

    def rate(self, word: str) -> float:
        rate = self._rates.get(word)
        if rate is None:
            parts = parts_of(word)
            z = self.bias + float(self.weights[parts].sum()) / len(parts) ** 0.5
            base = min(max(self.bias, -20.0), 5.0)
            rate = float(np.exp(min(max(z, base), 5.0)) - np.exp(base))
            self._rates[word] = rate
        return rate

    def score(self, text: str | None) -> float:
        if len(self._rates) > CACHED_WORDS:
            self._rates.clear()
        return float(-np.expm1(-sum(map(self.rate, sorted(words_of(text))))))


def fit(texts: Sequence[str | Collection[str]], toxic: Sequence[int], seed: int = 7) -> Toxicity:
    """Gradient descent on the log loss, classes weighted alike, plus ``SWAP_WEIGHT`` times the mean
    squared change of the score when an identity term of a text is swapped for another one or is
    added to it. A fit without both labels gives rates of zero, so every score is 0. Texts may be
    given as their distinct words.
    """
    y = np.array(toxic, float)
    n = len(y)
    if n == 0 or y.min() == y.max():
        return Toxicity(np.zeros(PARTS, np.float32), -np.inf)
    vocabulary: dict[str, int] = {}
    word_at, text_at = [], []
    for k, text in enumerate(texts):
        for word in sorted(words_of(text) if isinstance(text, str) else text):
            word_at.append(vocabulary.setdefault(word, len(vocabulary)))
            text_at.append(k)
    terms = np.array([vocabulary.setdefault(t, len(vocabulary)) for t in IDENTITY_TERMS])
    of_word, parts = [], []
    for word, i in vocabulary.items():
        found = parts_of(word)
        of_word += [i] * len(found)
        parts += found
    word_at, text_at, of_word, parts = map(np.array, (word_at, text_at, of_word, parts))
    v = len(vocabulary)
    scale = 1 / np.sqrt(np.bincount(of_word, minlength=v))[of_word]
    swap_text, out_term, in_term = _swaps(word_at, text_at, n, terms, v, seed)

    weights, bias = np.zeros(PARTS), -7.0
    step = _Adam(PARTS + 1)
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    for _ in range(STEPS):
        raw = bias + np.bincount(of_word, weights=weights[parts] * scale, minlength=v)
        rate = np.append(np.exp(np.clip(raw, -20, 5)), 0.0)  # the last is "no term"
        total = np.clip(np.bincount(text_at, weights=rate[word_at], minlength=n), 1e-6, 30)
        slope = np.where(y > 0, -1 / np.expm1(total), 1.0) * balance
        before = total[swap_text]
        after = np.clip(before - rate[out_term] + rate[in_term], 1e-6, 30)
        # The score after less the score before. Only the rates of the two terms answer for it: a
        # text could also hide a change by scoring high without the term.
        change = np.exp(-before) - np.exp(-after)
        pull = 2 * SWAP_WEIGHT * change / max(1, len(change))
        by_word = np.bincount(word_at, weights=slope[text_at], minlength=v + 1)
        by_word += np.bincount(in_term, weights=pull * np.exp(-after), minlength=v + 1)
        by_word -= np.bincount(out_term, weights=pull * np.exp(-after), minlength=v + 1)
        by_word = (by_word * rate)[:v]
        gradient = np.bincount(parts, weights=by_word[of_word] * scale, minlength=PARTS) + RIDGE * weights
        move = step(np.append(gradient, by_word.sum()))
        weights -= move[:-1]
        bias -= move[-1]
    return Toxicity(weights.astype(np.float32), float(bias))


def _swaps(word_at, text_at, n, terms, none, seed):
    """(text, term taken out, term put in): each identity term in a text is swapped for others; a
    text without one gets pairs of texts that differ by an added term alone."""
    rng = np.random.default_rng(seed)
    present = np.isin(word_at, terms)
    has = np.repeat(text_at[present], SWAPS_PER_TEXT)
    out = np.repeat(word_at[present], SWAPS_PER_TEXT)
    bare = np.repeat(np.setdiff1d(np.arange(n), has), SWAPS_PER_TEXT)
    text = np.concatenate([has, bare])
    out = np.concatenate([out, np.full(len(bare), none)])
    return text, out, rng.choice(terms, len(text))


class _Adam:
    def __init__(self, n: int):
        self.m, self.v, self.t = np.zeros(n), np.zeros(n), 0

    def __call__(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient**2
        return RATE * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = FIT_ROWS_PER_CLASS):
    """Distinct words and labels of about ``per_class`` labelled documents of each label.

    Ids are drawn by a hash of the id. Of an id with several labels the larger counts, of an id with
    several texts the least text. Rows with a null id, label or text take no part. Texts of any
    length become words where they are read. The table of drawn ids, about twice ``per_class`` rows,
    is the only thing broadcast, and no more than ``FIT_WORDS`` words meet on the driver.
    """
    marked = (
        columns_of(labels, "doc_id", "toxic")
        .dropna()
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)))
    )
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if not counts:
        return [], []
    limit = F.create_map(
        *[F.lit(x) for k, c in counts.items() for x in (k, int(min(1.0, per_class / c) * (1 << 32)))]
    )
    drawn = marked.where(F.col("h") <= limit[F.col("toxic")]).select("doc_id", "toxic")
    texts = columns_of(docs, "doc_id", "text").where(F.col("text").isNotNull())
    rows = texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            words = [sorted(words_of(t.as_py())) for t in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(words, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "words"])

    found = stored(rows.mapInArrow(run, f"doc_id {key}, toxic int, words array<string>"), "fit-words")
    found = found.withColumn("h", F.xxhash64(F.lit(1), "doc_id"))
    # About twice ``per_class`` rows: their sizes tell how many fit.
    sizes = sorted(found.select("h", F.size("words").alias("n")).collect())
    total = np.cumsum([r["n"] for r in sizes])
    if len(total) and total[-1] > FIT_WORDS:
        found = found.where(F.col("h") < sizes[int((total > FIT_WORDS).argmax())]["h"])
    taken = found.orderBy("doc_id").collect()
    return [r["words"] for r in taken], [r["toxic"] for r in taken]


def score(docs: DataFrame, model: Toxicity, *keep: str) -> DataFrame:
    """``keep``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) for every row, from the whole
    text alone. A text that is null, empty or without words scores 0; equal texts score alike; an
    empty table gives no rows."""
    data = columns_of(docs, *dict.fromkeys([*keep, "text"]))
    fields = [f for f in data.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    names = [f.name for f in fields] + ["score", "predicted"]
    weights, bias = model.weights, model.bias

    def run(batches):
        scorer = Toxicity(weights, bias)
        for batch in batches:
            scores = np.array([scorer.score(t.as_py()) for t in batch.column("text")], float)
            columns = [batch.column(f.name) for f in fields]
            columns += [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return data.mapInArrow(run, schema + ", score double, predicted int")


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = id_hash_mod("doc_id", 5) == 0
    sample = training_sample(
        docs.where(~held_out), read_table(spark, folder, "labels").where(~held_out)
    )
    return score(docs, fit(*sample), "doc_id").withColumn("held_out", held_out)
