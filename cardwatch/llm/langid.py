"""Language identification by compression with one raw-content dictionary per language."""

from __future__ import annotations

import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm.common import columns_of, id_hash_mod, read_table
from cardwatch.llm.registry import query

DICTIONARY_BYTES = 96 * 1024  # of training text kept per language
TRAINING_BLOCK = 4096  # characters: training texts are cut, so that long ones can be drawn in part
LANGUAGES_AT_ONCE = 400  # languages whose samples meet on the driver in one job
LEVEL = 12
BLOCK = 4096
MIN_MARGIN = 0.01  # of the second smallest size; below it the choice is not accepted
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether a text has a letter; numerals such as ½, ① and Ⅷ are none."""
    return any(any(map(str.isalpha, m.group())) for m in _LETTER.finditer(text))


def normal(text: str) -> bytes:
    """Lower-case words alone: digits, marks and line structure say little about a language."""
    return " ".join(re.findall(r"[^\W\d_]+", text.lower())).encode()


def learn(docs: DataFrame, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """The dictionary of each language: blocks of training texts one after the other.

    ``docs`` has ``text`` and ``lang``. Every text is cut into blocks, however long it is, and every
    language is learned. The blocks are a sample of about ``dictionary_bytes`` bytes per language,
    taken by a hash of the block, so that it depends neither on order nor on copies. Only this
    sample meets on the driver, for ``LANGUAGES_AT_ONCE`` languages at a time.
    """
    rows = columns_of(docs, "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()
    size = {r["lang"]: r["bytes"] for r in sizes}
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{TRAINING_BLOCK}}}"), F.lit(0))
    parts = F.when(F.length("text") <= TRAINING_BLOCK, F.array("text")).otherwise(cut)
    blocks = rows.select("lang", F.explode(parts).alias("text")).where(F.col("text").rlike(r"\p{L}"))
    blocks = blocks.withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 32)))
    out, langs = {}, sorted(size)
    for i in range(0, len(langs), LANGUAGES_AT_ONCE):
        out |= _draw(blocks, {k: size[k] for k in langs[i : i + LANGUAGES_AT_ONCE]}, dictionary_bytes)
    return out


def _draw(blocks: DataFrame, wanted: dict[str, int], dictionary_bytes: int) -> dict[str, bytes]:
    """The dictionaries of the ``wanted`` languages, given with their bytes of text."""
    # Copies fall on one hash: the limit is widened until enough distinct text lies below it.
    limits = {lang: min(1.0, 2 * dictionary_bytes / size) for lang, size in wanted.items()}
    out = {}
    while wanted:
        limit = F.create_map(*[F.lit(x) for k in wanted for x in (k, int(limits[k] * (1 << 32)))])
        taken = blocks.where(F.col("h") <= limit[F.col("lang")]).distinct()
        texts: dict[str, list] = {k: [] for k in wanted}
        for r in taken.collect():
            texts[r["lang"]].append((r["h"], r["text"]))
        for lang, found in texts.items():
            text = b" ".join(normal(t) for _, t in sorted(found))
            if len(text) >= dictionary_bytes or limits[lang] >= 1.0:
                out[lang] = text[:dictionary_bytes]
                del wanted[lang]
            limits[lang] = min(1.0, 4 * limits[lang])
    return out


class Compressors:
    """One compressor per language; the size of a text is that of its blocks under a dictionary.

    A text is compressed in blocks, each next to the dictionary, so that every part of a long text
    is measured against the language and not against what the text said before.
    """

    def __init__(self, dictionaries: Mapping[str, bytes]):
        self.langs = sorted(dictionaries)
        self._compressors = []
        for lang in self.langs:
            # A raw dictionary must not begin like a trained one; a blank keeps them apart.
            content = zstandard.ZstdCompressionDict(
                b" " + dictionaries[lang] + b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=LEVEL)
            self._compressors.append(
                zstandard.ZstdCompressor(
                    dict_data=content,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )

    def sizes(self, text: str) -> np.ndarray:
        data = normal(text)
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self._compressors])

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin. Of equal sizes the first language in order is taken."""
        if not self.langs or text is None or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(text)
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return self.langs[0], 1.0, 1.0
        second = int(np.partition(sizes, 1)[1])
        # A byte saved doubles the odds; the rest of the probability goes to the other languages.
        odds = np.exp2(-np.minimum(sizes - sizes[best], 60.0))
        return self.langs[best], float(1.0 / odds.sum()), (second - int(sizes[best])) / second


def predict(docs: DataFrame, dictionaries: Mapping[str, bytes], *keep: str) -> DataFrame:
    """``keep``, ``lang_pred``, ``score`` (0 to 1), ``margin`` and ``accepted`` for every row.

    The language is the one whose dictionary makes the whole text smallest. ``accepted`` is false
    where the second smallest size is within ``MIN_MARGIN`` of it. A text that is null or has no
    letter gives ``und``, score 0, not accepted, and so does every text when nothing was learned.
    Numerals are no letters. Equal rows get equal results; an empty table gives no rows. The
    dictionaries are sent with the task: ``DICTIONARY_BYTES`` per language.
    """
    data = columns_of(docs, *dict.fromkeys([*keep, "text"]))
    fields = [f for f in data.schema.fields if f.name in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += ", lang_pred string, score double, margin double, accepted boolean"
    names = [f.name for f in fields] + ["lang_pred", "score", "margin", "accepted"]

    def run(batches):
        model = Compressors(dictionaries)
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            lang, score, margin = zip(*found) if found else ((), (), ())
            columns = [batch.column(f.name) for f in fields] + [
                pa.array(lang, pa.string()),
                pa.array(score, pa.float64()),
                pa.array(margin, pa.float64()),
                pa.array([x != UNKNOWN and m >= MIN_MARGIN for x, m in zip(lang, margin)], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return data.mapInArrow(run, schema)


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = id_hash_mod("doc_id", 3) == 1
    found = predict(docs, learn(docs.where(~held_out)), "doc_id")
    return found.withColumn("held_out", held_out)
