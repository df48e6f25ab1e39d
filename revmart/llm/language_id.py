"""Language identification by compression.

For each language a bounded sample of labelled texts becomes a raw-content
zstandard dictionary. A text, in lower case and with runs of other
characters than letters as one space, is compressed with every dictionary,
block by block over its whole length; the smallest total wins. The
prediction is marked as rejected when the runner-up is less than ``margin``
larger (relative to the winner).

The sample is the documented bound: per language the ``sample_texts`` texts of
smallest seeded hash, and ``dict_bytes`` of content. A longer text gives pieces
from all over it; the dictionary is filled from all the texts, in parts as
equal as their lengths allow. Everything else covers all rows.

Defined results: a null text or one without a letter is ``und`` with score
0; with no labelled text at all every row is ``und``; equal sizes go to the
first language in code point order; null labels teach nothing; repeated
rows are predicted each; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def _pieces(text: Column, chars: int, pieces: int = 8) -> Column:
    """The text, or of a longer one ``pieces`` parts at equal distances, ``chars`` characters in all."""
    size = chars // pieces
    n = F.char_length(text)
    parts = [F.substring(text, (1 + F.floor(k * (n - size) / (pieces - 1))).cast("int"), F.lit(size)) for k in range(pieces)]
    return F.when(n <= chars, text).otherwise(F.concat_ws(" ", *parts))


def _shorter(data: bytes, size: int, pieces: int = 8) -> bytes:
    """The data, or ``size`` bytes of it in ``pieces`` parts at equal distances."""
    if len(data) <= size:
        return data
    each, last = size // pieces, len(data) - (size - size // pieces * (pieces - 1))
    return b"".join(data[k * last // (pieces - 1):][:each] for k in range(pieces - 1)) + data[last:]


def fill(parts: list[bytes], size: int) -> bytes:
    """At most ``size`` bytes from all parts: each whole, or shortened to the one length that fills the rest."""
    left, cut = size - len(parts) + 1, 0  # a line end between the parts
    for k, n in enumerate(sorted(map(len, parts))):
        cut = left // (len(parts) - k)  # what each of the parts still to come may have
        if n > cut:
            break
        left -= n
        cut = n
    return b"\n".join(_shorter(p, cut) for p in parts)[:size]


def learn_dictionaries(labelled: DataFrame, sample_texts: int = 400, dict_bytes: int = 131_072,
                       seed: int = 5) -> dict[str, bytes]:
    """Dictionary content per language, from (id, lang, text).

    A threshold on the seeded hash, from the language's row count, leaves some
    4 * ``sample_texts`` rows of a language in the whole table, and these are
    cut, before anything is exchanged: neither whole texts nor the rows of a
    frequent language meet in a task. The counts, a row per language, are
    broadcast.
    """
    chars = max(8, 4 * dict_bytes // sample_texts)  # where few texts are long, those give more
    usable = labelled.filter(F.col("lang").isNotNull() & (F.length("text") > 0))
    h = F.xxhash64(F.lit(seed), F.col("id"))
    share = F.least(F.lit(1.0), F.lit(4.0 * sample_texts) / F.col("rows"))
    rows = usable.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("rows"))
    ranked = (usable.join(F.broadcast(rows), F.col("lang") == F.col("_lang"))
              .filter(h.cast("double") <= share * 2.0**64 - 2.0**63)
              .select("lang", "id", _pieces(F.col("text"), chars).alias("text"))
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(h, "id", "text")))
              .filter(F.col("rank") <= sample_texts))
    parts: dict[str, list[bytes]] = {}
    for row in ranked.orderBy("lang", F.col("rank").desc()).collect():  # bounded: languages x sample
        parts.setdefault(row["lang"], []).append(letters(row["text"]))
    return {lang: fill(p, dict_bytes) for lang, p in parts.items()}


class CompressionClassifier:
    """Compressed sizes per language; blocks of ``block`` bytes, so that a dictionary serves a whole text."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 5, block: int = 4096,
                 margin: float = 0.01) -> None:
        import zstandard

        self.languages = sorted(dictionaries, key=str.encode)
        self.block, self.margin = block, margin
        self.compressors = []
        for lang in self.languages:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(
                dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: str) -> list[int]:
        data = letters(text)
        blocks = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score (0 to 1: how far the runner-up is behind), rejected."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, True
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.languages[best], 1.0, False
        gap = (min(s for i, s in enumerate(sizes) if i != best) - sizes[best]) / sizes[best]
        return self.languages[best], 1 - math.exp(-20 * gap), gap < self.margin


def predict_languages(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """Per row of (doc_id, text, held_out): doc_id, held_out, lang_pred, score, rejected."""
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = CompressionClassifier(dictionaries)
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, score, rejected = zip(*map(classifier.predict, batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text", "held_out").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the rows not held out (their text and lang) and predict every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", held_out.alias("held_out"))
    learned = learn_dictionaries(rows.filter("not held_out").select(F.col("doc_id").alias("id"), "lang", "text"))
    return predict_languages(rows, learned)
