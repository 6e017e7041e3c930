"""Document statistics in one pass over the texts, and the features made from them.

A null text counts as an empty one. All other input columns than the id and the text
are left out, so their names cannot clash. Repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from creditloom.llm.tables import small_batches
from creditloom.llm.words import LOWER, line_bounds, per_text, repeats, slices, span_hashes, utf8, windows, word_bounds

SYMBOLS = "#*$%&|<>"
COUNTS = (
    "n_words", "n_chars", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_echo_words", "n_upper", "n_digits", "n_punctuation", "n_stops",
)


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in characters]] = True
    return out


SYMBOL = _table(SYMBOLS)
UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = _table("0123456789")
PUNCTUATION = _table("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
STOP = _table(".?!")


def count_statistics(data: np.ndarray, at: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """The counts named in ``COUNTS`` for each text of a batch."""
    starts, ends, words = word_bounds(data, at)
    character = (data & 0xC0) != 0x80
    letters = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(character, out=letters[1:])
    width = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(letters[ends] - letters[starts], out=width[1:])

    hashes = span_hashes(data, starts, ends)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(words))
    _, again = repeats(owner, span_hashes(LOWER[data], starts, ends))
    echo = np.zeros(len(hashes), dtype=bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])

    runs, runs_owner, first = windows(hashes, words, window)
    found, _ = repeats(runs_owner, runs)
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(cover, first[found], 1)
    np.subtract.at(cover, first[found] + window, 1)
    covered = np.cumsum(cover)[:-1] > 0

    line_starts, line_ends, lines = line_bounds(data, at)
    full = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_owner = np.repeat(np.arange(len(at) - 1), np.diff(lines))[full]
    _, line_again = repeats(line_owner, span_hashes(data, line_starts[full], line_ends[full]))
    texts = np.arange(len(at))
    line_at = np.searchsorted(line_owner, texts)
    return {
        "n_words": np.diff(words),
        "n_chars": letters[at[1:]] - letters[at[:-1]],
        "word_chars": width[words[1:]] - width[words[:-1]],
        "n_symbols": per_text(SYMBOL[data], at),
        "n_lines": np.diff(line_at),
        "n_dup_lines": per_text(line_again, line_at),
        "n_repeat_words": per_text(covered, words),
        "n_distinct_words": np.diff(words) - per_text(again, words),
        "n_echo_words": per_text(echo, words),
        "n_upper": per_text(UPPER[data], at),
        "n_digits": per_text(DIGIT[data], at),
        "n_punctuation": per_text(PUNCTUATION[data], at),
        "n_stops": per_text(STOP[data], at),
    }


def document_statistics(docs: DataFrame, window: int = 5) -> DataFrame:
    """doc_id and the counts of ``COUNTS``, one row per row of ``docs``.

    Empty and null texts have zeros everywhere. ``window`` is the number of words of
    the runs whose repeats n_repeat_words counts.
    """
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *[StructField(c, LongType()) for c in COUNTS]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = count_statistics(*utf8(part.column("text")), window)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(counts[c], pa.int64()) for c in COUNTS]], ["doc_id", *COUNTS]
                )

    return small_batches(docs).select("doc_id", "text").mapInArrow(work, schema)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def features() -> dict[str, Column]:
    """Features over the columns of ``document_statistics``; none is ever null."""
    return {
        "words_log": F.log1p(F.col("n_words").cast("double")),
        "word_length": _share("word_chars", "n_words"),
        "symbol_share": _share("n_symbols", "n_chars"),
        "dup_line_share": _share("n_dup_lines", "n_lines"),
        "repeat_share": _share("n_repeat_words", "n_words"),
        "distinct_share": _share("n_distinct_words", "n_words"),
        "echo_share": _share("n_echo_words", "n_words"),
        "upper_share": _share("n_upper", "n_chars"),
        "digit_share": _share("n_digits", "n_chars"),
        "punctuation_share": _share("n_punctuation", "n_chars"),
        "words_per_line": _share("n_words", "n_lines"),
        "stops_per_word": _share("n_stops", "n_words"),
    }


def bucket(column: Column, seed: int = 42) -> Column:
    """A uniform number in [0, 1) fixed by the column's text."""
    return (F.pmod(F.xxhash64(F.coalesce(column.cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)))


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an id's text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def labelled_sample(rows: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """Rows with a 0/1 label, about ``max_rows`` and no more, chosen by a hash of the id.

    Ids with several labels take the larger; null ids and other labels take no part.
    """
    clean = (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    )
    total = clean.count()
    if total > max_rows:
        clean = clean.filter(bucket(F.col("doc_id")) < max_rows / total)
    return rows.join(clean, "doc_id").orderBy(bucket(F.col("doc_id")), "doc_id").limit(max_rows)
