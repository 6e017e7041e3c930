"""Substring dedup: passages of enough words that two documents have, by content-defined chunks.

A gear hash rolls over the words of a text. The text is cut after a word whose hash is
least among so many words in a row, the last of the least ones; chunks have at most as
many words. A chunk is known by the digest of its words and of those that the hash at its
opening cut was read from. All that decides about a chunk inside a shared passage lies in
the passage, and these sizes are such that every ``min_words`` words hold such a chunk
whole (``reach``): documents that share a passage share a chunk of it, whatever surrounds it
and however often its words repeat.

Chunks are deduplicated by digest. Documents that are alone with one are compared at
once; where more have it, the hashes of the passages that it stands for say who shares
them. Documents that share one are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from creditloom.llm.bitmaps import bitmap, id_hash, may_have
from creditloom.llm.tables import small_batches, stored
from creditloom.llm.words import BASE, BASE_INVERSE, mix, slices, span_hashes, utf8, word_bounds

LEAD = 16


def reach(size: int) -> tuple[int, int]:
    """Words that a cut's hash is read from, and words among which a cut's hash is least.

    In ``size`` words, ``size - lead + 1`` hashes are read from these words alone, twice
    ``among`` or more (of a single word one, which is a chunk). The last least of the first ``among`` of them is a
    cut, and so is that of the last ``among``. No span of ``among`` words that lies partly
    outside chooses a word between these two, as it holds one of them; so the cuts between
    them, and the chunk after the first, are the same wherever the words stand.
    """
    lead = LEAD if size > 1 else 0
    while lead > max(size // 3, 1):
        lead //= 2
    return lead, (size - lead + 1) // 2


def gear_hashes(hashes: np.ndarray, words: np.ndarray, lead: int) -> np.ndarray:
    """h = (h << 64 / lead) + the word's hash, over each text's words: ``lead`` words count.

    ``lead`` is a power of two; the sum over all is made from sums over 1, 2, 4, ... words.
    """
    h, k = hashes.copy(), 1
    place = np.arange(len(h)) - np.repeat(words[:-1], np.diff(words))
    while k < lead:
        if len(h) > k:
            h[k:] = h[k:] + np.where(place[k:] >= k, h[:-k] << np.uint64(64 // lead * k), np.uint64(0))
        k *= 2
    return h


def last_least(x: np.ndarray, among: int) -> np.ndarray:
    """Place of the last of the least among every ``among`` items, from those of 1, 2, 4, ... items."""
    place, span = np.arange(len(x)), 1
    while span < among:
        step = min(span, among - span)
        later = x[step:] <= x[:-step]
        x, place = np.where(later, x[step:], x[:-step]), np.where(later, place[step:], place[:-step])
        span += step
    return place


class WordRuns:
    """Hashes of runs of words, whatever texts they are of, from prefix sums."""

    def __init__(self, hashes: np.ndarray):
        powers = np.full(len(hashes) + 1, BASE, dtype=np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * powers[:-1], out=self.sums[1:])
        powers.fill(BASE_INVERSE)
        powers[0] = 1
        self.back = np.multiply.accumulate(powers)

    def between(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last] - self.sums[first]) * self.back[first] + (last - first).astype(np.uint64))

    def of(self, size: int) -> np.ndarray:
        """Of every ``size`` words in a row."""
        return mix((self.sums[size:] - self.sums[:-size]) * self.back[:-size] + np.uint64(size))


class Chunks:
    """The chunks of texts, given their words' hashes and the texts' offsets among these.

    digest and n_words of each chunk, ``at`` the texts' offsets among the chunks, ``of``
    the chunk of each word, ``cuts`` the cut chosen among the words from each one on.
    """

    def __init__(self, hashes: np.ndarray, words: np.ndarray, size: int, runs: WordRuns):
        lead, among = reach(size)
        owner = np.repeat(np.arange(len(words) - 1), np.diff(words))
        self.cuts = last_least(gear_hashes(hashes, words, lead), among)
        cut = np.zeros(len(hashes), dtype=bool)
        cut[self.cuts[owner[among - 1 :] == owner[: len(self.cuts)]]] = True
        first = np.ones(len(hashes), dtype=bool)
        first[1:] = cut[:-1] | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(hashes)) if len(begin) else begin
        self.digest = runs.between(np.maximum(begin - lead, words[owner[begin]]), end)
        self.n_words, self.of, self.at = end - begin, np.cumsum(first) - 1, np.searchsorted(begin, words)


def chunks(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digest and number of words of each chunk, and the offsets of each text's chunks.

    Every ``size`` words that two texts share hold a chunk of both.
    """
    hashes, words = word_hashes(data, at)
    found = Chunks(hashes, words, size, WordRuns(hashes))
    return found.digest, found.n_words, found.at


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the offsets of each text's words."""
    starts, ends, words = word_bounds(data, at)
    return span_hashes(data, starts, ends), words


def passage_hashes(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text, the digest of its first own chunk, and its text."""
    hashes, words = word_hashes(data, at)
    if len(hashes) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(words))
    inside = owner[size - 1 :] == owner[: len(owner) - size + 1]
    runs = WordRuns(hashes)
    found, lead = Chunks(hashes, words, size, runs), reach(size)[0]
    opening = found.cuts[max(lead - 1, 0) :][: len(inside)][inside]
    # the chunk after the first cut that the run itself decides; a single word is its own
    chunk = found.of[opening] + (1 if size > 1 else 0)
    return runs.of(size)[inside], found.digest[chunk], owner[: len(inside)][inside]


def distinct_per_text(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes, each once."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def digest_rows(docs: DataFrame, min_words: int, chunks: np.ndarray | None = None, passages: np.ndarray | None = None) -> DataFrame:
    """digest and doc_id, once per text: the chunks that its passages of ``min_words`` words are found by.

    With a bitmap of chunks instead the passages whose chunks may be in it, and of those
    the ones that may be in the bitmap ``passages``, if that is given too.
    """
    schema = StructType([StructField("digest", LongType()), docs.schema["doc_id"]])
    sent = docs.sparkSession.sparkContext.broadcast((chunks, passages))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, passages = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                digest, chunk, owner = passage_hashes(*utf8(part.column("text")), min_words)
                if chunks is None:
                    pick, digest = np.ones(len(chunk), dtype=bool), chunk
                    pick[1:] = (chunk[1:] != chunk[:-1]) | (owner[1:] != owner[:-1])
                else:
                    pick = may_have(chunks, chunk)
                    if passages is not None:
                        pick &= may_have(passages, digest)
                owner, digest = distinct_per_text(owner[pick], digest[pick])
                yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), part.column("doc_id").take(pa.array(owner))], schema.names)

    return small_batches(docs).filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").mapInArrow(work, schema)


def holders(rows: DataFrame) -> DataFrame:
    """digest, n, first_doc and last_doc of the digests that two documents or more have."""
    found = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    return found.filter("first_doc <> last_doc")


def both_ways(held: DataFrame) -> DataFrame:
    """doc_id and other: the first and the last holder, each beside the other."""
    ends = F.array(*[F.struct(F.col(a).alias("doc_id"), F.col(b).alias("other")) for a, b in (("first_doc", "last_doc"), ("last_doc", "first_doc"))])
    return held.select("first_doc", "last_doc").distinct().select(F.inline(ends))


def between(rows: DataFrame, held: DataFrame) -> DataFrame:
    """doc_id and other: the first holder beside the holders that are not first or last."""
    return rows.join(held, "digest").filter("doc_id <> first_doc AND doc_id <> last_doc").select("doc_id", F.col("first_doc").alias("other")).distinct()


def chosen_texts(docs: DataFrame, named: DataFrame) -> DataFrame:
    """doc_id and text of the documents that ``named`` names, and of a few others."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(named.select(id_hash(F.col("doc_id")).alias("h")), "h"))
    schema = StructType([docs.schema["doc_id"], docs.schema["text"]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_have(sent.value, batch.column("h").to_numpy()))).select(["doc_id", "text"])

    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", id_hash(F.col("doc_id")).alias("h")).mapInArrow(work, schema)


def common_run(left: list, right: list, i: int, j: int) -> tuple[int, int]:
    """Start in ``left`` and length of the longest equal run that holds left[i] = right[j]."""
    if not (i < len(left) and j < len(right)) or left[i] != right[j]:
        return i, 0
    low = 0
    while i - low > 0 and j - low > 0 and left[i - low - 1] == right[j - low - 1]:
        low += 1
    high = 1
    while i + high < len(left) and j + high < len(right) and left[i + high] == right[j + high]:
        high += 1
    return i - low, low + high


def common_runs(left: list, right: list, places: list[dict], least: int) -> list[tuple[int, int]]:
    """Such runs of ``least`` words or more around the given places, which are in order.

    A place whose next ``least`` words lie in a run that was found adds none.
    """
    found, reach = set(), 0
    for place in places:
        i, j = place["pos"], place["other_pos"]
        if i + least > reach:
            start, n = common_run(left, right, i, j)
            if n >= least:
                found.add((start, n))
                reach = max(reach, start + n)
    return sorted(found)


def shared_places(own: np.ndarray, theirs: np.ndarray) -> list[dict]:
    """Where equal hashes begin to stand side by side: place in ``own``, first place in ``theirs``."""
    order = np.argsort(theirs, kind="stable")
    at = np.minimum(np.searchsorted(theirs[order], own), max(len(theirs) - 1, 0))
    pos = np.flatnonzero(theirs[order][at] == own) if len(theirs) else np.zeros(0, np.int64)
    other = order[at[pos]]
    new = np.ones(len(pos), dtype=bool)
    new[1:] = (np.diff(pos) != 1) | (np.diff(other) != 1)
    return [{"pos": i, "other_pos": j} for i, j in zip(pos[new].tolist(), other[new].tolist(), strict=True)]


def confirm(wide: DataFrame, min_words: int) -> DataFrame:
    """doc_id, start, n_words and other_doc_id of the equal runs of two texts, for those that ask."""
    kind = wide.schema["low"].dataType
    schema = StructType([
        StructField("doc_id", kind), StructField("start", LongType()), StructField("n_words", LongType()), StructField("other_doc_id", kind),
    ])
    sides = ("low", "high")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {side: [] for side in sides}
            for k in range(batch.num_rows):
                texts = [batch.column(f"{side}_text").slice(k, 1) for side in sides]
                hashes = [WordRuns(word_hashes(*utf8(text))[0]).of(min_words) for text in texts]
                words: list = []
                for side, turn in (("low", 1), ("high", -1)):
                    places = shared_places(*hashes[::turn]) if batch.column(f"{side}_asks")[k].as_py() else []
                    if places:
                        # bytes.split() parts at just the bytes that words are made without
                        words = words or [text.cast(pa.binary())[0].as_py().split() for text in texts]
                        rows[side] += [(k, start, n) for start, n in common_runs(*words[::turn], places, min_words)]
            for side, other in (sides, sides[::-1]):
                if rows[side]:
                    at, start, n = (pa.array(c, pa.int64()) for c in zip(*rows[side], strict=True))
                    yield pa.RecordBatch.from_arrays([batch.column(side).take(at), start, n, batch.column(other).take(at)], schema.names)

    return wide.select("low", "high", "low_asks", "high_asks", "low_text", "high_text").mapInArrow(work, schema)


def repeated_passages(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """doc_id, start, n_words, other_doc_id: passages that another document has as well.

    start counts words; n_words is at least ``min_words``. Every ``min_words`` words in a
    row that another document has lie in a row of the result, whose whole run
    other_doc_id has. A document is compared with the first one (the first with the
    last) that has such words, so a passage of many documents gives a row or two each,
    not one per pair. Documents without such a
    passage have no row; null and empty texts and null ids take no part.
    Rows with one doc_id are one document, and passages between them do not count. An
    empty table gives an empty result.
    """
    shared = stored(holders(digest_rows(docs, min_words)), "shared-chunks")
    # two documents that are alone with a chunk can only have its passages from each other
    common = bitmap(shared.filter("n > 2"), "digest")
    held = stored(holders(digest_rows(docs, min_words, common)), "shared-passages")
    many = held.filter("n > 2")
    inner = between(digest_rows(docs, min_words, common, bitmap(many, "digest")), many)
    pairs = both_ways(shared.filter("n = 2")).unionByName(both_ways(held)).unionByName(inner)
    return passages_of_pairs(docs, pairs, min_words)


def passages_of_pairs(docs: DataFrame, pairs: DataFrame, min_words: int) -> DataFrame:
    """The equal runs of the documents ``doc_id`` and ``other`` of each pair, each once."""
    ends = {"low": F.least("doc_id", "other"), "high": F.greatest("doc_id", "other")}
    asks = [F.bool_or(F.col("doc_id") == end).alias(f"{side}_asks") for side, end in ends.items()]
    # a pair that is asked for from both sides reads its texts once
    pairs = stored(pairs.groupBy(*[end.alias(side) for side, end in ends.items()]).agg(*asks), "pairs")
    named = pairs.select(F.explode(F.array("low", "high")).alias("doc_id")).distinct()
    texts = stored(chosen_texts(docs, named), "passage-texts")
    for side in ("high", "low"):
        pairs = pairs.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"{side}_text")), side)
    return confirm(pairs, min_words).groupBy("doc_id", "start", "n_words").agg(F.min("other_doc_id").alias("other_doc_id"))
