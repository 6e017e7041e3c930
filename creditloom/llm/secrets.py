"""Secret scans: fixed patterns, and Markov models that tell random strings from names.

All work is done by Spark SQL functions. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.mixing import draw
from creditloom.llm.tables import aside


@dataclass(frozen=True)
class Kind:
    """A pattern and the least number of characters of one of its groups.

    Every text with a long enough match has a match of ``look``.
    """

    name: str
    pattern: str
    group: int
    least: int
    look: str


# The base kinds, in the order that ranks spans with one start. Fixed values.
BASE_KINDS = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, r"(?i:password|passwd|secret|token|api_?key)"),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16, r"AKIA[A-Z0-9]{12,}"),
    Kind("hex", r"[0-9a-f]+", 0, 32, r"[0-9a-f]{32,}"),
)
RANDOM = Kind("random", r"[A-Za-z0-9+/_=-]{16,}", 0, 16, r"[A-Za-z0-9+/_=-]{16,}")
NAME = r"[A-Za-z0-9_]{6,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET)

SPAN = "struct<start:int,rank:int,end:int,kind:string>"
WORD_SPAN = "struct<start:int,rank:int,end:int,kind:string,word:string>"
# numbers, or characters, to a block of a long array or text
BLOCK = 128
CHARACTERS = 4096


def held(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, joined_: Callable[[Column, Column], Column]) -> Column:
    """For an array of whole numbers of 0 or more: what all up to each one amount to.

    In blocks of BLOCK numbers, whose ends are carried on afterwards, so that no long
    array grows by single appends.
    """
    none = F.array().cast("array<int>")
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))

    def blocks_of(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        return F.transform(starts, lambda k: F.aggregate(F.slice(v, k * BLOCK + 1, BLOCK), none, lambda acc, x: F.array_append(acc, joined_(last(acc), x))))

    def carried(blocks: Column) -> Column:
        return F.aggregate(blocks, F.array(F.lit(0)), lambda acc, block: F.array_append(acc, joined_(last(acc), last(block))))

    def whole(blocks: Column) -> Column:
        return held(carried(blocks), lambda ends: F.flatten(F.transform(blocks, lambda block, k: F.transform(block, lambda x: joined_(ends[k], x)))))

    return held(values, lambda v: F.when(F.size(v) > 0, held(blocks_of(v), whole)).otherwise(none))


def plus(a: Column, b: Column) -> Column:
    return a + b


def matches(text: Column, kind: Kind, rank: int) -> Column:
    """Spans of a kind with their strings, leftmost and non-overlapping, too short ones left out.

    The parts between matches and the matches themselves alternate, so a match ends
    after the lengths of all parts and matches up to it.
    """
    pattern = F.lit(kind.pattern)

    def spans_of(found: Column) -> Column:
        gaps = F.slice(F.split(text, kind.pattern, -1), 1, F.size(found))
        ends = running(F.zip_with(gaps, found, lambda gap, match: F.length(gap) + F.length(match)), plus)
        proof = found if kind.group == 0 else F.regexp_extract_all(text, pattern, F.lit(kind.group))
        rows = F.arrays_zip(ends.alias("end"), found.alias("word"), F.transform(proof, F.length).alias("proof"))
        return F.transform(
            F.filter(rows, lambda x: x["proof"] >= kind.least),
            lambda x: F.struct(
                (x["end"] - F.length(x["word"])).alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind.name).alias("kind"), x["word"].alias("word")
            ),
        )

    none = F.array().cast(f"array<{WORD_SPAN}>")
    found = held(F.regexp_extract_all(text, pattern, F.lit(0)), lambda f: spans_of(f).cast(f"array<{WORD_SPAN}>"))
    return F.when(F.regexp_like(text, F.lit(kind.look)), found).otherwise(none)


def bare(spans: Column) -> Column:
    """Spans without their strings."""
    return F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "rank", "end", "kind")]).cast(SPAN))


def count_before(sorted_: Column, limit: Column) -> Column:
    """How many numbers of a sorted array are less than ``limit``, by halving."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(sorted_) + 1.0)).cast("int") + 1)
    state = "struct<low:int,high:int>"

    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        open_, less = acc["low"] < acc["high"], sorted_[middle] < limit
        return F.struct(
            F.when(open_ & less, middle + 1).otherwise(acc["low"]).alias("low"), F.when(open_ & ~less, middle).otherwise(acc["high"]).alias("high")
        ).cast(state)

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(sorted_).alias("high")).cast(state), step, lambda acc: acc["low"])


def apart(candidates: Column, spans: Column) -> Column:
    """Those candidates that overlap none of the spans, which are sorted by start."""

    def free(edges: Column) -> Column:
        def alone(s: Column) -> Column:
            return held(count_before(edges["starts"], s["end"]), lambda k: (k == 0) | (edges["ends"][k - 1] <= s["start"]))

        return F.filter(candidates, alone)

    edges = F.struct(F.transform(spans, lambda b: b["start"]).alias("starts"), running(F.transform(spans, lambda b: b["end"]), F.greatest).alias("ends"))
    return F.when((F.size(candidates) > 0) & (F.size(spans) > 0), held(edges, free)).otherwise(candidates)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, by start, then by rank."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def state_of(character: Column) -> Column:
    """The number of a character among the states, from 1; 0 for any other."""
    return F.when(character == "", 0).otherwise(F.call_function("instr", F.lit(ALPHABET), character))


def states(word: Column) -> Column:
    return F.filter(F.transform(F.split(word, ""), state_of), lambda x: x > 0)


def transitions(words: DataFrame) -> DataFrame:
    """a, b, n: how often state b follows state a in the strings of the column ``word``."""
    pairs = words.select(states(F.col("word")).alias("s")).filter(F.size("s") > 1).select(
        F.explode(F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("a"), F.slice("s", 2, F.size("s") - 1).alias("b"))).alias("t")
    )
    return pairs.groupBy(F.col("t.a").alias("a"), F.col("t.b").alias("b")).agg(F.count("*").alias("n"))


def log_ratios(random: DataFrame, names: DataFrame, uniform: float = 0.5, backing: float = 5.0) -> list[float]:
    """log P(b | a, random string) - log P(b | a, name), for all pairs of states in order.

    A seldom seen a leans on how often b follows anything (``backing`` counts' worth).
    Random strings mix what their samples show with a uniform choice. Both tables have
    at most a row per pair of states, whatever they were counted from.
    """

    def model(frame: DataFrame) -> list[list[float]]:
        table = [[0.0] * STATES for _ in range(STATES)]
        for a, b, n in frame.select("a", "b", "n").collect():
            table[a - 1][b - 1] += n
        ends = [sum(row[b] for row in table) + 0.5 for b in range(STATES)]
        total = sum(ends)
        return [[(n + backing * ends[b] / total) / (sum(row) + backing) for b, n in enumerate(row)] for row in table]

    pairs = zip(model(random), model(names), strict=True)
    return [log(uniform / STATES + (1 - uniform) * x) - log(y) for own, other in pairs for x, y in zip(own, other, strict=True)]


def likelihood_ratio(word: Column, ratios: list[float]) -> Column:
    """Sum of the log ratios over a string's transitions: above 0, rather random than a name."""
    table = F.from_json(F.lit("[" + ",".join(repr(round(r, 6)) for r in ratios) + "]"), "array<double>")
    state = "struct<last:int,sum:double>"

    def step(acc: Column, x: Column) -> Column:
        cell = F.element_at(table, (acc["last"] - 1) * STATES + x)
        more = F.when(acc["last"] > 0, cell).otherwise(F.lit(0.0))
        return F.struct(x.alias("last"), (acc["sum"] + more).alias("sum")).cast(state)

    return F.aggregate(states(word), F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum")).cast(state), step, lambda acc: acc["sum"])


def base_spans(text: Column) -> Column:
    """All base spans of a text; a null text has none."""
    full = F.coalesce(text, F.lit(""))
    return F.concat(*[bare(matches(full, kind, rank)) for rank, kind in enumerate(BASE_KINDS)])


def labelled_strings(docs: DataFrame, max_documents: int) -> tuple[DataFrame, DataFrame]:
    """Samples of both classes: values that the base patterns find, and the words around them.

    Both come from about ``max_documents`` documents each, chosen by a hash of the id:
    from those with a base pattern, and from all.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    has = reduce(lambda a, b: a | b, [F.regexp_like(text, F.lit(k.look)) for k in BASE_KINDS])
    total, found = docs.agg(F.count("*"), F.count_if(has)).first()
    turn = draw(5, F.col("doc_id"))
    some = docs.filter(turn < max_documents / max(total, 1))
    hits = docs.filter(has & (turn < max_documents / max(found, 1)))

    def values_of(kind: Kind) -> Column:
        return F.filter(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)), lambda v: F.length(v) >= kind.least)

    values = F.concat(*[values_of(kind) for kind in BASE_KINDS])
    rest = F.regexp_replace(F.regexp_replace(text, BASE_KINDS[0].pattern, " "), "|".join(k.look for k in BASE_KINDS[1:]), " ")
    random = hits.select(F.explode(F.array_distinct(values)).alias("word")).distinct()
    names = some.select(F.explode(F.array_distinct(F.regexp_extract_all(rest, F.lit(NAME), F.lit(0)))).alias("word")).distinct()
    return random, names


def scan_secrets(
    docs: DataFrame, random: DataFrame | None = None, names: DataFrame | None = None, threshold: float = 10.0, max_documents: int = 2_000
) -> DataFrame:
    """The rows of ``docs`` with base_spans and spans (like-named columns are replaced).

    Both are arrays of (start, rank, end, kind) in order. ``spans`` has the base spans,
    and those strings of 16 or more token characters, overlapping none of them, whose
    log-likelihood ratio is at least ``threshold``. The models are fitted on the column
    ``word`` of ``random`` and ``names``; by default on strings of the documents, see
    ``labelled_strings``. A null or empty text has no spans; repeated rows get a row each;
    an empty table gives an empty result. The work grows with a text's length and with
    n log n of its matches.
    """
    if random is None or names is None:
        own_random, own_names = labelled_strings(docs, max_documents)
        random, names = random if random is not None else own_random, names if names is not None else own_names
    ratios = log_ratios(transitions(random), transitions(names))
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = [docs[c] for c in docs.columns if c.lower() not in ("base_spans", "spans")]
    based = docs.select(*rest, F.array_sort(base_spans(docs["text"])).alias("base_spans"))
    free = F.filter(
        apart(matches(text, RANDOM, len(BASE_KINDS)), F.col("base_spans")), lambda s: likelihood_ratio(s["word"], ratios) >= threshold
    )
    return based.select("*", F.array_sort(F.concat("base_spans", bare(free))).alias("spans"))


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with every span, overlapping ones together, replaced by ``mask``.

    Spans are sorted by start. What lies between them is cut from blocks of the text.
    """

    def between(blocks: Column, first: Column, last: Column) -> Column:
        low = F.floor(first / CHARACTERS).cast("int")
        some = F.slice(blocks, low + 1, F.floor((last - 1) / CHARACTERS).cast("int") - low + 1)
        return F.when(last > first, F.substring(F.array_join(some, ""), first - low * CHARACTERS + 1, last - first)).otherwise("")

    def pieces(x: Column) -> Column:
        ends = x["ends"]
        before = lambda k: F.when(k > 0, ends[k - 1]).otherwise(0)
        gaps = F.transform(spans, lambda s, k: F.when(s["start"] >= before(k), between(x["blocks"], before(k), s["start"])))
        tail = between(x["blocks"], F.element_at(ends, -1), x["size"])
        return F.array_join(F.concat(F.filter(gaps, lambda g: g.isNotNull()), F.array(tail)), mask)

    blocks = F.regexp_extract_all(text, F.lit("(?s).{1," + str(CHARACTERS) + "}"), F.lit(0))
    parts = F.struct(running(F.transform(spans, lambda s: s["end"]), F.greatest).alias("ends"), blocks.alias("blocks"), F.length(text).alias("size"))
    return F.when(F.size(spans) > 0, held(parts, pieces)).otherwise(text)


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]", **options) -> DataFrame:
    """The rows of ``docs`` with secrets masked in the text; n_chars follows the new text.

    Every other column stays as it is, whatever its name. Null and empty texts stay,
    repeated rows are masked alike, and an empty table gives an empty result.
    """
    rows, back = aside(docs, ("base_spans", "spans"))
    found = scan_secrets(rows, **options).withColumn("text", masked(F.col("text"), F.col("spans"), mask))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*rows.columns).withColumnsRenamed(back)
