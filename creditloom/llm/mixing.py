"""Mixing sources to target weights by pivotal dependent rounding, in Spark SQL functions only.

Every document of a source wants the same fractional number of copies. Its whole part
is certain; the fractions are rounded in pairs: words move from one document's fraction
to the other's, in a random direction with odds that keep both expectations, until one
of the two is 0 or 1. So a source keeps its number of words at every step. Documents
are dealt by hash to groups of bounded size, each group is folded to at most one open
document, and these climb a tree of groups. A few documents of every size are kept out
of the tree; at its root they take up, from large to small, what the last open document
leaves over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
RANGE = 1 << 30


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, *columns: Column) -> Column:
    """A uniform number in [0, 1) fixed by the columns' values."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), F.lit(RANGE)) / F.lit(float(RANGE))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, source_size, n, and target: the words that the mix should take of it.

    Sources in code point order, null last, have the weights in turn. Shares of the
    total stop at ``most`` times a source's size; the rest is shared again by weight.
    The common level of the uncapped sources is found by prefix sums over the sources
    in the order in which they reach their caps.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place - 1, F.lit(len(weights))) + 1)
    rows = sums.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    turn = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, everyone = turn.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(everyone) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    share = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    rows = rows.withColumn("level", left / share).withColumn("turn", F.row_number().over(turn))
    open_ = F.when(F.col("cap") >= F.col("weight") * F.col("level"), F.struct("turn", "level"))
    rows = rows.withColumn("level", F.min(open_).over(everyone)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap")))
    return rows.select("source", "source_size", "n", target.alias("target"))


ITEM = "struct<turn:double,doc_id:{id},unit:bigint,words:double,p:double>"
RUN = 10_000


def fold_group(items: Column, item: str, seed: int) -> Column:
    """Rounds the fractions of a sorted array of open documents.

    Gives all of them with their new fractions; only the last may still be open.
    """
    state = f"struct<open:{item},done:array<{item}>>"

    def with_p(x: Column, p: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("turn", "doc_id", "unit", "words")], p.alias("p")).cast(item)

    def step(acc: Column, x: Column) -> Column:
        c = acc["open"]
        rise = F.least((1 - c["p"]) * c["words"], x["p"] * x["words"])
        fall = F.least(c["p"] * c["words"], (1 - x["p"]) * x["words"])
        up = draw(seed, c["unit"], x["unit"], x["doc_id"]) * (rise + fall) < fall
        c_ends = F.when(up, (1 - c["p"]) * c["words"] <= x["p"] * x["words"]).otherwise(c["p"] * c["words"] <= (1 - x["p"]) * x["words"])
        moved = F.when(up, rise).otherwise(-fall)
        c_p = F.when(c_ends, F.when(up, 1.0).otherwise(0.0)).otherwise(c["p"] + moved / c["words"])
        x_p = F.when(c_ends, x["p"] - moved / x["words"]).otherwise(F.when(up, 0.0).otherwise(1.0))
        first, second = with_p(c, c_p), with_p(x, x_p)
        settled = F.when(c_ends, first).otherwise(second)
        still = F.when(c_ends, second).otherwise(first)
        return F.when(
            c.isNull() | (c["p"] <= 0) | (c["p"] >= 1),
            F.struct(x.cast(item).alias("open"), F.when(c.isNull(), acc["done"]).otherwise(F.array_append(acc["done"], c)).alias("done")).cast(state),
        ).otherwise(F.struct(still.alias("open"), F.array_append(acc["done"], settled).alias("done")).cast(state))

    start = F.struct(F.lit(None).cast(item).alias("open"), F.array().cast(f"array<{item}>").alias("done")).cast(state)
    return F.aggregate(items, start, step, lambda acc: F.array_append(acc["done"], acc["open"]))


def settle_root(items: Column, item: str, base: Column, most: int, seed: int) -> Column:
    """Whole copies for the root's documents, from large to small.

    What rounding one adds or takes is made up by the next smaller ones.
    """
    state = f"struct<owed:double,done:array<{item}>>"

    def step(acc: Column, x: Column) -> Column:
        wish = x["p"] + acc["owed"] / x["words"]
        whole = F.floor(wish) + F.when(draw(seed, x["unit"], x["doc_id"]) < wish - F.floor(wish), 1).otherwise(0)
        copies = F.least(F.greatest(whole.cast("double"), -base), F.lit(float(most)) - base)
        owed = (wish - copies) * x["words"]
        now = F.struct(*[x[c].alias(c) for c in ("turn", "doc_id", "unit", "words")], copies.alias("p")).cast(item)
        return F.struct(owed.alias("owed"), F.array_append(acc["done"], now).alias("done")).cast(state)

    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast(f"array<{item}>").alias("done")).cast(state)
    return F.aggregate(items, start, step, lambda acc: acc["done"])


def kind_of(words: Column) -> Column:
    """The power of two that a number of words reaches."""
    return F.floor(F.log2(F.greatest(words.cast("double"), F.lit(1.0)))).cast("int")


def mix_sizes(
    sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 17, group: int = 64, fan: int = 64, spare: int = 3
) -> DataFrame:
    """Copies for rows (doc_id, source, size, digest): adds rows, source_size, target and runs.

    One row per distinct (doc_id, source, size, digest); ``rows`` says how many equal rows
    it stands for, and ``runs`` lists (copies, rows): so many of them get so many copies,
    from 0 to ``most``. Equal rows want ``rows`` times the same fraction; its whole part
    is dealt to as many of them, and one row takes part in the rounding with the rest.
    Documents without words get the whole part only. The result depends on the rows'
    values and ``seed``.
    """
    units = sizes.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("rows"))
    rate = F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)), F.lit(float(most)))
    targets = source_targets(sizes, weights, most).withColumn("rate", rate).withColumn("base", F.floor("rate").cast("double"))
    per_kind = units.groupBy(F.col("source").alias("kind_source"), kind_of(F.col("size")).alias("kind")).agg(F.count("*").alias("count"))
    targets = targets.withColumnRenamed("source", "target_source")
    wide = units.withColumn("words", F.col("size").cast("double")).withColumn("kind_of", kind_of(F.col("words")))
    wide = wide.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
    wide = wide.join(per_kind, F.col("source").eqNullSafe(F.col("kind_source")) & (F.col("kind_of") == F.col("kind")))
    key = [F.col("doc_id"), F.col("source"), F.col("size"), F.col("digest")]
    share = F.when(F.col("words") > 0, (F.col("rate") - F.col("base")) * F.col("rows")).otherwise(0.0)
    wide = (
        wide.withColumn("unit", F.xxhash64(F.lit(seed), *key))
        .withColumn("turn", draw(seed, *key))
        .withColumn("spare", draw(seed + 1, *key) < F.lit(float(spare)) / F.col("count"))
        .withColumn("more_rows", F.floor(share).cast("long"))
        .withColumn("p", share - F.col("more_rows"))
        .withColumn("node", F.floor(draw(seed + 2, *key) * F.ceil(F.col("n") / group)).cast("long"))
        .drop("count", "kind", "kind_of", "kind_source", "target_source", "n")
    )
    wide = stored(wide, "mixing-units")

    item = ITEM.format(id=sizes.schema["doc_id"].dataType.simpleString())
    packed = F.struct("turn", "doc_id", "unit", "words", "p").cast(item)
    fields = ["source", "base", "node"]
    open_ = wide.filter((F.col("p") > 0) & ~F.col("spare")).select(*fields, packed.alias("x"))
    nodes = (open_.agg(F.max("node")).first()[0] or 0) + 1
    settled, level = [], 0
    while True:
        folded = open_.groupBy(*fields).agg(F.array_sort(F.collect_list("x")).alias("items"))
        rounded = stored(folded.select(*fields, F.explode(fold_group(F.col("items"), item, seed + 10 + level)).alias("x")), f"mixing-level-{level}")
        ended = (F.col("x.p") <= 0) | (F.col("x.p") >= 1)
        settled.append(rounded.filter(ended).select("source", "x.doc_id", "x.unit", F.col("x.p").alias("more")))
        open_ = rounded.filter(~ended).withColumn("node", F.floor(F.col("node") / fan))
        if nodes == 1:
            break
        nodes, level = -(-nodes // fan), level + 1
    kept_out = wide.filter((F.col("p") > 0) & F.col("spare")).withColumn("node", F.lit(0).cast("long")).select(*fields, packed.alias("x"))
    root = open_.select(*fields, "x").unionByName(kept_out).groupBy("source", "base").agg(F.collect_list("x").alias("items"))
    larger = lambda a, b: F.when(a["words"] != b["words"], F.signum(b["words"] - a["words"])).when(a["unit"] < b["unit"], -1).when(a["unit"] > b["unit"], 1).otherwise(0).cast("int")
    last = root.select("source", F.explode(settle_root(F.array_sort("items", larger), item, F.col("base"), most, seed + 3)).alias("x"))
    settled.append(last.select("source", "x.doc_id", "x.unit", F.col("x.p").alias("more")))
    rounded = settled[0]
    for part in settled[1:]:
        rounded = rounded.unionByName(part)
    same = F.col("w.source").eqNullSafe(F.col("r.source")) & F.col("w.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("w.unit") == F.col("r.unit"))
    base = F.col("w.base").cast("long")
    run = lambda copies, rows: F.struct(copies.alias("copies"), rows.alias("rows"))
    runs = F.array(
        run(base + F.coalesce(F.col("r.more"), F.lit(0.0)).cast("long"), F.lit(1).cast("long")),
        run(base + 1, F.col("w.more_rows")),
        run(base, F.col("w.rows") - 1 - F.col("w.more_rows")),
    )
    return wide.alias("w").join(rounded.alias("r"), same, "left").select(
        "w.doc_id", "w.source", "w.size", "w.digest", "w.rows", "w.source_size", "w.target", F.filter(runs, lambda x: x["rows"] > 0).alias("runs")
    )


def repeat(frame: DataFrame, times: Column) -> DataFrame:
    """Every row as often as ``times`` says; no array has more than RUN numbers or blocks of so many."""
    frame = frame.withColumn("_times", times).filter("_times > 0")
    blocks = frame.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / RUN))))
    inner = F.sequence(F.lit(1).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("_times") - F.col("_block") * RUN))
    return blocks.withColumn("_row", F.explode(inner)).drop("_times", "_block", "_row")


def row_digest(docs: DataFrame) -> Column:
    """A hash of all columns of a row that can be hashed."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return F.xxhash64(*[docs[c] for c in docs.columns if "map<" not in kinds[c] and "variant" not in kinds[c]])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and digest of every row, stored."""
    return stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_digest(docs).alias("digest")), "mixing-sizes")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    taken is size times copies. A null text has no words and a very long one counts whole;
    a null source is a source of its own, after all others; equal rows are rounded row by
    row, so their copies can differ by one. An empty table gives an empty result. Other
    columns tell equal rows apart only. Options are those of ``mix_sizes``.
    """
    units = mix_sizes(measured(docs), **options).withColumn("run", F.explode("runs"))
    return repeat(units, F.col("run.rows")).select(
        "doc_id", "source", "size", "source_size", "target", "run.copies", (F.col("size") * F.col("run.copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, with all their columns.

    What ``mix`` says of nulls, long texts, equal rows and empty tables holds here too.
    Equal rows are reduced to one, which is then written as often as all of them are taken.
    """
    total = F.aggregate("runs", F.lit(0).cast("long"), lambda sum_, x: sum_ + x["copies"] * x["rows"])
    units = mix_sizes(measured(docs), **options).select("doc_id", "source", "size", "digest", "rows", total.alias("total")).filter("total > 0").alias("u")
    key = ("doc_id", "source", "size", "digest")
    rows = docs.select(
        F.struct("*").alias("row"), docs["doc_id"].alias("doc_id"), docs["source"].alias("source"),
        word_count(docs["text"]).alias("size"), row_digest(docs).alias("digest"),
    ).alias("d")
    same = F.col("d.size") == F.col("u.size")
    for name in ("digest", "doc_id", "source"):
        same &= F.col(f"d.{name}").eqNullSafe(F.col(f"u.{name}"))
    taken = rows.join(units, same).select(*[f"d.{c}" for c in key], "d.row", "u.rows", "u.total")
    once = taken.filter("rows = 1").select("row", "total")
    equal = taken.filter("rows > 1").groupBy(*key).agg(F.first("row").alias("row"), F.first("total").alias("total")).select("row", "total")
    return repeat(once.unionByName(equal), F.col("total")).select("row.*")
