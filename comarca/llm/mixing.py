"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by a hash of ids and texts, in proportion to its size, and gets a quota of
block draws that meets its target: whole rounds over all blocks, and a part of one more round. A
binary tree over the output shards splits the quotas of all sources: how many of a node's
draws go left is one multivariate-hypergeometric draw. A shard so gets its counts as if all draws
had been shuffled, and takes the next blocks in the source's permuted order; no block of a
round is drawn twice. Within a shard the documents are ordered by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comarca.llm.common import bounded, rows_of, staged, unpacked

BLOCKS = 4096
SHARDS = 16
WEIGHTS = (5, 2, 1)
MOST_ROUNDS = 3
# Different documents of a source that one task takes one by one.
FILL_ITEMS = 10_000
# Bits of the hash by which a bucket is cut again.
BITS = 10
# Groups of sources whose quotas are split on the driver; each group's are then split by a task.
SOURCE_GROUPS = 256
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_ROUNDS) -> DataFrame:
    """Shares of all words for each source, by weight, of at most ``most`` times its size.

    ``sizes`` has source and size. Weights repeat over the sources in code point order, null
    last. Sources that reach the limit get it, in the order in which a rising level of words per
    weight stops them; the level of the others is what is left by their weights.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.array(*[F.lit(float(w)) for w in weights])[turn]
    limited = sizes.select("source", "size", weight.alias("weight"), (F.col("size") * F.lit(most)).alias("limit"))
    stops = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = stops.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Frames that end at the last row are summed anew for every row, so what is to come is taken from the whole.
    earlier = stops.rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.coalesce(F.sum("limit").over(earlier), F.lit(0))
    going = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    level = (F.sum("size").over(everything) - stopped) / going
    leveled = limited.withColumn("level", level).withColumn("stops", F.col("limit") <= F.col("level") * F.col("weight"))
    # The level at the first source that does not stop holds for all after it, and is the highest of theirs.
    final = F.max(F.when(~F.col("stops"), F.col("level"))).over(everything)
    target = F.when(F.col("stops") | final.isNull(), F.col("limit")).otherwise(final * F.col("weight"))
    return leveled.select("source", F.col("size").alias("source_size"), target.cast("double").alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int | list[int] = 0, given: np.ndarray | None = None) -> np.ndarray:
    """Counts by (source, shard): every source's quota is split whole, every shard gets an equal
    number of draws, give or take one, or the ``given`` number."""
    counts = np.zeros((len(quotas), shards), dtype=np.int64)

    def split(own: np.ndarray, first: int, last: int) -> None:
        if last - first == 1:
            counts[:, first] = own
            return
        middle, total = (first + last) // 2, int(own.sum())
        share = total * (middle - first) // (last - first) if given is None else int(given[first:middle].sum())
        random = np.random.default_rng([*np.atleast_1d(seed), first, last])
        left = random.multivariate_hypergeometric(own, share) if total else own
        split(left, first, middle)
        split(own - left, middle, last)

    split(np.asarray(quotas, dtype=np.int64), 0, shards)
    return counts


CUTS = "sid long, length int, at long, room long"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Go through each source's buckets, the longest class first, and take those that fit whole.

    In each class only the buckets before the first that does not fit are taken. Yields that
    one for every class that has it, with what then is left of the source's room, and a row of length 0 for
    every source. Rows come sorted by source, falling length and bucket; one source's cuts are held.
    """
    source, room, cuts = None, 0, []

    def closed() -> list[tuple]:
        return [] if source is None else [(source, 0, 0, room), *[(source, *cut, room) for cut in cuts]]

    for batch in batches:
        rows = []
        for sid, length, at, words, left in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if sid != source:
                rows += closed()
                source, room, cuts = sid, left, []
            if cuts and cuts[-1][0] == length:
                continue
            if words <= room:
                room -= words
            else:
                cuts.append((length, at))
        yield _as_batch(rows, CUTS)
    yield _as_batch(closed(), CUTS)


ITEMS = "sid long, id long, digest long, block long, times long"


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the single texts of the last buckets fit, each as often as it can; and one more text,
    if with it the rest is nearer to the target than without. One source's texts are held."""
    held: list[tuple] = []

    def closed() -> list[tuple]:
        left = held[0][-1] if held else 0
        times = []
        for _, _, _, _, size, rows, _ in held:
            times.append(min(rows, left // size))
            left -= times[-1] * size
        over = [(row[4] - left, k) for k, row in enumerate(held) if times[k] < row[5]]
        if over and min(over)[0] < left:
            times[min(over)[1]] += 1
        return [(*row[:4], taken) for row, taken in zip(held, times, strict=True) if taken]

    for batch in batches:
        rows = []
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and held[0][0] != row[0]:
                rows += closed()
                held = []
            held.append(row)
        yield _as_batch(rows, ITEMS)
    yield _as_batch(closed(), ITEMS)


def _as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32()}
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    arrays = [pa.array(list(c), types[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _length_class(size: Column, left: Column) -> Column:
    """Classes of length by powers of two; 0 for what is longer than the room."""
    return F.when(size <= left, F.length(F.bin(size))).otherwise(0)


def _order(seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64("id", "digest", F.lit(seed + 1)), 1)


def _fill(blocked: DataFrame, table: DataFrame, seed: int, items: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What fills the room that a source's whole blocks leave of its target, out of all its later blocks.

    Documents no longer than the room come in classes of length, by powers of two, and in each
    class in permuted order: by the place of their block, then by a hash. From the longest class down,
    what fits is taken, until a bucket of equal place does not fit whole. That bucket is cut again by
    the next bits of the hash, in all classes at once, until a source has at most ``items`` different
    documents in cut buckets; these are taken one by one, and at last the shortest of each class that
    lies beyond. So no task holds more than that many documents of a source, or the sums of its buckets,
    and what is left at the end is less than any document left out.

    Gives the cuts (sid, length, cut_place, at, shift): what lies before is taken; the single texts (``ITEMS``) that
    are taken ``times`` times beside; and the documents of cut blocks.
    """
    left = table.where("cut").groupBy("sid").agg(F.bround(F.max("room")).cast("long").alias("left"))
    left = staged(left.where("left > 0"), "rooms")
    places = table.where("cut").select("sid", "block", "place").join(bounded(left), "sid")
    size, order = F.col("size"), _order(seed).alias("order")
    documents = (
        blocked.where("size > 0").join(bounded(staged(places, "cut-blocks")), ["sid", "block"])
        .select("sid", "id", "digest", "block", "size", F.col("place").cast("long").alias("place"), "left",
                _length_class(size, F.col("left")).alias("length"), order)
    )

    def cut(buckets: DataFrame, words: Column, room: str) -> DataFrame:
        sums = buckets.where("length > 0").groupBy("sid", "length", "at", F.col(room).alias("room"))
        sums = sums.agg(F.sum(words).cast("long").alias("words")).select("sid", "length", "at", "words", "room")
        ordered = sums.repartition("sid").sortWithinPartitions("sid", F.desc("length"), "at")
        return staged(ordered.mapInArrow(_cut, CUTS), "cuts")

    first = found = cut(documents.withColumn("at", F.col("place")), size, "left")
    rooms = left.select("sid", F.col("left").alias("room")).unionByName(found.where("length = 0").select("sid", "room"))
    own = found.where("length > 0").withColumnRenamed("at", "place")
    texts = documents.join(bounded(own), ["sid", "length", "place"])
    texts = texts.groupBy("sid", "length", "id", "digest", "block", "size", "order", "room").agg(F.count("*").alias("rows"))
    texts, shift, at = staged(texts, "cut-texts"), 63, F.lit(0).cast("long")
    while shift > BITS and (texts.groupBy("sid").count().agg(F.max("count")).first()[0] or 0) > items:
        shift -= BITS
        texts = texts.withColumn("at", F.shiftright("order", shift))
        found = cut(texts, size * F.col("rows"), "room")
        rooms, at = rooms.unionByName(found.where("length = 0").select("sid", "room")), F.col("at")
        texts = staged(texts.drop("room").join(bounded(found.where("length > 0")), ["sid", "length", "at"]), "cut-texts")

    cuts = first.where("length > 0").select("sid", "length", F.col("at").alias("cut_place"))
    last = found.where("length > 0").select("sid", "length", at.alias("at"), F.lit(shift).alias("shift"))
    cuts = staged(cuts.join(last, ["sid", "length"]), "cut-ends")
    beyond = (F.col("place") > F.col("cut_place")) | (
        (F.col("place") == F.col("cut_place")) & (F.shiftright("order", shift) > F.col("at"))
    )
    shortest = documents.join(bounded(cuts), ["sid", "length"], "left").where((F.col("length") == 0) | beyond)
    shortest = shortest.groupBy("sid", "length").agg(F.min(F.struct("size", "place", "order", "id", "digest", "block")).alias("least"))
    single = texts.select("sid", "length", "order", "id", "digest", "block", "size", "rows", F.lit(0).alias("late"))
    single = single.unionByName(
        shortest.select("sid", "length", "least.order", "least.id", "least.digest", "least.block", "least.size",
                        F.lit(1).cast("long").alias("rows"), F.lit(1).alias("late"))
    ).join(rooms.groupBy("sid").agg(F.min("room").alias("room")), "sid")
    single = single.repartition("sid").sortWithinPartitions("sid", F.desc("length"), "late", "order", "id", "digest")
    single = single.select("sid", "id", "digest", "block", "size", "rows", "room").mapInArrow(_fit, ITEMS)
    return cuts, staged(single, "single"), documents


def _before_cut(place: Column, shifted: Column) -> Column:
    """Whether a document of a class of length lies before the class's cut, or the class has none."""
    inside = (place == F.col("cut_place")) & (shifted < F.col("at"))
    return F.col("cut_place").isNull() | (place < F.col("cut_place")) | inside


def _rows_of_texts(blocked: DataFrame, single: DataFrame) -> DataFrame:
    """As many rows of each single text as are taken, the first ones. Rows are counted in each task of
    the first table and then over the tasks, so many copies of one text are not gathered."""
    listed = bounded(single.select("sid", F.col("id").alias("of"), "digest", "times"))
    same = (blocked["sid"] == listed["sid"]) & (blocked["digest"] == listed["digest"]) & blocked["id"].eqNullSafe(listed["of"])
    rows = blocked.join(listed, same).select("row", blocked["sid"], "id", blocked["digest"], "times")
    rows = staged(rows.withColumn("task", F.shiftright("row", 33)), "item-rows")
    item = ["sid", "id", "digest"]
    earlier = Window.partitionBy(item).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = rows.groupBy(*item, "task").agg(F.count("*").alias("count"), F.min("row").alias("row"))
    # The first row of a task carries how many there are in the tasks before.
    before = tasks.select("row", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy(*item, "task").orderBy("row")
    place = F.row_number().over(inside) - 1 + F.max("earlier").over(inside)
    return rows.join(before, "row", "left").withColumn("nth", place).where("nth < times").select("row")


def mix_plan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    shards: int = SHARDS,
    blocks: int = BLOCKS,
    seed: int = 0,
    items: int = FILL_ITEMS,
) -> DataFrame:
    """How often each row is taken, and into which output shards. Runs jobs; the result is stored.

    Columns: id, row, source, digest (hash of the text), size (words), source_size, target (of the source), copies, and
    shards (an array with the output shard of every copy).

    Words are runs of other characters than blank and 0x09 to 0x0D; null texts have none. See
    ``source_targets`` for the targets: all words, by weight, of at most three times a
    source's own. A source's rounds over all its blocks and the blocks of its part round sum
    up to its target, give or take less than any document that was left out of the part round, or
    half of the one that went over; what whole blocks leave is filled from all the later ones,
    see ``_fill``, of which a task holds at most ``items`` documents of a source. Equal input gives equal output, whatever its layout, except that copies
    of one row may swap. Null ids and null sources are values. A text without words goes with whole
    rounds and whole blocks; a source without a word is taken no time. A text of any length is one row. An empty table gives no rows. Other columns are not looked at.

    There are about ``blocks`` blocks in all, at most twice as many and one for each source, so their
    table is small and every block a small share of the words and of the rows.
    """
    words = staged(
        docs.select(
            F.col(id_column).cast("long").alias("id"), F.col(source_column).alias("source"),
            F.xxhash64(text_column).alias("digest"), word_count(F.col(text_column)).alias("size"), F.monotonically_increasing_id().alias("row"),
        ),
        "words",
    )
    sizes = words.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    sizes = staged(sizes, "source-sizes")
    all_words, all_rows = sizes.agg(
        F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))
    ).first()
    targets = source_targets(sizes.select("source", "size"))
    share = F.greatest(F.col("size") / max(all_words, 1), F.col("rows") / max(all_rows, 1))
    planned = sizes.withColumn("blocks", F.greatest(F.lit(1), F.ceil(share * blocks)).cast("long"))
    same = planned["source"].eqNullSafe(targets["source"])
    planned = planned.join(targets, same).drop(targets["source"]).drop("size")
    planned = staged(planned.withColumn("sid", F.monotonically_increasing_id()), "planned")

    # One row for each source: joined by broadcast if they are few.
    few = bounded(planned)
    block = F.pmod(F.xxhash64("id", "digest", F.lit(seed)), F.col("blocks"))
    blocked = words.join(few, words["source"].eqNullSafe(few["source"])).drop(few["source"])
    blocked = staged(
        blocked.select("sid", "id", "row", words["source"], "digest", "size", "source_size", "target", block.alias("block")),
        "blocked",
    )

    # A row for each block: where it lies in its source's permuted order, and how much of it goes.
    permuted = Window.partitionBy("sid").orderBy(F.xxhash64("source", "block", F.lit(seed)), "block")
    earlier = permuted.rowsBetween(Window.unboundedPreceding, -1)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    part = F.col("target") - rounds * F.col("source_size")
    reached = F.coalesce(F.sum("words").over(earlier), F.lit(0))
    table = (
        blocked.groupBy("sid", "source", "block", "source_size", "target")
        .agg(F.sum("size").alias("words"))
        .withColumns({"place": F.row_number().over(permuted) - 1, "room": part - reached, "rounds": rounds})
        .withColumn("whole", (part > 0) & (F.col("words") <= F.col("room")))
        .withColumn("cut", (part > 0) & ~F.col("whole"))
    )
    table = staged(table, "blocks")

    # What fits of the blocks after those that go whole, and which of them it is in.
    cuts, single, documents = _fill(blocked, table, seed, items)
    before = documents.where("length > 0").join(bounded(cuts), ["sid", "length"], "left")
    before = before.where(_before_cut(F.col("place"), F.expr("shiftright(order, coalesce(shift, 0))"))).select("sid", "block")
    filled = staged(before.unionByName(single.select("sid", "block")).distinct(), "filled")
    filled = bounded(filled).withColumn("filled", F.lit(True))
    kind = F.when(F.col("whole"), 2).when(F.col("filled"), 1).otherwise(0)
    drawing = Window.partitionBy("sid").orderBy("place")
    table = (
        table.join(filled, ["sid", "block"], "left").withColumn("part", kind)
        .withColumn("part_place", F.sum(F.when(F.col("part") > 0, 1).otherwise(0)).over(drawing) - 1)
        .withColumn("left", F.bround(F.max(F.when(F.col("cut"), F.col("room"))).over(Window.partitionBy("sid"))).cast("long"))
    )
    drawn = staged(_draw(staged(table, "parts"), shards, seed), "drawn")

    # Whole rounds; the part round takes whole blocks, what lies before the cuts, and single texts.
    extra = bounded(staged(_rows_of_texts(blocked, single), "extra-rows")).withColumn("extra", F.lit(True))
    joined = blocked.join(bounded(drawn), ["sid", "block"]).withColumn("length", _length_class(F.col("size"), F.col("left")))
    joined = joined.join(bounded(cuts), ["sid", "length"], "left").join(extra, "row", "left").withColumn("order", _order(seed))
    fits = (F.col("length") > 0) & _before_cut(F.col("place"), F.expr("shiftright(order, coalesce(shift, 0))"))
    fits = (F.col("size") > 0) & (F.col("left") > 0) & (fits | F.col("extra").isNotNull())
    whole = F.col("rounds").cast("int")
    copies = whole + F.when((F.col("part") == 2) | ((F.col("part") == 1) & fits), 1).otherwise(0)
    return staged(
        joined.select(
            "id", "row", "source", "digest", "size", "source_size", "target", copies.alias("copies"),
            F.slice("shards", F.lit(1), copies).alias("shards"),
        ),
        "mix-plan",
    )


def _draw(table: DataFrame, shards: int, seed: int) -> DataFrame:
    """The output shards of every block, one for each time that it is drawn.

    Sources fall into ``SOURCE_GROUPS`` groups by a hash. The quotas of the groups are split on the driver; the draws that
    a group has in a node are then split among its sources, group by group in parallel, which is the same law as one draw
    over all sources. The draws of a source are
    numbered through its rounds, in permuted order; a shard takes the next ones.
    """
    per_source = table.groupBy("sid", "source").agg(
        F.count("*").alias("n"), F.max("rounds").alias("rounds"), F.count_if(F.col("part") > 0).alias("parts")
    )
    name = F.xxhash64("source")
    quota = (F.col("n") * F.col("rounds") + F.col("parts")).cast("long").alias("quota")
    quotas = staged(
        per_source.select("sid", "n", quota, name.alias("name"), F.pmod(name, F.lit(SOURCE_GROUPS)).alias("group")), "quotas"
    )
    sums = quotas.groupBy("group").agg(F.sum("quota").alias("quota")).orderBy("group").toPandas()
    shares = dict(zip(sums["group"], split_quotas(sums["quota"].to_numpy(np.int64), shards, seed), strict=True))

    def split(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(key, "ascending") for key in ("name", "n", "quota")])
        group = rows["group"][0].as_py()
        counts = split_quotas(rows["quota"].to_numpy(), shards, [seed, group + 1], shares[group])
        ends = pa.array(list(np.cumsum(counts, axis=1)), pa.list_(pa.int64()))
        return pa.table([rows["sid"], rows["n"], ends], ["sid", "n", "ends"])

    ends = staged(quotas.groupBy("group").applyInArrow(split, "sid long, n long, ends array<long>"), "quota-ends")
    known = table.join(bounded(ends), "sid")
    times = F.col("rounds").cast("int") + F.when(F.col("part") > 0, 1).otherwise(0)
    turn = F.when(F.col("part") > 0, F.col("part_place"))
    at_place = lambda k: k * F.col("n") + F.when(k < F.col("rounds"), F.col("place")).otherwise(turn)
    number = F.transform(F.sequence(F.lit(0), times), at_place)
    number = F.slice(number, F.lit(1), times)
    shard = F.transform(number, lambda at: F.size(F.filter(F.col("ends"), lambda end: end <= at)))
    return known.select("sid", "block", "place", "left", "rounds", "part", shard.alias("shards"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    shards: int = SHARDS,
    seed: int = 0,
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Rows are ranged by output shard, and shuffled within by a hash of id, text and copy; a large
    shard spans several partitions, one after the other. Every row is taken as ``mix_plan`` says; of rows that are equal in id, source and text any may
    be the ones that are taken once more than the others.
    """
    plan = mix_plan(docs, id_column, text_column, source_column, shards, seed=seed)
    # Equal rows lie in one block, so their plans differ by one copy at most.
    alike = plan.groupBy("id", "source", "digest").agg(
        F.max_by("shards", "copies").alias("shards"), F.min("copies").alias("least"),
        (F.sum("copies") - F.count("*") * F.min("copies")).alias("more"),
    )
    taken = staged(alike.where(F.size("shards") > 0), "taken")
    rows = rows_of(docs)
    known = {
        "id": rows["row"].getField(id_column).cast("long"), "source": rows["row"].getField(source_column),
        "digest": F.xxhash64(rows["row"].getField(text_column)),
    }
    keyed = rows.select("row", *[value.alias(f"row_{name}") for name, value in known.items()])

    def with_plan(plans: DataFrame) -> DataFrame:
        own = [keyed[f"row_{name}"].eqNullSafe(plans[name]) for name in known]
        return keyed.join(bounded(plans), own).select("row", "id", "source", "digest", "shards", "least", "more")

    chosen = with_plan(taken.where("more = 0"))
    uneven = taken.where("more > 0")
    if not uneven.isEmpty():
        numbered = staged(with_plan(uneven).withColumn("number", F.monotonically_increasing_id()), "uneven")
        place = F.row_number().over(Window.partitionBy(*known).orderBy("number"))
        first = numbered.select("number", "more", place.alias("place")).where("place <= more").select("number")
        first = bounded(staged(first, "once-more")).withColumn("first", F.lit(True))
        own = F.when(F.col("first"), F.col("shards")).otherwise(F.slice("shards", F.lit(1), F.col("least")))
        chosen = chosen.unionByName(numbered.join(first, "number", "left").withColumn("shards", own).select(*chosen.columns))
    copies = chosen.select("row", "id", "digest", F.posexplode("shards").alias("copy", "shard"))
    order = F.xxhash64("id", "digest", "copy", F.lit(seed))
    dealt = copies.repartitionByRange("shard", order).sortWithinPartitions("shard", order)
    return unpacked(dealt, docs.columns)
