"""Similarity join of documents on word n-grams by Jaccard similarity, and its components.

1. Documents with one and the same set of n-grams become one record.
2. Of two sets with a Jaccard similarity of t or more, each misses at most k = |x| - ceil(t |x|) of the
   other's n-grams. So among the first k + l of each, in the order of their hashes, there are at
   least l common ones. Only this beginning of a set is counted and compared.
3. Within it the n-grams are ordered rare first, by the number of records that have them. Since
   l are common, the first common one lies before the last l - 1: that is the prefix on which
   records are joined. Sizes too far apart for t never meet (length filter), nor do records whose
   counts of n-grams in ranges of the hash differ by more than t allows (suffix filter).
4. Frequent n-grams would give a square of pairs. So first every record of a prefix list is compared
   with one of it, the list's hub; the links found give components. Then only those records that do
   not belong to a list's largest component are compared with the others of the list. A pair of
   one component needs no comparison, so no link between components is lost. Pairs of a short list
   are written down once, at the first n-gram that both prefixes have. Long lists are brought
   together by their hub in blocks, where overlaps are counted in place: only links come out.
5. Every pair left is verified once, on the whole sets, made again from the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from comarca.llm.common import (
    HOT_PARTS, attach, bounded, key_of, matched, rows_of, staged, staged_small, unmatched, unpacked,
)
from comarca.llm.components import connected_components
from comarca.llm.words import slices, word_codes

WORDS = 4
THRESHOLD = Fraction(85, 100)
RANGES = 32
HUBS = 3
# Lists with fewer records than this have one hub, longer ones one of HUBS by their n-gram.
LONG_LIST = 16
# Records on which frequent n-grams are found, and parts that these are dealt out to.
SAMPLE_RECORDS = 50_000
SALTS = 64
# Lists from this size on are compared in blocks; and how much meets in one place.
LONG_LIST_PAIRS = 64
BLOCK_RECORDS = 2_000
PART_GRAMS = 500_000
# Earlier n-grams of a prefix that are kept beside each, to tell repeated pairs.
EARLIER = 4
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(29), np.uint64(0xBF58476D1CE4E5B9), np.uint64(32))


def misses(size: int, threshold: Fraction) -> int:
    """How many n-grams of a set of this size a linked set may lack."""
    return size - math.ceil(threshold * size)


def beginning(size: int, threshold: Fraction) -> tuple[int, int]:
    """How long the compared beginning of a set is, and how many of it, rarest first, are the prefix.

    The common n-grams l in the beginnings are 1 + misses // 2 of the smaller set, which is at least
    ceil(threshold * size) large.
    """
    if size == 0:
        return 0, 0
    k = misses(size, threshold)
    smaller = misses(math.ceil(threshold * size), threshold)
    length = k + 1 + k // 2
    return length, length - smaller // 2


def shingle_sets(part: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of every text's word n-grams, A-Z in lower case.

    With fewer words than ``words`` the whole sequence is one n-gram; without a word there is none.
    """
    multiply, shift, last, fold = MIX
    codes, starts, distinct = word_codes(pc.ascii_lower(part))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    own = hashes[codes] if len(codes) else np.empty(0, np.uint64)

    def mixed(columns: list[np.ndarray]) -> np.ndarray:
        value = columns[0] * multiply
        for column in columns[1:]:
            value = ((value ^ (value >> shift)) + column) * multiply
        value = (value ^ (value >> fold)) * last
        return value ^ (value >> shift)

    count = len(own) - words + 1
    rolled = mixed([own[k : k + count] for k in range(words)]) if count > 0 else own[:0]
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:
            yield mixed([own[k : k + 1] for k in range(a, b)])
        else:
            yield own[:0]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of record batches whose last column is a text, and that column."""
    for batch in batches:
        at = 0
        for texts in slices(batch.columns[-1]):
            yield batch.slice(at, len(texts)), texts
            at += len(texts)


def _histogram(sets: np.ndarray) -> np.ndarray:
    """Counts of n-grams in equal ranges of the hash; the sets are sorted."""
    bounds = np.arange(1, RANGES, dtype=np.uint64) << np.uint64(64 - RANGES.bit_length() + 1)
    return np.diff(np.concatenate([[0], np.searchsorted(sets, bounds), [len(sets)]])).astype(np.int32)


def _lists(arrays: list[np.ndarray], kind: np.dtype) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(kind)))


def _records(words: int, threshold: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _parts(batches):
            sets = list(shingle_sets(texts, words))
            columns = [
                *batch.columns[:-1],
                pa.array([len(own) for own in sets], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None for own in sets], pa.binary()),
                _lists([own[: beginning(len(own), threshold)[0]] for own in sets], np.int64),
                _lists([_histogram(own) for own in sets], np.int32),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "key", "n", "set", "start", "hist"])

    return run


def _sets_of_texts(words: int):
    """Replaces the last column, texts, by their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _parts(batches):
            sets = _lists(list(shingle_sets(texts, words)), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sets], [*batch.schema.names[:-1], "set"])

    return run


def _similar(left: Column, right: Column, threshold: Fraction) -> Column:
    """Whether two sets, arrays without repeats, are as similar as the threshold."""
    common = F.size(F.array_intersect(left, right)).cast("long")
    return common * threshold.denominator >= (F.size(left) + F.size(right) - common) * threshold.numerator


def _block_links(threshold: Fraction):
    """For the records of a block: links between its components, by counting common n-grams.

    Each record outside the largest component is looked up in an index of the block's n-grams. What
    is found linked is joined at once, so that at most one link for each record comes out.
    """

    def run(block: pa.Table) -> pa.Table:
        block = block.take(np.unique(block["record"].to_numpy(), return_index=True)[1])
        sets = block["set"].combine_chunks()
        records, ranges, part = (block[c].to_numpy() for c in ("record", "range", "part"))
        low, high, slot = (block[c][0].as_py() for c in ("low", "high", "slot"))
        sizes = pc.list_value_length(sets).to_numpy()
        owner = np.repeat(np.arange(len(sets)), sizes)
        names, gram = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        order = np.argsort(gram, kind="stable")
        index = owner[order]
        begins = np.concatenate([[0], np.cumsum(np.bincount(gram, minlength=len(names)))])
        first = np.concatenate([[0], np.cumsum(sizes)])
        _, group = np.unique(block["component"].to_numpy(), return_inverse=True)
        largest = int(np.argmax(np.bincount(group)))
        found = []
        for x in np.flatnonzero(group != largest):
            own = gram[first[x] : first[x + 1]]
            listed = [index[begins[g] : begins[g + 1]] for g in own.tolist()]
            common = np.bincount(np.concatenate(listed), minlength=len(sets))
            union = sizes[x] + sizes - common
            linked = (threshold.denominator * common >= threshold.numerator * union) & (group != group[x])
            linked &= (np.maximum(ranges, ranges[x]) == slot) & ((part != part[x]) | (low == high))
            for y in np.flatnonzero(linked):
                if group[y] != group[x]:
                    found.append((int(records[x]), int(records[y])))
                    group[group == group[y]] = group[x]
        ends = zip(*found, strict=True) if found else ([], [])
        return pa.table([pa.array(end, pa.int64()) for end in ends], ["a", "b"])

    return run


def _misses(n: Column, threshold: Fraction) -> Column:
    """``misses`` as a column."""
    over = threshold.denominator - threshold.numerator
    return F.floor(n.cast("long") * over / F.lit(threshold.denominator)).cast("int")


def _near_sizes(n: Column, m: Column, threshold: Fraction) -> Column:
    """The length filter."""
    return F.least(n, m).cast("long") * threshold.denominator >= F.greatest(n, m).cast("long") * threshold.numerator


class _Join:
    """The steps of one join; see the module. What passes between them is stored."""

    def __init__(self, docs: DataFrame, id_column: str, text_column: str, words: int, threshold: Fraction):
        self.words, self.threshold = words, threshold
        text = F.coalesce(F.col(text_column), F.lit(""))
        texts = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
        # Id and key find a row's text again; rows that agree in both are equal.
        self.texts = texts.select("id", F.xxhash64("text").alias("key"), "text")
        shingled = self.texts.select(F.monotonically_increasing_id().alias("row"), "id", "key", "text").mapInArrow(
            _records(words, threshold),
            "row long, id long, key long, n int, set binary, start array<long>, hist array<int>",
        )
        self.rows = staged_small(shingled, "shingled")
        groups = self.rows.where("n > 0").groupBy("set").agg(
            F.min("row").alias("record"), F.min("id").alias("least"), F.count("*").alias("copies")
        )
        self.groups = staged(groups, "sets")

    def records(self) -> DataFrame:
        """One row for each set."""
        several = self.groups.where("copies > 1")
        members = attach(self.rows.where("n > 0").select("row", "set"), several, "set", "copies")
        copies = staged(members.where("row != record").select("row"), "copies")
        return self.rows.where("n > 0").join(bounded(copies), "row", "left_anti").withColumnRenamed("row", "record")

    def shared_grams(self, records: DataFrame) -> DataFrame:
        """The n-grams in the beginnings that at least two records have: gram, record, n, df.

        They are counted where they lie sorted, after one shuffle. N-grams that a bounded sample of
        records shows to be frequent are dealt out to salted parts and summed up in addition.
        """
        grams = records.select("record", "n", F.explode("start").alias("gram"))
        count = self.groups.count()
        step = max(1, count // SAMPLE_RECORDS)
        some = grams.where(F.pmod(F.xxhash64("record"), F.lit(step)) == 0).groupBy("gram").count()
        least = max(20, count // step // HOT_PARTS)
        hot = bounded(staged(some.where(F.col("count") >= least).select("gram", F.lit(SALTS).alias("parts")), "frequent"))
        salted = grams.join(hot, "gram", "left").withColumn(
            "salt", F.coalesce(F.pmod(F.xxhash64("record"), F.col("parts")), F.lit(0)).cast("int")
        )
        counted = salted.withColumn("df", F.count("*").over(Window.partitionBy("gram", "salt")))
        kept = counted.where(F.col("parts").isNotNull() | (F.col("df") > 1))
        kept = staged(kept.select("gram", "record", "n", "df", F.col("parts").isNotNull().alias("hot")), "shared-grams")
        sums = bounded(staged(kept.where("hot").groupBy("gram").agg(F.count("*").alias("all")), "hot-counts"))
        df = F.coalesce("all", "df").alias("df")
        return kept.join(sums, "gram", "left").select("gram", "record", "n", df).where("df > 1")

    def prefixes(self) -> DataFrame:
        """For each record its prefix, n-gram by n-gram: gram, df, record, n, rest, range, before, slot.

        ``rest`` is how many n-grams of the beginning come later, ``before`` has the last ones of the
        prefix. Records whose sizes are near enough lie in one range or two neighbouring ones,
        and share the slot of the larger.
        """
        n, t = F.col("n"), self.threshold
        k = _misses(n, t)
        smaller = _misses(n - k, t)
        length = k + 1 + F.floor(k / 2).cast("int")
        prefix = length - F.floor(smaller / 2).cast("int")
        alone = length - F.size("grams")  # rarest of all: no other record has them
        ranked = self.shared_grams(self.records()).groupBy("record").agg(
            F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("grams")
        )
        ranked = ranked.withColumns({"length": length, "alone": alone, "prefix": prefix})
        chosen = F.slice("grams", F.lit(1), F.greatest(F.col("prefix") - F.col("alone"), F.lit(0)))
        ranked = ranked.withColumn("chosen", F.transform(chosen, lambda x: x["gram"]))
        listed = ranked.select("record", "n", "length", "alone", "grams", "chosen", F.posexplode("chosen").alias("at", "gram"))
        before = F.slice("chosen", F.greatest(F.col("at") - (EARLIER - 1), F.lit(1)), F.least("at", F.lit(EARLIER)))
        rest = (F.col("length") - F.col("alone") - F.col("at") - 1).alias("rest")
        width = math.log(1 / t) * (1 + 1e-6) if t < 1 else 1e-9
        size = F.floor(F.log(n.cast("double")) / width).cast("int").alias("range")
        df = F.col("grams")[F.col("at")]["df"].cast("int").alias("df")
        prefixes = staged(listed.select("gram", df, "record", "n", rest, size, before.alias("before")), "prefixes")
        return prefixes.select("*", F.explode(F.array(F.col("range"), F.col("range") + 1)).alias("slot"))

    def near(self, rest: Column, other_rest: Column, n: Column, m: Column) -> Column:
        """Length filter and positional filter for two records at one n-gram of both prefixes.

        If it is their first common one, at most the n-grams that come later are common too.
        """
        least_common = F.floor(F.least(_misses(n, self.threshold), _misses(m, self.threshold)) / 2)
        return _near_sizes(n, m, self.threshold) & (F.least(rest, other_rest) >= least_common)

    def hub_pairs(self, prefixes: DataFrame) -> DataFrame:
        """Every record of a list with the list's hub."""
        turn = F.when(F.col("df") < LONG_LIST, 0).otherwise(F.pmod(F.col("gram"), F.lit(HUBS)))
        hub = F.min(F.struct(F.xxhash64("record", turn.cast("int")).alias("order"), "record", "n", "rest"))
        hubs = prefixes.groupBy("gram", "slot").agg(hub.alias("hub"), F.count("*").alias("size")).where("size > 1")
        joined = attach(prefixes, staged(hubs, "hubs"), ["gram", "slot"], "size")
        near = self.near(F.col("rest"), F.col("hub.rest"), F.col("n"), F.col("hub.n"))
        return self._pairs(joined.where((F.col("record") != F.col("hub.record")) & near), "record", "hub.record")

    def mixed(self, prefixes: DataFrame, components: DataFrame) -> DataFrame:
        """The lists that hold more than one component: their members, with the list's largest
        component, hub and size. Stored."""
        known = bounded(components.withColumnRenamed("node", "record"))
        own = F.coalesce("component", "record").alias("component")
        member = prefixes.join(known, "record", "left").select(*prefixes.columns, own)
        counts = member.groupBy("gram", "slot", "component").agg(
            F.count("*").alias("count"), F.min(F.struct(F.xxhash64("record").alias("order"), "record")).alias("hub")
        )
        lists = counts.groupBy("gram", "slot").agg(
            F.max(F.struct("count", "component"))["component"].alias("largest"),
            F.count("*").alias("components"), F.sum("count").alias("size"), F.min("hub")["record"].alias("hub"),
        ).where("components > 1").drop("components")
        return staged(attach(member, staged(lists, "lists"), ["gram", "slot"], "size"), "mixed")

    def cross_pairs(self, mixed: DataFrame) -> DataFrame:
        """The pairs of short lists that are not yet in one component."""
        short = mixed.where(F.col("size") < LONG_LIST_PAIRS)
        columns = ("record", "n", "rest", "range", "before", "component")
        some = short.where(F.col("component") != F.col("largest"))
        some = some.select("gram", "slot", *[F.col(c).alias(f"{c}_a") for c in columns])
        major = (F.col("component") == F.col("largest")).alias("major")
        every = short.select("gram", "slot", *[F.col(c).alias(f"{c}_b") for c in columns], major)
        near = self.near(F.col("rest_a"), F.col("rest_b"), F.col("n_a"), F.col("n_b"))
        once = (
            (F.col("component_a") != F.col("component_b"))
            & (F.col("major") | (F.col("record_a") < F.col("record_b")))
            & (F.greatest("range_a", "range_b") == some["slot"])
            & ~F.arrays_overlap("before_a", "before_b")
        )
        same = [some[c] == every[c] for c in ("gram", "slot")]
        return self._pairs(some.join(every, [*same, near & once]), "record_a", "record_b")

    def block_links(self, mixed: DataFrame) -> DataFrame:
        """Links between components in long lists, enough of them to connect what is linked."""
        long = mixed.where(F.col("size") >= LONG_LIST_PAIRS).groupBy("hub", "slot", "record").agg(
            F.first("n").alias("n"), F.first("range").alias("range"), F.first("component").alias("component")
        )
        long = staged(long, "long")
        parts = 1 + F.floor(F.greatest(F.count("*") / BLOCK_RECORDS, F.sum("n") / (4 * PART_GRAMS))).cast("int")
        blocks = long.groupBy("hub", "slot").agg(F.count("*").alias("size"), parts.alias("parts"))
        dealt = attach(long, staged(blocks, "blocks"), ["hub", "slot"], "size")
        part = F.pmod(F.xxhash64("record"), F.col("parts")).cast("int").alias("part")
        dealt = dealt.select("hub", "slot", "record", "range", "component", part, "parts")
        dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        low, high = F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
        dealt = dealt.select("hub", "slot", low, high, "record", "range", "component", "part")

        names = self.rows.select("row", "id", "key")
        wanted = long.select("record").distinct()
        wanted = staged(wanted.join(names, wanted["record"] == names["row"]).drop("row"), "wanted")
        sets = self._with_sets(wanted, "record long")
        met = dealt.join(sets, "record").groupBy("hub", "slot", "low", "high")
        return staged_small(met.applyInArrow(_block_links(self.threshold), "a long, b long").distinct(), "block-links")

    def _pairs(self, found: DataFrame, left: str, right: str) -> DataFrame:
        """Distinct pairs that pass the suffix filter."""
        pairs = found.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()
        pairs = staged(pairs, "met")
        hist = self.rows.select("row", "n", "hist")
        for side in ("a", "b"):
            own = hist.select(F.col("row").alias(side), F.col("n").alias(f"n_{side}"), F.col("hist").alias(f"hist_{side}"))
            pairs = pairs.join(own, side)
        apart = F.aggregate(
            F.zip_with("hist_a", "hist_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda total, x: total + x
        )
        # |x - y| + |y - x| is at most (1 - t) / (1 + t) of the sum of the sizes.
        t = self.threshold
        most = (F.col("n_a") + F.col("n_b")).cast("long") * (t.denominator - t.numerator)
        fits = apart.cast("long") * (t.denominator + t.numerator) <= most
        return staged(pairs.where(fits).select("a", "b", "n_a"), "candidates")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The linked ones of some stored pairs. A record with many partners is dealt out in parts."""
        sizes = pairs.groupBy("a").agg(F.count("*").alias("size"), F.max("n_a").alias("n"))
        parts = (1 + F.floor(F.col("size") * F.col("n") / PART_GRAMS)).cast("int").alias("parts")
        sizes = staged(sizes.select("a", "size", parts), "partners")
        dealt = attach(pairs.select("a", "b"), sizes, "a", "size")
        dealt = dealt.select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
        every = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        names = self.rows.select("row", "id", "key")
        left = staged(every.join(names, every["a"] == names["row"]).drop("row"), "left")
        right = staged(dealt.join(names, dealt["b"] == names["row"]).drop("row"), "right")
        a = self._with_sets(left, "a long, part int").withColumnRenamed("set", "set_a")
        b = self._with_sets(right, "a long, part int, b long")
        linked = a.join(b, ["a", "part"]).where(_similar(F.col("set_a"), F.col("set"), self.threshold))
        return staged_small(linked.select("a", "b"), "links")

    def _with_sets(self, wanted: DataFrame, schema: str) -> DataFrame:
        names = [c for c in wanted.columns if c not in ("id", "key")]
        texts = self.texts.select("key", key_of(F.col("id")).alias("name"), "text")
        listed = wanted.select("key", key_of(F.col("id")).alias("name"), *names)
        found = matched(texts, listed, ["key", "name"]).select(*names, "text")
        return found.mapInArrow(_sets_of_texts(self.words), f"{schema}, set array<long>")

    def components(self) -> DataFrame:
        """Of every linked record: node, component (numbers of records)."""
        prefixes = self.prefixes()
        links = self.verified(self.hub_pairs(prefixes))
        mixed = self.mixed(prefixes, connected_components(links))
        links = links.union(self.block_links(mixed)).union(self.verified(self.cross_pairs(mixed)))
        return connected_components(links)


def jaccard_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = WORDS,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """Which documents are connected by links of a Jaccard similarity of ``threshold`` or more. Runs jobs.

    Columns: id, key (hash of the text), n_shingles, component_id (the smallest id that can be reached over links,
    the own one included) and first_key (the key of the first row with that id). One row per row of ``docs``.

    A set holds the distinct n-grams of ``words`` words, A-Z in lower case; of fewer words the
    whole sequence is one; null and empty texts and those without a word have none and are
    linked with nothing. Equal sets are linked. Repeated rows and ids are records of one set each. Null
    ids come after all others: a component of null ids only has null. An empty table gives no
    rows. Other columns are not looked at. N-grams are compared by 64-bit hashes, equal sets
    by a 128-bit hash.
    """
    join = _Join(docs, id_column, text_column, words, threshold)
    components = join.components()
    named = bounded(components.withColumnRenamed("node", "record"))
    first = join.rows.groupBy("set").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first"))
    groups = join.groups.join(first, "set").join(named, "record", "left")
    groups = staged(groups.select("set", "copies", "component", "first"), "placed-sets")
    firsts = groups.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("first").alias("of_all"))
    firsts = bounded(staged(firsts, "firsts"))
    best = F.coalesce("of_all", "first").alias("first")
    groups = staged(groups.join(firsts, "component", "left").select("set", "copies", best), "answers")
    linked = attach(join.rows.where("n > 0").select("id", "key", "n", "set"), groups, "set", "copies")
    size = F.col("n").cast("long").alias("n_shingles")
    linked = linked.select("id", "key", size, F.col("first.id").alias("component_id"), F.col("first.key").alias("first_key"))
    alone = join.rows.where("n = 0").select(
        "id", "key", size, F.col("id").alias("component_id"), F.col("key").alias("first_key")
    )
    return linked.unionByName(alone)


def without_near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 5,
    threshold: Fraction = Fraction(8, 10),
) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Ids to drop are broadcast if they are few; else only rows that a filter of them lets pass are shuffled. Rows that share
    an id are told apart by their text; of equal ones with words, one stays. Documents without words
    all stay.
    """
    placed = staged(jaccard_components(docs, id_column, text_column, words, threshold), "placed")
    stays = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("first_key"))
    placed = placed.withColumn("stays", stays)
    per_id = placed.groupBy("id").agg(
        F.count("*").alias("rows"), F.count_if("stays").alias("keeps")
    )
    per_id = staged(per_id.where((F.col("rows") > 1) | (F.col("keeps") == 0)), "left-out")
    gone = per_id.select(key_of(F.col("id")).alias("name"))
    named = rows_of(docs).select("row", key_of(F.col("row").getField(id_column).cast("long")).alias("name"))
    kept = unpacked(unmatched(named, gone, ["name"]), docs.columns)
    if per_id.where("rows > 1").isEmpty():
        return kept
    several = per_id.where("rows > 1").select("id")
    row = F.col("row")
    text = F.coalesce(row.getField(text_column), F.lit(""))
    rows = rows_of(docs).select(
        "row", row.getField(id_column).cast("long").alias("id"), F.xxhash64(text).alias("key")
    )
    wanted = placed.join(several, placed["id"].eqNullSafe(several["id"]), "left_semi").where("stays")
    wanted = wanted.select("id", "key", (F.col("n_shingles") > 0).alias("one"))
    wanted = wanted.distinct()
    same = rows["id"].eqNullSafe(wanted["id"]) & (rows["key"] == wanted["key"])
    found = rows.join(wanted, same).select("row", rows["id"], rows["key"], "one")
    once = found.where("one").dropDuplicates(["id", "key"]).unionByName(found.where("not one"))
    return kept.unionByName(unpacked(once, docs.columns))
