"""The operators on training documents against plain Python on small tables."""

import json
import random
import re
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from comarca.llm import QUERIES
from comarca.llm import jaccard_join as jj
from comarca.llm import sharding
from comarca.llm.components import connected_components
from comarca.llm.exact_dedup import DigestIndex, digests, exact_dedup, without_copies
from comarca.llm.jaccard_join import beginning, jaccard_components, misses, without_near_copies
from comarca.llm.language import fair_share, identify_languages, learn_languages
from comarca.llm.mixing import mix, mix_plan, split_quotas
from comarca.llm.packing import Packer, encode_document, pack_documents, split_text
from comarca.llm.quality_model import isotonic, learn_quality, score_quality
from comarca.llm.quality_rules import judge_quality
from comarca.llm.sharding import shard_by_bytes
from comarca.llm.toxicity import learn_toxicity, maximal_segments, score_toxicity, without_toxic
from comarca.llm.url_rules import judge_urls, rule_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, row string, id string, digest int, _salt int"
SF = "/root/testdata/sf0.001"


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    random.seed(1)
    some = [" ".join(random.choice("ab cd ef gh Ij kl, mn".split()) + str(random.randrange(400)) for _ in range(n)) for n in (3, 4, 60, 61, 300)]
    texts = [*some, *some, some[4] + " tail", None, "", "  \n\t", "É 日本 <|endoftext|> x", "w " * 20_000]
    rows = [(k, t, random.choice(["en", "de", None]), random.choice(["s1", "s2", None]), "r", "i", 1, 2) for k, t in enumerate(texts)]
    return [*rows, rows[2], (None, some[2], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(k, k % 2, (k + 1) % 2) for k in range(16)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"
    )


# Exact dedup ---------------------------------------------------------------------------


def test_exact_dedup_on_odd_rows(spark, odd, none):
    rows, found = odd_rows(), exact_dedup(odd).collect()
    assert len(found) == len(rows) and exact_dedup(none).count() == 0
    groups = Counter(r[1] or "" for r in rows)
    assert sum(r["kept"] for r in found) == len(groups)
    largest = {}
    for r in rows:
        if r[0] is not None:
            largest[r[1] or ""] = max(largest.get(r[1] or "", -1), r[0])
    assert {r["keep_id"] for r in found} == set(largest.values())
    assert sorted(r["group_size"] for r in found) == sorted(groups[r[1] or ""] for r in rows)
    kept = without_copies(odd)
    assert kept.columns == odd.columns
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter(groups.keys())
    assert without_copies(none).count() == 0


def test_the_index_lasts(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    index = DigestIndex.open(spark, str(tmp_path / "index"), 4)
    assert sorted(r["id"] for r in exact_dedup(docs, index=index).where("kept").collect()) == [2, 3]
    again = DigestIndex.open(spark, str(tmp_path / "index"), 4)
    more = spark.createDataFrame([(9, "a"), (10, "c")], "doc_id long, text string")
    found = {r["id"]: (r["keep_id"], r["kept"]) for r in exact_dedup(more, index=again).collect()}
    assert found == {9: (3, False), 10: (10, True)}
    assert again.entries().count() == 3
    plan = digests(more).join(again.entries().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


# Packing -------------------------------------------------------------------------------


def hugging_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_tokenizer_file(text):
    assert encode_document(text, "byte_bpe_50k").tolist() == hugging_ids(text)


@given(st.text(alphabet="ab1 .\n\té", max_size=200), st.integers(1, 20))
@settings(max_examples=100, deadline=None)
def test_long_texts_are_cut_between_tokens(text, size):
    parts = list(split_text(text, size))
    assert "".join(parts) == text
    assert [i for p in parts for i in hugging_ids(p)[:-1]] == hugging_ids(text)[:-1]


@given(st.lists(st.integers(1, 5000), max_size=80))
@settings(max_examples=100, deadline=None)
def test_sequences_are_full(lengths):
    packer, done = Packer(), []
    for k, length in enumerate(lengths):
        done.extend(packer.add(k, length))
    done.extend(packer.pack(final=True))
    covered = {k: [] for k in range(len(lengths))}
    for size, pieces in done:
        assert size & (size - 1) == 0 and size <= 1024 and sum(p[0] for p in pieces) == size
        for length, k, start in pieces:
            covered[k].append((start, length))
    for k, spans in covered.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == lengths[k]


def test_packing_on_odd_rows(odd, none):
    assert pack_documents(none).count() == 0
    found = pack_documents(odd).collect()
    wanted = Counter(tuple(hugging_ids(r[1])) for r in odd_rows())
    assert sum(r["length"] for r in found) == sum(len(ids) * n for ids, n in wanted.items())
    places = {}
    for r in found:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["tier"]))
    for spans in places.values():
        at = 0
        for offset, length, _ in sorted(spans):
            assert offset == at
            at += length
        assert at == spans[0][2]


# Sharding ------------------------------------------------------------------------------


def test_sharding_on_odd_rows(odd, none):
    assert shard_by_bytes(none).count() == 0
    found = shard_by_bytes(odd, shards=3, ranges=64).collect()
    wanted = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in found) == wanted
    for shard in range(3):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_shards_are_even_and_keep_equal_texts_together(spark):
    random.seed(2)
    rows = [(k, f"{random.randrange(1500)} " * random.randrange(1, 40)) for k in range(3000)]
    rows += [(5000 + k, "a hot text " * 5) for k in range(2000)]
    found = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), ranges=512).collect()
    sizes = Counter()
    shards = {}
    texts = dict(rows)
    for r in found:
        sizes[r["shard"]] += r["size"]
        shards.setdefault(texts[r["id"]], set()).add(r["shard"])
    assert len(sizes) == 16 and max(sizes.values()) < 1.03 * min(sizes.values())
    assert [t for t, s in shards.items() if len(s) > 1] == ["a hot text " * 5]


# Mixing --------------------------------------------------------------------------------


def test_ranges_are_bounded_in_rows(spark, monkeypatch):
    seen = {}
    stage = sharding.staged
    monkeypatch.setattr(sharding, "staged", lambda table, name: seen.setdefault(name, stage(table, name)))
    rows = [(None, None) for _ in range(3000)] + [(k, "") for k in range(3000)]
    rows += [(k, f"{k} " + "long " * 40) for k in range(3000, 6000)]
    rows += [(k, "twice " * 4000) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = shard_by_bytes(docs, shards=4, ranges=64).collect()
    assert max(r["count"] for r in seen["ranged"].groupBy("range").count().collect()) < 9000 / 64 * 5
    assert len(out) == len(rows) and len({r["shard"] for r in out if r["size"] == 1}) == 1
    for shard in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    monkeypatch.undo()
    again = shard_by_bytes(docs.coalesce(1), shards=4, ranges=64).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


@pytest.mark.parametrize("first", ["none", "all in one place"])
def test_overfull_ranges_are_subdivided_after_a_bad_draw(spark, monkeypatch, first):
    rows = [(k, f"{k} " + "long " * (k % 60)) for k in range(4000)] + [(None, None)] * 600
    rows += [(9000 + k, "the same text " * 9) for k in range(1500)] + [(9999, "huge " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    wanted = Counter(map(tuple, shard_by_bytes(docs, shards=5, ranges=48).collect()))
    draw, stage, calls, tables = sharding._splitters, sharding.staged, [], []

    def adversarial(*arguments):
        keys, often = draw(*arguments)
        calls.append(len(keys))
        if len(calls) > 1:
            return keys, often
        return (keys[:0] if first == "none" else np.sort(keys)[:3]), often[:0]

    def kept(table, name):
        stored = stage(table, name)
        tables.extend([stored] * (name == "ranged"))
        return stored

    monkeypatch.setattr(sharding, "_splitters", adversarial)
    monkeypatch.setattr(sharding, "staged", kept)
    found = Counter(map(tuple, shard_by_bytes(docs, shards=5, ranges=48).collect()))
    sizes = tables[-1].groupBy("range").agg(F.sum("size") - F.max("size"), F.count("*")).toDF("range", "bytes", "rows").collect()
    total = sum(len((text or "").encode()) + 1 for _, text in rows)
    assert len(calls) > 2 and max(r["bytes"] for r in tables[0].groupBy("range").agg(F.sum("size").alias("bytes")).collect()) > total / 2
    assert max(r["rows"] for r in sizes) <= 2 * len(rows) / 48 and max(r["bytes"] for r in sizes) <= 2 * total / 48
    assert found == wanted


def wanted_targets(sizes):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = total - sum(stopped.values())
        going = [s for s in names if s not in stopped]
        level = rest / sum(weight[s] for s in going) if going else 0
        over = [s for s in going if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {s: stopped.get(s, level * weight[s]) for s in names}
        stopped |= {s: 3 * sizes[s] for s in over}


def test_mixing(spark, odd, none):
    assert mix_plan(none).count() == 0 and mix(none).count() == 0
    random.seed(3)
    rows = [(k, "w " * random.randrange(1, 60), random.choice(["b", "B", "é", "hot", "hot", "hot", None])) for k in range(2000)]
    rows += [(9000, "x " * 5, "tiny"), (9001, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_plan(docs, shards=4).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    targets, taken = wanted_targets(dict(sizes)), Counter()
    for r in plan:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - targets[r["source"]]) < 1e-6 * max(1, r["target"])
        assert 0 <= r["copies"] <= 3 and len(r["shards"]) == r["copies"] and all(0 <= s < 4 for s in r["shards"])
        taken[r["source"]] += r["copies"] * r["size"]
    for s, target in targets.items():
        assert abs(taken[s] - target) <= max(30, 0.01 * target)
    again = mix_plan(docs.repartition(7), shards=4).collect()
    key = lambda r: (r["id"], r["copies"], r["shards"])
    assert sorted(map(key, again)) == sorted(map(key, plan))
    assert mix(docs, shards=4).count() == sum(r["copies"] for r in plan)
    assert len(mix_plan(odd).collect()) == len(odd_rows()) and mix(odd).columns == odd.columns


def test_targets_are_met_around_long_documents(spark):
    rows = [(k, "w " * 20, f"s{k % 12:02}") for k in range(18_000)]
    rows += [(20_000 + k, "w " * 24_000, f"s{k:02}") for k in range(12)]
    plan = mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string"), shards=4, blocks=96)
    left_out = F.when(F.col("copies") == F.floor(F.col("target") / F.col("source_size")), F.col("size"))
    taken = F.sum(F.col("copies") * F.col("size")).alias("taken")
    found = plan.groupBy("source").agg(taken, F.max("target").alias("target"), F.min(left_out).alias("left")).collect()
    assert sum(r["left"] == 20 for r in found) >= 6
    for r in found:  # with all short documents taken, the long one is in or out, whichever is nearer
        assert abs(r["taken"] - r["target"]) < (20 if r["left"] == 20 else 12_001)
    assert plan.where("exists(shards, s -> s < 0 or s > 3) or size(shards) != copies").count() == 0


def test_ids_that_are_null_or_of_several_rows_are_mixed_by_row(spark):
    rows = [(None if k % 2 else k // 8, "w " * (1 + k % 9) + str(k % 700), f"s{k % 3}") for k in range(4200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mix_plan(docs, shards=4)
    wanted, taken = Counter(), Counter()
    for r in plan.collect():
        wanted[r["source"]] += r["copies"] * r["size"]
    for r in mix(docs, shards=4).collect():
        taken[r["source"]] += len(WORD.findall(r["text"]))
    assert taken == wanted
    targets = plan.groupBy("source").agg(F.max("target").alias("target")).collect()
    assert all(abs(taken[r["source"]] - r["target"]) <= 10 for r in targets)
    hot = spark.createDataFrame([(None, f"w {k}", "s") for k in range(1000)] + [(k, "w w", "t") for k in range(1000)], docs.schema)
    parts = mix_plan(hot, shards=4).where("id is null").groupBy("shards").count().collect()
    assert len(parts) > 2 and max(r["count"] for r in parts) < 600


def test_the_fill_is_tight_when_buckets_are_cut_to_single_texts(spark):
    random.seed(8)
    rows = [(k, f"w{k} " * random.choice([1, 3, 20, 70, 400]), random.choice("abbbbccccc")) for k in range(4000)]
    rows += [(None, "copy " * 9, "c")] * 600
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    sizes = Counter()
    for plan in (mix_plan(docs, shards=4, blocks=6, items=3).collect(), mix_plan(docs.coalesce(1), shards=4, blocks=6, items=3).collect()):
        by_source = Counter()
        for r in plan:
            by_source[r["source"]] += r["copies"] * r["size"]
        for name, taken in by_source.items():
            own = [r for r in plan if r["source"] == name]
            target, rounds = own[0]["target"], int(own[0]["target"] // own[0]["source_size"])
            assert {r["copies"] for r in own} <= {rounds, rounds + 1}
            left_out = [r["size"] for r in own if r["copies"] == rounds]
            last = [r["size"] for r in own if r["copies"] > rounds]
            if taken <= target:
                assert not left_out or target - taken < min(left_out) + 1
            else:
                assert taken - target <= max(last) / 2 + 1
        sizes[tuple(sorted((r["id"] or -1, r["copies"]) for r in plan))] += 1
    assert len(sizes) == 1  # the layout does not matter


def test_many_sources_are_mixed(spark):
    docs = spark.range(100_000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 7 AS int)) AS text", "concat('s', id) AS source")
    plan = mix_plan(docs, shards=4, blocks=64)
    over = F.abs(F.col("copies") * F.col("size") - F.col("target")) > F.col("size") / 2 + 1
    found = plan.agg(F.count("*"), F.count_if(over), F.sum(F.col("copies") * F.col("size")), F.sum("size")).first()
    assert found[:2] == (100_000, 0) and abs(found[2] / found[3] - 1) < 0.3
    drawn = plan.select(F.explode("shards").alias("shard")).groupBy("shard").count().collect()
    assert len(drawn) == 4 and max(r["count"] for r in drawn) - min(r["count"] for r in drawn) <= 2


def test_a_shard_of_the_mix_may_span_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.createDataFrame([(k, f"w {k}", "s") for k in range(4000)], "doc_id long, text string, source string")
        sizes = mix(docs, shards=1).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1500


def test_quotas_of_a_group_are_split_as_given():
    given = np.array([5, 0, 30, 1])
    counts = split_quotas(np.array([20, 0, 15, 1]), 4, seed=[3, 1], given=given)
    assert counts.sum(axis=0).tolist() == given.tolist() and counts.sum(axis=1).tolist() == [20, 0, 15, 1]


def test_quotas_are_split_whole():
    counts = split_quotas(np.array([100, 0, 7, 1]), 5, seed=1)
    assert counts.sum(axis=1).tolist() == [100, 0, 7, 1]
    assert counts.min() >= 0 and np.ptp(counts.sum(axis=0)) <= 2


# Quality, toxicity, language -------------------------------------------------------------


def test_quality_rules_on_odd_rows(odd, none, labels):
    assert judge_quality(none, labels).count() == 0
    found = judge_quality(odd, labels).collect()
    wanted = []
    for r in odd_rows():
        text = r[1] or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = Counter(windows)
        covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
        base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        wanted.append((r[0], *base, len(words) < 50 or 100 * len(covered) > 50 * len(words)))
    got = [tuple(r[c] for c in ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in found]
    assert Counter(got) == Counter(wanted)
    assert not any(r["kept"] and r["base_failed"] for r in found)


def brute_segments(scores):
    """Maximal segments by definition: the best segment, then left and right of it."""
    best, span = 0, None
    for a in range(len(scores)):
        for b in range(a, len(scores)):
            if sum(scores[a : b + 1]) > best:
                best, span = sum(scores[a : b + 1]), (a, b)
    if span is None:
        return []
    a, b = span
    return [*brute_segments(scores[:a]), (a, b, best), *[(x + b + 1, y + b + 1, s) for x, y, s in brute_segments(scores[b + 1 :])]]


@given(st.lists(st.integers(-40, 40), max_size=14))
@settings(max_examples=200, deadline=None)
def test_segments_are_those_of_the_definition(steps):
    scores = [s + (k + 1) / 1000 for k, s in enumerate(steps)]  # no ties
    assert [s for *_, s in maximal_segments(np.array(scores))] == pytest.approx([s for *_, s in brute_segments(scores)])


def test_long_texts_are_searched_in_linear_time():
    began = time.process_time()
    found = maximal_segments(np.tile([1.0, -2.0], 30_000))
    assert found == [(2 * k, 2 * k, 1.0) for k in range(30_000)]
    assert time.process_time() - began < 3


def learned_rows():
    random.seed(4)
    clean = [f"w{k}" for k in range(300)]
    rows, marks = [], []
    for k in range(1500):
        toxic, low = random.random() < 0.3, random.random() < 0.3
        words = [random.choice(clean) for _ in range(random.randrange(20, 200))]
        if toxic:
            at = random.randrange(len(words))
            words[at:at] = random.choices(["foul", "vile", "nasty"], k=5)
        text = " ".join(words)
        rows.append((k, text.upper() + " !!" if low else text))
        marks.append((k, int(not low), int(toxic)))
    return rows, marks


def test_scores_hold_on_documents_held_out(spark, odd, none, labels):
    rows, marks = learned_rows()
    docs, truth = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0}
    quality, toxic = {k: q for k, q, _ in marks}, {k: t for k, _, t in marks}
    model = learn_toxicity(docs, truth)
    found = {r["id"]: r for r in score_toxicity(docs, model).collect()}
    assert np.mean([found[k]["predicted"] == toxic[k] for k in held]) > 0.97
    assert without_toxic(docs, truth).count() == sum(r["predicted"] == 0 for r in found.values())
    scored = {r["id"]: r for r in score_quality(docs, learn_quality(docs, truth)).collect()}
    assert np.mean([scored[k]["predicted"] == quality[k] for k in held]) > 0.97
    for table in (odd, none):
        for own in (score_toxicity(table, learn_toxicity(table, labels)), score_quality(table, learn_quality(table, labels))):
            got = own.collect()
            assert len(got) == table.count() and all(0 <= r["score"] <= 1 for r in got)
    assert without_toxic(odd, labels).columns == odd.columns


@given(st.lists(st.tuples(st.floats(-5, 5), st.integers(0, 1)), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_isotonic_rises(points):
    x, y = np.array([p[0] for p in points]), np.array([p[1] for p in points], float)
    corners, heights = isotonic(x, y)
    assert (np.diff(corners) >= 0).all() and (np.diff(heights) >= 0).all() and 0 <= heights[0] and heights[-1] <= 1


def test_languages(spark, odd, none):
    random.seed(5)
    sounds = {"aa": "the and ing tion", "bb": "sch ein und ßen", "cc": "eau ique é les"}
    rows = [(k, " ".join("".join(random.choices(sounds[n].split(), k=3)) for _ in range(30)), n) for k, n in enumerate(random.choices(list(sounds), k=600))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn_languages(docs)
    found = {r["id"]: r["lang_pred"] for r in identify_languages(docs, model).collect()}
    held = [(k, n) for k, _, n in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([found[k] == n for k, n in held]) > 0.98
    got = identify_languages(odd, model).collect()
    assert len(got) == len(odd_rows())
    letters = Counter(any(c.isalpha() for c in r[1] or "") for r in odd_rows())
    assert Counter(r["lang_pred"] != "und" for r in got) == letters
    assert {r["lang_pred"] for r in identify_languages(odd, learn_languages(none)).collect()} == {"und"}


@given(st.lists(st.integers(1, 50), max_size=20), st.integers(1, 40), st.integers(20, 200))
@settings(max_examples=100, deadline=None)
def test_fair_share_is_the_largest(sizes, most, limit):
    fits = [n for n in range(1, most + 1) if sum(min(s, n) for s in sizes) <= limit]
    assert fair_share(sizes, most, limit) == max(fits, default=1)


def test_every_language_is_learned_whatever_the_layout(spark):
    names = [f"l{k}" for k in range(12)]
    rows = [(60 * n + k, f"{chr(97 + n) * 3} {chr(98 + n) * (1 + k % 5)}", name) for n, name in enumerate(names) for k in range(60)]
    stored = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartitionByRange(12, "lang")
    models = [learn_languages(table, limit=96) for table in (stored, stored.repartition(5))]
    for model in models:
        assert set(model.languages) == set(names)
        assert (model.centroids == models[0].centroids).all()
    rare = spark.createDataFrame([(1000 + k, "zzz", f"dirty{k}") for k in range(40)], stored.schema)
    assert set(learn_languages(rare.union(stored), limit=12).languages) == set(names)
    learned = next(k for k in range(1000, 2000) if zlib.crc32(str(k).encode()) % 5)
    same = spark.createDataFrame([(learned, "qq rr", "same")] * 3000, stored.schema)
    assert "same" in learn_languages(same.union(stored)).languages


# Jaccard join --------------------------------------------------------------------------


def brute_components(rows, words, threshold):
    def grams(text):
        own = [w for w in WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))]
        return frozenset([tuple(own)] if 0 < len(own) < words else [tuple(own[k : k + words]) for k in range(len(own) - words + 1)])

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= threshold * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    best = {k: min((i for i in ids if i is not None), default=None) for k, ids in least.items()}
    return Counter((i, len(sets[k]), best[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize(("words", "threshold"), [(4, Fraction(85, 100)), (5, Fraction(8, 10)), (2, Fraction(1, 2))])
@pytest.mark.parametrize("long_list", [3, 64])
def test_components_are_those_of_all_pairs(spark, monkeypatch, words, threshold, long_list):
    monkeypatch.setattr(jj, "LONG_LIST_PAIRS", long_list)
    monkeypatch.setattr(jj, "BLOCK_RECORDS", 20)
    random.seed(6)
    base = [[f"w{random.randrange(500)}" for _ in range(random.randrange(3, 90))] for _ in range(12)]
    rows = []
    for k in range(260):
        own = list(random.choice(base[:3] if k % 2 else base))
        for _ in range(random.randrange(0, 5)):
            own[random.randrange(len(own))] = f"new{random.randrange(50)}"
        rows.append((k * 3 % 787, " ".join(own)))
    rows += [(r[0], r[1]) for r in odd_rows()]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), words=words, threshold=threshold).collect()
    assert Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == brute_components(rows, words, threshold)


def test_near_copies_on_odd_rows(odd, none):
    assert without_near_copies(none).count() == 0
    kept = without_near_copies(odd)
    assert kept.columns == odd.columns
    answers = brute_components([(r[0], r[1]) for r in odd_rows()], 5, Fraction(8, 10))
    components = {c for (_, n, c), _ in answers.items() if n}
    alone = sum(times for (_, n, _), times in answers.items() if not n)
    assert kept.count() == len(components) + alone


@pytest.mark.parametrize("threshold", [Fraction(85, 100), Fraction(8, 10), Fraction(1, 2), Fraction(1)])
def test_two_beginnings_share_their_prefix(threshold):
    random.seed(7)
    for _ in range(300):
        size = random.randrange(1, 120)
        own = set(random.sample(range(1000), size))
        other = set(own)
        for _ in range(random.randrange(0, size // 3 + 1)):
            other.discard(random.choice(sorted(other)))
            other.add(random.randrange(1000, 2000))
        if not other or len(own & other) < threshold * len(own | other):
            continue
        rare = {g: random.random() for g in own | other}

        def prefix(grams, rare=rare):
            length, count = beginning(len(grams), threshold)
            return set(sorted(sorted(grams)[:length], key=rare.get)[:count])

        assert prefix(own) & prefix(other)
        assert misses(size, threshold) >= len(own - other)


def test_connected_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (6, 8), *[(100, k) for k in range(101, 160)], *[(k, k + 1) for k in range(200, 240)]]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert [found[k] for k in (1, 2, 3, 9, 5, 6, 8)] == [1, 1, 1, 1, 5, 5, 5]
    assert {found[k] for k in range(100, 160)} == {100} and {found[k] for k in range(200, 241)} == {200}


# URL rules -----------------------------------------------------------------------------


def test_rules_are_those_of_a_plain_search(spark):
    random.seed(8)
    labels = ["a", "b", "c", "b-c", "net", "org"]
    host = lambda: ".".join(random.choices(labels, k=random.randrange(1, 4)))
    path = lambda: "/" + "/".join(random.choices(["x", "y", "xy"], k=random.randrange(0, 3)))
    rules = [(host(), random.choice([path(), "/", ""]), random.choice(["allow", "block"])) for _ in range(40)]
    rules += [("net", "/", "block"), ("NET", "/", "allow"), ("a.net", "/", "allow")]
    urls = [f"http://{host()}{path()}{random.choice(['', '?q', '#f'])}" for _ in range(1500)] + ["http://net/x"] * 700
    urls += [None, "", "no scheme/x", "HTTP://A.NET", "x://", "http://net./y", "http://a.Net:80/x\n?", "a://b://c"]
    verdicts = {}
    for h, p, v in rules:
        key = (re.sub("[A-Z]+", lambda m: m.group().lower(), h), p)
        verdicts[key] = max(v, verdicts.get(key, ""))
    rows = [(k, u) for k, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {r["page_id"]: r for r in judge_urls(pages, rule_table(spark, rules), buckets=16, sample_rows=500).collect()}
    for k, u in rows:
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        own = re.sub("[A-Z]+", lambda x: x.group().lower(), m[1]) if m else ""
        way = m[2] if m else ""
        fits = [(len(h + p), h + p, v) for (h, p), v in verdicts.items() if (own == h or own.endswith("." + h)) and way.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        assert (found[k]["host"], found[k]["path"], found[k]["rule"], found[k]["verdict"]) == (own, way, best[1], best[2]), u
    empty = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(empty, rule_table(spark, rules)).count() == 0


# Queries -------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_covers_its_table(spark, name):
    table = "pages" if "url" in name else "embeddings" if "vector" in name else "documents"
    found = QUERIES[name](spark, SF)
    rows = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert found.count() == rows if name != "op2_packing" else found.count() >= rows
    json.dumps(found.dtypes)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == columns and docs.count() > 0
        if name != "mixing":
            assert docs.exceptAll(before).count() == 0
        texts = [r["text"] for r in docs.collect()]
        if name == "exact_dedup":
            assert len(set(texts)) == len(texts)
        if name == "near_dedup":
            assert all(n == 1 for n in Counter(c for _, _, c in brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], 5, Fraction(8, 10)).elements()).values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.selectExpr("sum(length)").first()[0] == sum(len(hugging_ids(r["text"])) for r in docs.collect())
