"""Tiers and step groups of packing, and whole results on odd rows."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm import SCHEMA, brute_components, hugging_ids, odd_rows

from comarca.llm.mixing import mix, mix_plan
from comarca.llm.packing import STEP_TOKENS, Packer, balanced, pack_documents
from comarca.llm.toxicity import learn_toxicity, score_toxicity, without_toxic
from comarca.llm.url_rules import judge_urls, rule_table


def all_rows():
    """The odd rows, and some of which every third is toxic, so that there is something to learn."""
    random.seed(22)
    words = "ab cd ef gh Ij kl, mn".split()
    rows = odd_rows()
    for k in range(100, 220):
        text = " ".join(random.choice(words) + str(random.randrange(400)) for _ in range(40))
        rows.append((k, text + " foul vile nasty foul" * (k % 3 == 0), "en", random.choice(["s1", "s2", None]), "r", "i", 1, 2))
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(all_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(k, k % 2, 0) for k in range(16)] + [(k, 1, int(k % 3 == 0)) for k in range(100, 220)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# Packing -------------------------------------------------------------------------------


@given(st.lists(st.integers(0, 10_000), max_size=60), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_groups_have_equal_counts_and_nearly_equal_costs(costs, groups):
    dealt = balanced(costs, groups)
    counts = [dealt.count(group) for group in range(groups)]
    sums = [sum(c for c, own in zip(costs, dealt, strict=True) if own == group) for group in range(groups)]
    assert sum(counts) == len(costs) and max(counts) - min(counts) <= 1
    assert max(sums) - min(sums) <= max(costs, default=0)


def plain_packing(lengths, tiers):
    """Whole windows first; then the longest rest opens its tier, and each gap takes the longest piece that
    fits, or the beginning of the shortest that does not."""
    waiting, done = [], []
    for k, length in enumerate(lengths):
        done += [(max(tiers), [(max(tiers), k, at)]) for at in range(0, length - max(tiers) + 1, max(tiers))]
        if length % max(tiers):
            waiting.append((length % max(tiers), k, length - length % max(tiers)))
    while waiting:
        total = sum(length for length, _, _ in waiting)
        size = min(tier for tier in tiers if tier >= max(waiting)[0])
        if size > total:
            size = 1 << (total.bit_length() - 1)
        pieces, room = [], size
        while room:
            fitting = [piece for piece in waiting if piece[0] <= room]
            if fitting:
                piece = max(fitting)
                waiting.remove(piece)
            else:
                length, k, at = min(waiting)
                waiting.remove((length, k, at))
                waiting.append((length - room, k, at + room))
                piece = (room, k, at)
            pieces.append(piece)
            room -= piece[0]
        done.append((size, pieces))
    return done


@given(st.lists(st.integers(1, 300), max_size=40))
@settings(max_examples=150, deadline=None)
def test_tiers_are_filled_as_by_plain_search(lengths):
    tiers, done = (128, 64, 32, 16), []
    packer = Packer(tiers)
    for k, length in enumerate(lengths):
        done.extend(packer.add(k, length))
    done.extend(packer.pack(final=True))
    assert done == plain_packing(lengths, tiers)


def test_step_groups_hold_one_tier_and_a_bounded_step(spark):
    random.seed(21)
    rows = [(k, "some words " * random.choice([3, 30, 90, 200, 900])) for k in range(900)]
    pieces = pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), with_ids=False)
    sequences = pieces.groupBy("sequence_id", "step_group", "tier").agg(F.sum("length").alias("length")).collect()
    assert len({r["sequence_id"] for r in sequences}) == len(sequences) and all(r["length"] == r["tier"] for r in sequences)
    groups = {}
    for r in sequences:
        groups.setdefault(r["step_group"], []).append(r["tier"])
    assert len({tier for own in groups.values() for tier in own}) > 2 and len(groups) > 8
    assert all(len(set(own)) == 1 and sum(own) <= STEP_TOKENS for own in groups.values())


# URL rules -------------------------------------------------------------------------------


def test_pages_with_clashing_columns_and_null_or_repeated_ids(spark):
    schema = "page_id long, url string, host string, key string, bucket int, salt int, path string, verdict string, place string"
    urls = ["http://a.net/x", "http://a.net/x", "http://b.org/", None, "", "nothing", "http://NET/y?z", "http://" + "s." * 30_000 + "net/x"]
    rows = [(k if k % 3 else None, url, "h", "k", 1, 2, "p", "v", "q") for k, url in enumerate(urls)]
    rows += [rows[1]] * 2 + [(None, None, None, None, None, None, None, None, None)]
    rules = rule_table(spark, [("net", "/", "block"), ("a.net", "/x", "allow")])
    found = judge_urls(spark.createDataFrame(rows, schema), rules, buckets=4)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    wanted = Counter()
    for page_id, url, *_ in rows:
        parts = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host, path = (parts[1].lower(), parts[2]) if parts else ("", "")
        rule, verdict = None, "allow"
        if (host == "net" or host.endswith(".net")) and path.startswith("/"):
            rule, verdict = "net/", "block"
        if host == "a.net" and path.startswith("/x"):
            rule, verdict = "a.net/x", "allow"
        wanted[page_id, host, path, rule, verdict] += 1
    assert Counter(map(tuple, found.collect())) == wanted


# Stages of the pipeline --------------------------------------------------------------------


def test_whole_rows_stay_unless_toxic(spark, odd, labels):
    model = learn_toxicity(odd, labels)
    toxic = {r["id"] for r in score_toxicity(odd, model).collect() if r["predicted"]}
    assert {k for k in toxic if k is None or k < 100} == set() and 30 < len(toxic) <= 40
    texts = {r[1] or "" for r in all_rows() if r[0] in toxic}
    assert Counter(map(tuple, without_toxic(odd, labels).collect())) == Counter(r for r in all_rows() if (r[1] or "") not in texts)


def test_the_mix_takes_whole_rows_as_planned(spark, odd):
    planned = Counter()
    text_of = {r["d"]: r["text"] for r in odd.select("text", F.xxhash64("text").alias("d")).collect()}
    for r in mix_plan(odd).collect():
        planned[r["id"], r["source"], text_of[r["digest"]]] += r["copies"]
    taken = Counter(map(tuple, mix(odd).collect()))
    assert set(taken) <= set(all_rows()) and taken.total() == planned.total()
    found = Counter()
    for row, n in taken.items():
        found[row[0], row[3], row[1]] += n
    assert found == +planned


def test_the_pipeline_on_odd_rows(spark, odd, labels, tmp_path):
    import corpus_pipeline

    odd.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stored = spark.read.parquet(f"{tmp_path}/documents.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()

    toxic = {r["id"] for r in score_toxicity(stored, learn_toxicity(stored, labels)).collect() if r["predicted"]}
    gone = {r[1] or "" for r in all_rows() if r[0] in toxic}
    best = {}
    for row in all_rows():
        if (row[1] or "") not in gone:
            best[row[1] or ""] = max(best.get(row[1] or "", row), row, key=lambda r: -1 if r[0] is None else r[0])
    rows = [(r[0], r[1]) for r in best.values()]
    assert all(doc_id is not None for doc_id, _ in rows)
    stays = {c for *_, c in brute_components(rows, 5, Fraction(8, 10))}
    texts = {doc_id: text for doc_id, text in rows if doc_id in stays}
    lengths = Counter()
    for piece in pieces:
        lengths[piece["doc_id"]] += piece["length"]
    assert set(lengths) <= set(texts) and len(lengths) > 60
    assert all(n % len(hugging_ids(texts[doc_id])) == 0 for doc_id, n in lengths.items())


def test_the_pipeline_on_empty_tables(spark, labels, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
