"""Frames, fill-in-middle, vector codes and token files against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm import SCHEMA, odd_rows

from comarca.llm import frames as fr
from comarca.llm import vector_codes as vc
from comarca.llm.fill_middle import MARKS, digests, fill_in_middle, filled_texts, mark_places, restored
from comarca.llm.frames import frame_texts, store_frames
from comarca.llm.token_files import TOKENS, WordIds, document_ids, read_token_files, token_digests, word_ids_of, write_token_files

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def more_rows():
    """The odd rows, and texts that hold a marker or parts of one, or fill many frames."""
    random.seed(5)
    long = "".join(random.choice(["é", "日", "a", " ", "\n", "x y", "<P", "S>"]) for _ in range(700_000))
    extra = ["a <P> b", "<S>", "<<<P<S <M", "P> S> M>", long, "x" * 600_000, " " * 600_000]
    return [*odd_rows(), *[(100 + k, t, None, None, "r", "i", 1, 2) for k, t in enumerate(extra * 6)]]


@pytest.fixture(scope="module")
def more(spark):
    return spark.createDataFrame(more_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# Frames --------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\nabé日<PS>", max_size=60), st.integers(4, 20), st.data())
def test_frames_can_be_entered_at_any_unit(text, size, data):
    raw = text.encode()
    found, units, chars = fr.make_frames(memoryview(raw), size)
    parts = UNIT.findall(text)
    assert (units, chars) == (len(parts), len(text))
    assert b"".join(fr.decompress(f.data) for f in found) == raw
    for f in found:
        fr.decompress(f.data).decode()  # cut between code points
    unit = data.draw(st.integers(0, units))
    place = fr.unit_place(found, unit, (units, chars, len(raw)))
    assert place == (len("".join(parts[:unit]).encode()), len("".join(parts[:unit])))
    low, high = sorted(data.draw(st.tuples(st.integers(0, len(raw)), st.integers(0, len(raw)))))
    assert b"".join(fr.streamed(found, low, high, len(raw))) == raw[low:high]
    laid = list(fr.joined(fr.stretch(found, low, high, len(raw)), size))
    assert b"".join(fr.decompress(d) for d, _ in laid) == raw[low:high]
    assert sum(n for _, n in laid) == high - low


def rearranged(doc_id, text):
    """The contract in plain Python: n, form, prefix and middle lengths, output."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(p) for p in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_fill_in_middle(spark, more, none, tmp_path):
    stored = store_frames(more, str(tmp_path / "frames"), marks=MARKS)
    filled = fill_in_middle(stored)
    expected = Counter()
    for row in more_rows():
        *some, output = rearranged(row[0], row[1])
        expected[(row[0], *some, sha(output), sha(row[1] or ""))] += 1
    assert Counter(tuple(r) for r in digests(filled).collect()) == expected
    assert {form for _, _, form, *_ in expected} == {"plain", "spm", "psm"}
    texts = Counter((r["id"], r["output"]) for r in filled_texts(filled).collect())
    assert texts == Counter((row[0], rearranged(row[0], row[1])[-1]) for row in more_rows())
    assert digests(fill_in_middle(frame_texts(none, MARKS))).collect() == []
    assert "Exchange" not in digests(filled)._jdf.queryExecution().executedPlan().toString()


def test_output_is_one_stream_and_most_frames_move_as_they_are(more):
    stored = {r["id"]: r for r in frame_texts(more, MARKS).where("id >= 100").collect()}
    copied = 0
    for row in fill_in_middle(frame_texts(more, MARKS).where("id >= 100")).collect():
        stream = b"".join(bytes(f["data"]) for f in row["output"])
        text = zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True).read()
        assert len(text) == row["out_bytes"]
        if row["form"] != "plain" and len(stored[row["id"]]["frames"]) > 4:
            before = {bytes(f["data"]) for f in stored[row["id"]]["frames"]}
            same = sum(bytes(f["data"]) in before for f in row["output"])
            assert same >= len(before) - 2
            copied += same
    assert copied


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="<PSM> a", max_size=12), min_size=3, max_size=3), st.booleans(), st.integers(4, 9))
def test_markers_are_found_across_frames(parts, suffix_first, size):
    if any(m in part for part in parts for m in MARKS):
        return
    prefix, middle, suffix = parts
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if suffix_first else f"<P>{prefix}<S>{suffix}<M>{middle}"
    found = fr.make_frames(memoryview(output.encode()), size)[0]
    places = mark_places(found, len(output))
    assert all(output[places[m] :].startswith(m) for m in MARKS)
    assert b"".join(restored(found, "spm" if suffix_first else "psm", len(output))).decode() == prefix + middle + suffix


# Token files ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


SOME_TEXT = st.text(alphabet="aB's tTéΣ́  \x1c\n\t9½.,!日本<|endoftext|>İK‍👍", max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), SOME_TEXT, st.text(max_size=40)), max_size=5))
def test_ids_by_word_are_those_of_whole_texts(tokenizer, texts):
    import pyarrow as pa

    filled = pa.array([t or "" for t in texts], pa.large_string())
    ids, begins = document_ids(filled, word_ids_of("word_bpe_49k.json"), 2)
    whole = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)] == whole


def test_every_simple_character_and_forgotten_words(tokenizer, monkeypatch):
    import pyarrow as pa

    from comarca.llm import token_files

    monkeypatch.setattr(token_files, "KNOWN_WORDS", 40)
    word_ids = WordIds("word_bpe_49k.json")
    assert word_ids.tokenizer.known_way
    random.seed(2)
    signs = [chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x180)]] + ["'s", "'LL", "<|endoftext|>", " ", "x" * 90]
    for _ in range(150):
        text = "".join(random.choice(signs) for _ in range(random.randrange(60)))
        ids, _ = document_ids(pa.array([text], pa.large_string()), word_ids, 2)
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
    assert len(word_ids.words) < 200


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files(spark, more, none, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    write_token_files(more, path)
    rows = token_digests(read_token_files(spark, path)).collect()
    whole = Counter()
    for row in more_rows():
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2]
        whole[(row[0], len(ids), crc(ids))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == whole
    at = 0
    for row in sorted(rows, key=lambda r: r["start"]):
        assert row["start"] == at
        at += row["n_tokens"]
    ordered = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))

    empty = str(tmp_path / "none")
    write_token_files(none, empty)
    assert read_token_files(spark, empty).collect() == []
    with pytest.raises(Exception, match="(?i)path"):
        read_token_files(spark, str(tmp_path / "absent")).collect()


def test_files_ascend_and_searches_are_pushed_down(spark, tmp_path):
    docs = spark.range(20_000, numPartitions=5).select((F.lit(20_000) - F.col("id")).alias("doc_id"), F.concat(F.lit("w "), "id").alias("text"))
    path = str(tmp_path / "many")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_token_files(docs, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    manifest = spark.read.orc(f"{path}/manifest").orderBy("part").collect()
    assert len(manifest) == 4
    for a, b in zip(manifest[:-1], manifest[1:], strict=True):
        assert a["last_id"] < b["first_id"] and a["start"] + a["tokens"] == b["start"]
    found = read_token_files(spark, path, ids=[7, 19_999, 50_000])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().executedPlan().toString().replace("IsNotNull(part), ", "")
    whole = {r["doc_id"]: r for r in read_token_files(spark, path).collect()}
    assert {r["doc_id"]: r for r in found.collect()} == {k: whole[k] for k in (7, 19_999)}


def test_equal_and_null_ids_are_spread(spark, tmp_path):
    docs = spark.range(8000, numPartitions=4).select(F.lit(None).cast("long").alias("doc_id"), (F.col("id") % 3).cast("string").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_token_files(docs, str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["rows"] for r in spark.read.orc(str(tmp_path / "hot") + "/manifest").collect()]
    assert sum(sizes) == 8000 and max(sizes) < 3000


def test_tokens_are_written_with_an_index(spark, tmp_path):
    write_token_files(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), str(tmp_path / "t"))
    from pyarrow import orc

    (file,) = (tmp_path / "t" / "tokens").glob("*.orc")
    assert orc.ORCFile(file).row_index_stride == 1000
    assert spark.read.schema(TOKENS).orc(str(tmp_path / "t/tokens")).first()["ids"][-1] == 2


# Vector codes --------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, part int, id string, vector string"


def vector_rows(n=400, dimension=16):
    random.seed(9)
    rows = [(k, [random.uniform(-1, 1) for _ in range(dimension)], random.choice([None, 0, 1]), 1, "x", "y") for k in range(n)]
    rows += [(n + k, rows[3][1], 1, 1, "x", "y") for k in range(n)]  # a large group of copies
    rows += [rows[5], (None, rows[7][1], 2, None, None, None), (None, None, None, None, None, None)]
    rows += [(-5, [None] * dimension, 0, 1, "x", "y"), (-4, [math.nan] * dimension, 0, 1, "x", "y")]
    return [*rows, (-3, [math.inf, *[0.0] * (dimension - 1)], 0, 1, "x", "y"), (9999, [1.0] * (dimension - 1), 0, 1, "x", "y")]


def lloyd(rows, rounds=6, parts=8, entries=16, dimension=16):
    """Codes in plain Python."""
    kept = [(r[0], [math.floor(4096 * np.float32(x)) for x in r[1]], r[2]) for r in rows
            if r[1] is not None and len(r[1]) == dimension and all(x is not None and math.isfinite(x) for x in r[1])]
    width = dimension // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for vector in cut:
            for p in range(parts):
                members[p, near(p, vector[p])[1]].append(vector[p])
        for (p, e), own in members.items():
            books[p][e] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found, errors = [], Counter()
    for (name, _, label), vector in zip(kept, cut, strict=True):
        near_all = [near(p, vector[p]) for p in range(parts)]
        found.append((name, bytes(e for _, e in near_all).hex(), sum(d for d, _ in near_all), label))
        errors[label] += found[-1][2]
    return Counter((n, c, e, errors[label]) for n, c, e, label in found), books


def coded(df, **options):
    found = vc.fit_codebooks(df, **options)
    return Counter(tuple(r) for r in vc.encode_vectors(df, found).collect()), found


def test_vector_codes(spark):
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    expected, books = lloyd(rows)
    for members in (1 << 16, 50):  # one salt, and many
        got, found = coded(df, members=members)
        assert got == expected
        assert [book.tolist() for book in found.books] == books
    text = ",".join(str(x) for book in books for row in book for x in row)
    assert found.sha256() == hashlib.sha256(text.encode()).hexdigest()


def test_vector_codes_of_few_rows(spark):
    few = spark.createDataFrame(vector_rows()[:3], VECTORS)
    got, found = coded(few)
    assert got == lloyd(vector_rows()[:3])[0] and all(len(book) == 3 for book in found.books)
    none = spark.createDataFrame([], VECTORS)
    assert coded(none)[0] == Counter()
    odd = spark.createDataFrame([(1, [], 0, 1, "", "")], VECTORS)
    assert coded(odd)[0] == Counter([(1, "00" * 8, 0, 0)])
    short = spark.createDataFrame([(k, [float(k)], 0, 1, "", "") for k in range(40)], VECTORS)
    assert sum(coded(short)[0].values()) == 40


def test_more_rounds_cut_the_lineage(spark):
    df = spark.createDataFrame(vector_rows(60), VECTORS)
    got, _ = coded(df, rounds=10)
    assert got == lloyd(vector_rows(60), rounds=10)[0]


def test_only_movers_are_shuffled(spark):
    sc = spark.sparkContext
    place = vc.Place(8, 2)
    blocks = [((p, e, s), (False, np.array([p, e, s], np.int32).tobytes())) for p in range(8) for e in range(16) for s in range(2)]
    state = sc.parallelize(blocks, 4).partitionBy(7, place)
    new = {0: 1, 3: 2}
    assigned = state.mapPartitions(lambda some: [(o, (new.get(o[1], o[1]), b)) for o, b in some], preservesPartitioning=True)
    united = vc.migrated(assigned, place, 7)
    assert united.getNumPartitions() == 7 and united.partitioner == state.partitioner
    assert "PartitionerAwareUnionRDD" in united._jrdd.rdd().toDebugString()
    assert all(place(o) % 7 == k for k, part in enumerate(united.glom().collect()) for o, _ in part)
    assert Counter(b for _, b in united.collect()) == Counter(b for _, b in blocks)
    moved = [o for o, b in united.collect() if o[1] != np.frombuffer(b[1], np.int32)[1]]
    assert len(moved) == 2 * 8 * 2


def test_a_lost_executors_blocks_are_made_again(spark):
    """Members fit the same codebooks when what was kept in memory is dropped between rounds."""
    df = spark.createDataFrame(vector_rows(100), VECTORS).repartition(2)
    expected = vc.fit_codebooks(df)
    keep = vc.StorageLevel.MEMORY_AND_DISK
    try:
        vc.StorageLevel.MEMORY_AND_DISK = vc.StorageLevel(False, False, False, False)
        again = vc.fit_codebooks(df)
    finally:
        vc.StorageLevel.MEMORY_AND_DISK = keep
    assert all((a == b).all() for a, b in zip(expected.books, again.books, strict=True))


# Lists longer than may be broadcast, and runs that break off ----------------------------


@pytest.fixture
def no_broadcast(monkeypatch):
    from comarca.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)


def test_long_lists_give_the_same_rows(spark, more, no_broadcast):
    from comarca.llm.exact_dedup import without_copies
    from comarca.llm.jaccard_join import jaccard_components, without_near_copies

    from comarca.llm import common

    long = [sorted(map(str, f(more).collect())) for f in (without_copies, without_near_copies, jaccard_components)]
    common.BROADCAST_ROWS = 1000
    short = [sorted(map(str, f(more).collect())) for f in (without_copies, without_near_copies, jaccard_components)]
    assert long == short


def test_toxic_rows_go_by_their_text_whatever_the_list(spark, more, monkeypatch):
    from comarca.llm import common, toxicity

    docs = table_with(spark, more)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.learn_toxicity(docs, labels)
    bad = {r["row"] for r in toxicity.score_toxicity(docs.withColumn("k", F.monotonically_increasing_id()), model, "k").where("predicted = 1").select(F.col("id").alias("row")).collect()}
    rows = docs.withColumn("k", F.monotonically_increasing_id()).collect()
    expected = Counter(str(r["text"]) for r in rows if r["k"] not in bad)
    assert bad and expected
    for limit in (0, 1000):
        monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
        kept = toxicity.without_toxic(docs, labels)
        assert kept.columns == docs.columns
        assert Counter(str(r["text"]) for r in kept.collect()) == expected


def table_with(spark, more):
    """The test documents, some of them as a large group of copies, and the odd rows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    docs = docs.unionByName(docs.where("doc_id % 17 = 0").crossJoin(spark.range(30)).drop("id"))
    return docs.unionByName(more.select("doc_id", "text", "lang", "source").where("doc_id is null or doc_id < 100"))


def test_only_what_may_be_listed_is_shuffled(spark, no_broadcast):
    from comarca.llm.common import staged, unmatched

    docs = spark.range(20_000).select(F.col("id").cast("string").alias("name"), F.repeat(F.lit("x"), 50).alias("text"))
    listed = staged(spark.range(0, 20_000, 100).select(F.col("id").cast("string").alias("name")), "listed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = unmatched(docs, listed, ["name"])
        kept._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kept.count() == 20_000 - 200
    moved = [line for line in kept._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(name" in line]
    assert moved and "_salt" in moved[0]


@pytest.mark.parametrize("broken", ["add", "commit"])
def test_a_run_that_broke_off_can_be_repeated(spark, tmp_path, monkeypatch, broken):
    from comarca.llm.exact_dedup import DigestIndex, exact_dedup

    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    docs = spark.createDataFrame([(10, "a"), (11, "c"), (12, "d"), (13, "c"), (14, "e"), (15, "f"), (16, "g")], "doc_id long, text string")
    index = DigestIndex.open(spark, str(tmp_path / "it's an index"), 4)
    exact_dedup(first, index=index, run="one")
    calls = []
    real = getattr(DigestIndex, broken)

    def fails(self, *rest):
        calls.append(1)
        if len(calls) == (2 if broken == "add" else 1):
            raise RuntimeError("lost")
        return real(self, *rest)

    monkeypatch.setattr(DigestIndex, broken, fails)
    with pytest.raises(RuntimeError):
        exact_dedup(docs, index=index, run="two")
    monkeypatch.setattr(DigestIndex, broken, real)
    wanted = {10: (3, False), 11: (13, False), 12: (12, True), 13: (13, True), 14: (14, True), 15: (15, True), 16: (16, True)}
    for _ in range(2):  # again after the break, and again though it went through
        again = DigestIndex.open(spark, index.location, 4)
        found = {r["id"]: (r["keep_id"], r["kept"]) for r in exact_dedup(docs, index=again, run="two").collect()}
        assert found == wanted
        again.close()
    assert sorted(r["keep_id"] for r in index.entries().collect()) == [2, 3, 12, 13, 14, 15, 16]
    later = {r["id"]: r["kept"] for r in exact_dedup(docs, index=index, run="three").collect()}
    assert not any(later.values())


def test_an_index_leaves_nothing_in_the_catalog_and_grows_in_buckets(spark):
    from comarca.llm.exact_dedup import buckets_for, exact_dedup

    before = {t.name for t in spark.catalog.listTables()}
    exact_dedup(spark.createDataFrame([(1, "a")], "doc_id long, text string")).count()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert buckets_for(0) == 32 and buckets_for(10**10) == 5000
