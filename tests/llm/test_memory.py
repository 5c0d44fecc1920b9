"""What the pipeline's stages keep in an executor's Python workers and native memory."""

import subprocess
import sys
from fractions import Fraction
from pathlib import Path

import pyarrow as pa
import pytest

from comarca.llm.common import BATCH_BYTES, BATCH_SETTING, staged_small
from comarca.llm.exact_dedup import exact_dedup
from comarca.llm.jaccard_join import _block_links, without_near_copies
from comarca.llm.toxicity import without_toxic

REPO = Path(__file__).resolve().parents[2]
DOCS = "doc_id long, text string"


def batch_sizes(texts):
    """Rows and bytes of every batch that comes to a worker."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    return staged_small(texts.mapInArrow(sizes, "rows long, bytes long"), "sizes").collect()


def test_texts_go_to_python_in_small_batches(spark):
    texts = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('ten bytes ', 1000) text")
    found = batch_sizes(texts)
    assert sum(row["rows"] for row in found) == 3000
    assert max(row["bytes"] for row in found) < 2 * BATCH_BYTES
    assert spark.conf.get(BATCH_SETTING, None) is None


def test_a_limit_of_the_session_holds(spark):
    texts = spark.range(0, 300, 1, 1).selectExpr("id", "repeat('ten bytes ', 1000) text")
    spark.conf.set(BATCH_SETTING, "100000")
    try:
        found = batch_sizes(texts)
        assert max(row["bytes"] for row in found) < 200_000
        assert spark.conf.get(BATCH_SETTING) == "100000"
    finally:
        spark.conf.unset(BATCH_SETTING)


@pytest.mark.parametrize("stage", ["toxicity", "near_dedup"])
def test_stages_send_small_batches(spark, monkeypatch, stage):
    from comarca.llm import common

    docs = spark.createDataFrame([(k, f"a text of some words and {k % 7}") for k in range(40)], DOCS)
    labels = spark.createDataFrame([(k, int(k % 7 == 0)) for k in range(40)], "doc_id long, toxic int")
    seen, write = {}, common.staged

    def noted(df, name):
        seen[name] = spark.conf.get(BATCH_SETTING, None)
        return write(df, name)

    monkeypatch.setattr(common, "staged", noted)  # the one that staged_small calls
    without_toxic(docs, labels) if stage == "toxicity" else without_near_copies(docs)
    expected = {"tokens", "toxic"} if stage == "toxicity" else {"shingled", "links"}
    assert expected <= seen.keys() and {seen[name] for name in expected} == {str(BATCH_BYTES)}
    assert spark.conf.get(BATCH_SETTING, None) is None


def test_exact_dedup_hands_no_rows_to_python_workers(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "")], DOCS)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **b: pytest.fail("rows pass Python workers"))
    found = {row["id"]: (row["keep_id"], row["group_size"], row["kept"]) for row in exact_dedup(docs).collect()}
    assert found == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (5, 2, False), 5: (5, 2, True)}


def test_links_of_a_block_need_no_pandas():
    sets = [[1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5], [9, 10], [11]]
    block = pa.table(
        {
            "low": [0] * 6, "high": [0] * 6, "slot": [0] * 6, "range": [0] * 6, "part": [0] * 6,
            "record": [11, 12, 13, 14, 15, 11], "component": [1, 2, 1, 4, 5, 1],
            "set": pa.array([*sets, sets[0]], pa.list_(pa.int64())),
        }
    )
    links = _block_links(Fraction(8, 10))(block)
    assert links.to_pydict() == {"a": [12], "b": [11]}
    assert _block_links(Fraction(9, 10))(block).to_pydict() == {"a": [], "b": []}


def test_worker_modules_of_the_pipeline_load_no_pandas():
    code = "import comarca.llm.mixing, comarca.llm.jaccard_join, comarca.llm.toxicity, comarca.llm.packing, sys; print('pandas' in sys.modules)"
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "False", done.stderr
