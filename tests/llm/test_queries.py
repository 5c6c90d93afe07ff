"""Registered queries against their SQL twins, and the pipeline."""

import os

import pytest

from tests.check_oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", ["op3_quality_cascade", "op4_snapshot_collapse", "op6_rarest_token", "op8_warc_salvage", "op10_license_diagonals", "op11_shared_search"])
def test_twins(spark, con, name):
    import __spark_entry__ as entry

    got, want, _, _ = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert got == want and got[1]


@pytest.mark.parametrize("name", ["op1_vector_packing", "op2_simhash_trie", "op5_trie_tokens", "op7_soft_mixing", "op12_matrix_join", "op13_block_convolution"])
def test_one_row_per_document(spark, name):
    import __spark_entry__ as entry

    found = entry.queries()[name](spark, FOLDER)
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert found.select("doc_id").distinct().count() == found.count()


def test_leaks_hold_the_item(spark, con):
    import __spark_entry__ as entry

    found = entry.queries()["op9_latent_leaks"](spark, FOLDER)
    verbatim = con.execute("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)").fetchall()
    assert set(verbatim) <= {(r.doc_id, r.item_id) for r in found.collect()}


def test_pipeline(spark):
    """Each stage on what the one before kept, against plain Python where that is possible."""
    import corpus_pipeline
    from pagewright.sources.storage import stored

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER), "stage")
        sizes.append(docs.count())
        if name != "sharding":
            assert docs.columns == columns
            assert docs.join(before, columns, "left_anti").isEmpty()
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > sizes[0] / 2
    done = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, done.select("doc_id", "shard", "slot").collect())) == sorted(map(tuple, docs.select("doc_id", "shard", "slot").collect()))
