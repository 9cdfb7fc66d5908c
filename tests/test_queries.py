"""Every registered query against its SQL, on the whole small tables."""

import pytest

import __spark_entry__ as entry_points
from check import compare, database
from conftest import SMALL

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert sum(r["n"] for r in rows) == 200


@pytest.mark.parametrize("name", ["language_distribution", "scan_parquet_shards"])
def test_documents_may_be_a_folder(spark, tmp_path, name):
    rows = [(k, "some words", lang, "web", 10) for k, lang in enumerate(["en", "en", "fr", None])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3, "doc_id").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(r["n"] for r in QUERIES[name](spark, str(tmp_path)).collect()) == [1, 1, 2]


@pytest.mark.parametrize("name", ["language_distribution", "scan_parquet_shards"])
def test_a_table_of_a_longer_name_is_another(spark, tmp_path, name):
    rows = [(k, "some words", "en", "web", 10) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs.select("doc_id").write.parquet(str(tmp_path / "documents_old.parquet"))
    assert [r["n"] for r in QUERIES[name](spark, str(tmp_path)).collect()] == [3]


def timed_documents(spark, folder):
    """Ids that five divides are few; what the quick detector gets right stands under the others and under no id."""
    rows = [(5 * k, "los niños", "es") for k in range(3)] + [(5 * k + 1, "der Hund und die Katze", "de") for k in range(9)]
    rows += [(None, "der Hund und die Katze", "de"), (7, None, None), (8, "of the people", "en")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(str(folder / "documents.parquet"))


@pytest.mark.parametrize("name", ["detector_latency", "fastest_detector"])
def test_detectors_are_timed_on_the_whole_table(spark, tmp_path, name):
    timed_documents(spark, tmp_path)
    found = {tuple(r) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    if name == "detector_latency":
        assert found == {("quick", 15, 11, True, False), ("slow", 15, 4, True, True)}
    else:
        assert found == {("quick", "quick")}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    good, note = compare(spark, con, SMALL, name, QUERIES[name], ORACLES.get(name))
    assert good, note
