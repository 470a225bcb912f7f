from __future__ import annotations

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomwork import staging
from loomwork.plans import forum, recommend
from loomwork.sources import records, text_files
from loomwork.staging import discard, job_staging, staged, staging_folder
from tests.conftest import rows


def test_corpora_carry_their_source(spark, lines):
    corpus = text_files.read_corpora(spark, lines("a.txt", "x y", "z"), lines("b.txt", "x"))
    assert rows(corpus) == [(0, "x y"), (0, "z"), (1, "x")]


def test_stop_words_stay_untrimmed(spark, lines):
    assert rows(text_files.read_stop_words(spark, lines("stop.txt", "the", " Of"))) == [(" Of",), ("the",)]


def test_missing_stop_word_file_fails(spark, tmp_path):
    with pytest.raises(PySparkException):
        text_files.read_stop_words(spark, str(tmp_path / "none.txt")).count()


def test_ratings_ignore_further_fields(spark, lines):
    ratings = records.read_ratings(spark, lines("r.csv", "1,10,5", "2,11,2.5,x"))
    assert ratings.dtypes == [("user", "int"), ("item", "int"), ("score", "double")]
    assert rows(ratings) == [(1, 10, 5.0), (2, 11, 2.5)]


def test_users_and_items_are_numbers(spark, lines):
    ratings = records.read_ratings(spark, lines("r.csv", "007,10,5", "7,010,3"))
    assert rows(recommend.user_score_vectors(ratings).select("user", "scores")) == [(7, [(10, 3.0, 1), (10, 5.0, 1)])]


@pytest.mark.parametrize("bad", ["x,1,2", "1,2", "1,2,", " 1,2,3", "1,99999999999,3", ""])
def test_malformed_ratings_fail_or_are_skipped(spark, lines, bad):
    path = lines("r.csv", "1,10,5", bad)
    with pytest.raises(PySparkException, match="malformed line"):
        records.read_ratings(spark, path).collect()
    assert rows(records.read_ratings(spark, path, malformed="skip")) == [(1, 10, 5.0)]


def test_malformed_ratings_fail_without_ansi_mode(spark, lines):
    path = lines("r.csv", "x,1,2")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            records.read_ratings(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_postings_with_and_without_tag(spark, lines):
    path = lines("p.csv", "1,27,,0,Algorithm", "2,28,27,3", "2,29,27,-1,", "1,30,,2,,x")
    postings = records.read_postings(spark, path)
    assert postings.columns == ["posting_type", "id", "parent_id", "score", "tags"]
    assert rows(postings) == [
        (1, 27, None, 0, "Algorithm"),
        (1, 30, None, 2, ""),
        (2, 28, 27, 3, None),
        (2, 29, 27, -1, None),
    ]


@pytest.mark.parametrize("bad", ["1,2", "1,2,z,0", "q,2,,0", "1,2,,", "1,2,,zero,Tag"])
def test_malformed_postings_fail_or_are_skipped(spark, lines, bad):
    path = lines("p.csv", "2,28,27,3", bad)
    with pytest.raises(PySparkException, match="malformed line"):
        records.read_postings(spark, path).collect()
    assert rows(records.read_postings(spark, path, malformed="skip")) == [(2, 28, 27, 3, None)]


def test_pruned_columns_do_not_hide_malformed_lines(spark, lines):
    ratings = lines("r.csv", "1,10,abc", "x,2,3", "1,2,3")
    with pytest.raises(PySparkException, match="malformed line"):
        records.read_ratings(spark, ratings).count()
    with pytest.raises(PySparkException, match="malformed line"):
        records.read_ratings(spark, lines("s.csv", "1,10,abc")).select("user", "item").collect()
    with pytest.raises(PySparkException, match="malformed line"):
        forum.scored_questions(records.read_postings(spark, lines("p.csv", "1,1,,0,Tag", "3,5,,zz"))).collect()


def test_csv_texts_take_the_sixth_column(spark, lines):
    path = lines("t.csv", '0,1,d,q,u,"Hello, world"', "4,2,d,q,u,bye,extra", "1,2")
    assert rows(text_files.read_csv_texts(spark, path)) == [("Hello, world",), ("bye",), (None,)]


def written(path: str) -> list[str]:
    return [line for part in sorted(glob.glob(f"{path}/part-*")) for line in open(part, encoding="utf-8")]


def test_key_value_sink_keeps_quotes_and_commas(spark, tmp_path):
    counts = spark.createDataFrame([(3, 'say "a, b"'), (2, "x\\y")], "count int, word string")
    path = str(tmp_path / "out")
    text_files.write_key_values(counts, path, "count", "word")
    assert sorted(written(path)) == ["2\tx\\y\n", '3\tsay "a, b"\n']


def test_recommendations_are_written_in_text_order(spark, tmp_path):
    scores = spark.createDataFrame([(2, 3, 1.0), (10, 2, 0.0), (2, 11, 4.5)], "user int, item int, score double")
    path = str(tmp_path / "out")
    text_files.write_key_values(scores, path, "user", "item", "score", order_by=recommend.recommendation_order())
    assert written(path) == ["10\t2,0.0\n", "2\t11,4.5\n", "2\t3,1.0\n"]


def test_key_value_sink_writes_nulls_as_empty(spark, tmp_path):
    rows_ = spark.createDataFrame([(1, None, 2), (None, "x", None)], "k int, a string, b int")
    text_files.write_key_values(rows_, str(tmp_path / "out"), "k", "a", "b")
    assert sorted(written(str(tmp_path / "out"))) == ["\tx,\n", "1\t,2\n"]


def test_a_single_machine_without_a_folder_stages_in_spark(spark, monkeypatch):
    monkeypatch.setattr(staging, "staging_folder", lambda session: None)
    kept = staged(spark.range(5))
    assert kept.count() == 5 and kept.storageLevel.useDisk and not kept.inputFiles()
    discard(kept)
    assert not kept.storageLevel.useDisk


def test_a_job_deletes_what_it_staged(spark):
    with job_staging(spark):
        table = staged(spark.range(5))
        folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_staging_refuses_a_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        staging_folder(Session())


def test_staging_uses_the_folder_of_the_session(spark):
    assert staging_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_lines_are_sorted_out_in_one_pass(spark):
    values = ["1,2,3", "x,2,3", "1,,3", "1,2,y", "", "1,2", "1,2,3,more", " 1,2,3", "1,2,3,"]
    lines = spark.createDataFrame([(v,) for v in values], "value string")
    kept, rejected = records.sorted_out(lines, records.rating)
    assert sorted(map(tuple, kept.collect())) == [(1, 2, 3.0)] * 3
    assert sorted(map(tuple, rejected.collect())) == sorted(
        [("x,2,3", "user"), ("1,,3", "item"), ("1,2,y", "score"), ("", "user"), ("1,2", "score"), (" 1,2,3", "user")]
    )
    postings = spark.createDataFrame([("1,27,,0,Algorithm",), ("2,28,x,3",), ("2,29,27",)], "value string")
    kept, rejected = records.sorted_out(postings, records.posting)
    assert [tuple(r) for r in kept.collect()] == [(1, 27, None, 0, "Algorithm")]
    assert sorted(map(tuple, rejected.collect())) == [("2,28,x,3", "parent_id"), ("2,29,27", "score")]


def test_the_expressions_that_make_a_line_run_once(spark):
    """However many fields are tested and selected."""
    lines = spark.range(10).select(F.concat_ws(",", F.col("id"), F.col("id") + 77, F.lit("1")).alias("value"))
    plan = records.parse_ratings(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("+ 77") == 1 and plan.count("split(") == 1
