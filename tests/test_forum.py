from __future__ import annotations

import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomwork.functions.geometry import nearest
from loomwork.operators import lloyd
from loomwork.operators.score_summary import score_summary
from loomwork.plans import forum
from loomwork.sources.records import parse_postings
from tests.conftest import rows


def postings(spark, *lines):
    return parse_postings(spark.createDataFrame([(line,) for line in lines], "value string"))


def points(spark, *pairs):
    return spark.createDataFrame(list(pairs), "x bigint, y bigint")


def centroids(spark, *pairs):
    return lloyd.centroid_rows(spark, pairs)


def test_questions_meet_their_best_answer(spark):
    raw = postings(spark, "1,27,,0,Algorithm", "2,28,27,3", "2,29,27,-1,", "2,40,,5", "2,41,99,5", "1,50,,1,Security")
    assert rows(forum.scored_questions(raw)) == [(27, "Algorithm", 0, 3)]


def test_best_score_is_at_least_zero(spark):
    raw = postings(spark, "1,1,,9,Security", "2,2,1,-3", "2,3,1,-1", "3,4,1,8")
    assert rows(forum.scored_questions(raw)) == [(1, "Security", 9, 0)]


def test_questions_that_share_an_id_count_once(spark):
    raw = postings(spark, "1,1,,9,Security", "1,1,,4,Algorithm", "1,1,,0", "2,2,1,7").repartition(3)
    assert rows(forum.scored_questions(raw)) == [(1, "Algorithm", 4, 7)]


def test_a_question_with_a_third_of_all_answers(spark):
    answers = spark.range(3000).selectExpr(
        "2 as posting_type", "cast(id as int) as id",
        "cast(if(id % 3 = 0, 1, id) as int) as parent_id", "cast(id as int) as score", "cast(null as string) as tags",
    )
    question = postings(spark, "1,1,,0,Big-Data")
    assert rows(forum.scored_questions(answers.unionByName(question))) == [(1, "Big-Data", 0, 2997)]


def test_points_of_listed_unlisted_and_missing_tags(spark):
    raw = postings(
        spark, "1,1,,0,Machine-Learning", "1,2,,0,Architecture", "1,3,,0,Unlisted", "1,4,,0", "1,5,,0,Security",
        *[f"2,{90 + i},{i},{4 + i}" for i in range(1, 5)], "2,99,1,-7", "2,98,77,5", "2,97,,5", "3,1,1,99",
    )
    assert rows(forum.domain_points(raw)) == [(1, 0, 5), (2, 700000, 6), (3, -50000, 7)]


def test_points_equal_the_scored_questions(spark):
    """Shared ids take the smallest tag, whether listed, between the listed ones or missing."""
    rng = random.Random(9)
    tags = [*forum.DOMAINS, "", "AAA", "Big", "Data", "Zzz", "Security ", "security", None]
    lines_ = []
    for _ in range(400):
        tag = rng.choice(tags)
        lines_.append(f"1,{rng.randrange(60)},,{rng.randrange(9)}" + ("" if tag is None else f",{tag}"))
        lines_.append(f"2,7,{rng.randrange(80)},{rng.randrange(-5, 50)}")
    raw = postings(spark, *lines_).repartition(4)
    expected = [
        (r.id, (forum.DOMAINS.index(r.tags) if r.tags in forum.DOMAINS else -1) * forum.SPREAD, r.best)
        for r in forum.scored_questions(raw).collect() if r.tags is not None
    ]
    assert rows(forum.domain_points(raw)) == sorted(expected, key=repr)
    plan = forum.domain_points(raw)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


def test_there_are_fifteen_domains():
    assert len(forum.DOMAINS) == len(set(forum.DOMAINS)) == 15


def test_draws_depend_on_the_seed_only(spark):
    many = points(spark, *[(50000 * (i % 7), i % 90) for i in range(2000)])
    one = rows(forum.sample_centroids(many, seed=1))
    assert one == rows(forum.sample_centroids(many.repartition(7), seed=1))
    assert one != rows(forum.sample_centroids(many, seed=2))
    assert [r[0] for r in sorted(one)] == list(range(45))


def test_draws_follow_the_number_of_equal_points(spark):
    """Of 4,000 draws from points with 1, 2 and 7 copies about 400, 800 and 2,800 hit them."""
    copies = points(spark, (0, 1), *[(0, 2)] * 2, *[(0, 3)] * 7)
    drawn = Counter(r.cy for r in forum.sample_centroids(copies, k=4000, seed=3).collect())
    assert abs(drawn[1] - 400) < 80 and abs(drawn[2] - 800) < 110 and abs(drawn[3] - 2800) < 130


def test_the_lowest_index_wins_ties(spark):
    located = points(spark, (0, 5), (0, 6), (0, 4)).withColumn(
        "cluster", nearest(F.col("x"), F.col("y"), [(0, 10), (0, 0), (0, 10), (0, 0)])
    )
    assert rows(located) == [(0, 4, 1), (0, 5, 0), (0, 6, 0)]


def test_distances_do_not_overflow(spark):
    far = points(spark, (2**31 - 1, 2**31 - 1))
    located = far.withColumn("cluster", nearest(F.col("x"), F.col("y"), [(-(2**31), -(2**31)), (0, 0)]))
    assert located.first().cluster == 1


def test_a_centroid_without_points_stays(spark):
    final = forum.lloyd_kmeans(points(spark, (0, 1), (0, 2)), centroids(spark, (0, 1), (0, 1)))
    assert rows(final) == [(0, 0, 1), (1, 0, 1)]


def test_means_truncate_towards_zero(spark):
    def mean(*pairs):
        return lloyd.one_round(forum.staged_points(points(spark, *pairs)), [(0, 0)]).centroids

    assert mean((0, 1), (0, 2)) == [(0, 1)]
    assert mean((-50000, 1), (-49999, 2)) == [(-49999, 1)]


def brute_kmeans(data, start, eta, max_iter):
    current, done = list(start), 0
    while True:
        groups = {}
        for x, y in data:
            near = min(range(len(current)), key=lambda i: ((x - current[i][0]) ** 2 + (y - current[i][1]) ** 2, i))
            groups.setdefault(near, []).append((x, y))
        moved = list(current)
        for i, members in groups.items():
            moved[i] = tuple(int(sum(m[c] for m in members) / len(members)) for c in (0, 1))
        shift = sum((a - c) ** 2 + (b - d) ** 2 for (a, b), (c, d) in zip(current, moved))
        current, done = moved, done + 1
        if shift < eta or done > max_iter:
            return current, done


@pytest.mark.parametrize(("eta", "max_iter"), [(20.0, 120), (20.0, 2), (0.0, 3)])
def test_rounds_against_brute_force(spark, eta, max_iter):
    rng = random.Random(5)
    data = [(50000 * rng.randrange(-1, 4), rng.randrange(300)) for _ in range(400)]
    start = rng.choices(data, k=9)
    expected, done = brute_kmeans(data, start, eta, max_iter)
    weighted = forum.staged_points(points(spark, *data))
    assert len(list(lloyd.rounds(weighted, start, eta, max_iter))) == done
    final = forum.lloyd_kmeans(points(spark, *data), centroids(spark, *start), eta, max_iter)
    assert [(r.cx, r.cy) for r in sorted(final.collect(), key=lambda r: r.cluster)] == expected
    report = forum.cluster_report(points(spark, *data), final).collect()
    assert sum(r.size for r in report) == len(data)
    assert [r.avg for r in report] == sorted(r.avg for r in report)


def test_no_points_give_no_centroids_and_an_empty_report(spark):
    none = spark.createDataFrame([], "x bigint, y bigint")
    drawn = forum.sample_centroids(none)
    final = forum.lloyd_kmeans(none, drawn)
    assert final.count() == 0 and forum.cluster_report(none, final).count() == 0


def test_report_of_one_cluster(spark):
    data = points(spark, *[(100000, y) for y in (3, 9, 0, 4, 4, 10)])
    report = forum.cluster_report(data, centroids(spark, (100000, 5), (700000, 0)))
    assert rows(report) == [(0, 100000, 5, "Algorithm", 6, 4, 5)]


def test_report_names_no_domain_left_of_the_first(spark):
    data = points(spark, (-50000, 1), (0, 2), (30000, 4))
    report = forum.cluster_report(data, centroids(spark, (-50000, 1), (-1, 2), (49999, 4)))
    assert [(r.cx, r.domain) for r in report.collect()] == [
        (-50000, None), (-1, "Machine-Learning"), (49999, "Machine-Learning")
    ]


def test_averages_of_large_scores_do_not_overflow(spark):
    report = forum.cluster_report(points(spark, *[(0, 2_000_000_000)] * 3), centroids(spark, (0, 0))).first()
    assert (report.size, report.median, report.avg) == (3, 2_000_000_000, 2_000_000_000)


@pytest.mark.parametrize("spread", [3, 1000, 2**31])
def test_summary_against_brute_force(spark, spread):
    rng = random.Random(spread)
    data = [(g, rng.randrange(-spread, spread), rng.randrange(1, 4)) for g in range(4) for _ in range(1 + 12 * g)]
    found = score_summary(spark.createDataFrame(data, "g int, y bigint, w bigint"), "g", "y", "w")
    expected = []
    for g in range(4):
        values = [y for group, y, w in data if group == g for _ in range(w)]
        low, high = statistics.median_low(values), statistics.median_high(values)
        total = sum(values)
        average = abs(total) // len(values) * (1 if total >= 0 else -1)
        middle = abs(low + high) // 2 * (1 if low + high >= 0 else -1)
        expected.append((g, len(values), middle, average))
    assert sorted(rows(found)) == expected
