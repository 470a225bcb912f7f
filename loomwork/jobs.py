"""The four jobs on files, for spark-submit or ``python -m loomwork.jobs <job> …``.

The session, its master and ``spark.checkpoint.dir`` come from the submitting environment.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loomwork.plans import common_words, forum, recommend, text_clusters
from loomwork.sources import records, text_files
from loomwork.staging import job_staging


def run_common_words(spark: SparkSession, args: argparse.Namespace) -> None:
    """``count<TAB>word`` lines, most frequent first."""
    corpus = text_files.read_corpora(spark, args.corpus1, args.corpus2)
    top = common_words.top_common_words(corpus, text_files.read_stop_words(spark, args.stop_words), args.k)
    text_files.write_key_values(top, args.output, "count", "word")


def run_recommend(spark: SparkSession, args: argparse.Namespace) -> None:
    """``user<TAB>item,score`` lines, with --sorted in text order of user and item."""
    scores = recommend.recommend(records.read_ratings(spark, args.ratings, args.malformed))
    order = recommend.recommendation_order() if args.sorted else None
    text_files.write_key_values(scores, args.output, "user", "item", "score", order_by=order)


def run_forum(spark: SparkSession, args: argparse.Namespace) -> None:
    """The cluster report as CSV with a header, lowest average first."""
    raw = records.read_postings(spark, args.postings, args.malformed)
    points = forum.staged_points(forum.domain_points(raw, spread=args.spread))
    drawn = forum.sample_centroids(points, args.k, args.seed)
    final = forum.lloyd_kmeans(points, drawn, args.eta, args.max_iter)
    forum.cluster_report(points, final, spread=args.spread).coalesce(1).write.csv(args.output, header=True)


def run_texts(spark: SparkSession, args: argparse.Namespace) -> None:
    """``centers``: cluster centres with sizes and the silhouette, ``clusters``: each text with its cluster, as JSON lines."""
    texts = text_files.read_csv_texts(spark, args.texts, args.position)
    stop = text_files.read_stop_words(spark, args.stop_words)
    result = text_clusters.cluster_texts(
        texts.withColumn("words", F.col("text")), stop, text="words", k=args.k, max_iter=args.max_iter, seed=args.seed,
        vector_size=args.vector_size, min_count=args.min_count,
    )
    silhouette = F.lit(result.silhouette).cast("double")
    result.centers.withColumn("silhouette", silhouette).write.json(f"{args.output}/centers")
    result.predicted.select("text", "predicted_cluster").write.json(f"{args.output}/clusters")


def parser() -> argparse.ArgumentParser:
    main_parser = argparse.ArgumentParser(prog="loomwork.jobs")
    jobs = main_parser.add_subparsers(required=True)

    def job(name: str, run, *paths: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name, help=run.__doc__)
        for path in (*paths, "output"):
            added.add_argument(path)
        added.set_defaults(run=run)
        return added

    job("common-words", run_common_words, "corpus1", "corpus2", "stop_words").add_argument("--k", type=int, default=20)
    malformed = {"choices": ["raise", "skip"], "default": "raise"}
    recommend_job = job("recommend", run_recommend, "ratings")
    recommend_job.add_argument("--malformed", **malformed)
    recommend_job.add_argument("--sorted", action="store_true")
    forum_job = job("forum", run_forum, "postings")
    forum_job.add_argument("--malformed", **malformed)
    forum_job.add_argument("--k", type=int, default=forum.CLUSTERS)
    forum_job.add_argument("--seed", type=int, default=1)
    forum_job.add_argument("--spread", type=int, default=forum.SPREAD)
    forum_job.add_argument("--eta", type=float, default=forum.ETA)
    forum_job.add_argument("--max-iter", type=int, default=forum.MAX_ITER)
    texts_job = job("texts", run_texts, "texts", "stop_words")
    texts_job.add_argument("--position", type=int, default=5)
    texts_job.add_argument("--k", type=int, default=2)
    texts_job.add_argument("--seed", type=int, default=1)
    texts_job.add_argument("--max-iter", type=int, default=20)
    texts_job.add_argument("--vector-size", type=int, default=100)
    texts_job.add_argument("--min-count", type=int, default=5)
    return main_parser


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("loomwork").getOrCreate()
    with job_staging(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
