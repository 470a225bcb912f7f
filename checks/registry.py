"""The registered queries: each takes a session and a folder of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from loomwork.operators import lloyd, vector_clusters
from loomwork.operators.group_medians import group_medians
from loomwork.operators.positions import numbered
from loomwork.operators.ratings import latest_entries
from loomwork.operators.tokens import vocabulary
from loomwork.operators.word_counts import (
    common_counts,
    corpus_words,
    counts_by_source,
    counts_without,
)
from loomwork.plans import common_words, forum, recommend, text_clusters
from loomwork.sources import records, text_files
from loomwork.staging import staged, staging_path

Query = Callable[[SparkSession, str], DataFrame]


def word_counts_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_by_source(corpus_words(views.corpus(spark, sf_dir)))


def stopword_filtered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_without(corpus_words(views.corpus(spark, sf_dir)), views.stop_words(spark))


def common_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_counts(stopword_filtered_counts(spark, sf_dir))


def top_common_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_words.top_common_words(views.corpus(spark, sf_dir), views.stop_words(spark))


def stop_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a stop list that was written to a file: the words that begin with a or d in the conversations."""
    path = staging_path(spark)
    said = corpus_words(views.corpus(spark, sf_dir).where("source = 1")).select("word").where("word rlike '^[ad]'").distinct()
    said.write.text(path)
    return counts_without(corpus_words(views.corpus(spark, sf_dir)), text_files.read_stop_words(spark, path))


def ordered_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations written in the order of their text key, with the place each line came to."""
    path = staging_path(spark)
    order = recommend.recommendation_order()
    scores = recommendations(spark, sf_dir).withColumn("score", F.col("score").cast("bigint"))
    text_files.write_key_values(scores, path, "user", "item", "score", order_by=order)
    lines = text_files.read_lines(spark, path).select("value", "_metadata.file_path", F.monotonically_increasing_id().alias("at"))
    # The lines of a file are read in their order, the files are named in theirs.
    placed = numbered(lines, "place", "file_path", "at")
    return placed.select(F.col("value").alias("line"), (F.col("place") + 1).alias("place"))


def written_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts through the key/value sink and back as lines."""
    path = staging_path(spark)
    text_files.write_key_values(stopword_filtered_counts(spark, sf_dir), path, "word", "n0", "n1")
    return text_files.read_lines(spark, path).withColumnRenamed("value", "line")


def csv_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixth column of the parts written as CSV without a header."""
    path = staging_path(spark)
    parts = views.table(spark, sf_dir, "part")
    parts.select("p_partkey", "p_size", "p_brand", "p_type", "p_retailprice", "p_name").write.csv(path)
    return text_files.read_csv_texts(spark, path)


def parsed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_ratings(views.rating_lines(spark, sf_dir))


def parsed_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-1 for no parent, since data frames of different make show missing whole numbers differently."""
    parsed = records.parse_postings(views.posting_lines(spark, sf_dir))
    return parsed.withColumns({"has_parent": F.col("parent_id").isNotNull(), "parent_id": F.coalesce("parent_id", F.lit(-1))})


def kept_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings among lines of other kinds."""
    return records.sorted_out(views.mixed_rating_lines(spark, sf_dir), records.rating).rows


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other lines, with the field that gives each away."""
    return records.sorted_out(views.mixed_rating_lines(spark, sf_dir), records.rating).rejected


def user_score_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of sparse items; the larger users have more than one block."""
    entry = F.transform("scores", lambda s: F.concat_ws(":", s["item"], s["score"], s["n"]))
    vectors_ = recommend.user_score_vectors(views.part_ratings(spark, sf_dir), width=64)
    return vectors_.select("user", "block", F.concat_ws(",", entry).alias("scores"))


def co_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.co_occurrence(views.ratings(spark, sf_dir))


def part_co_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.co_occurrence(views.part_ratings(spark, sf_dir))


def supplier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.predicted_scores(views.supplier_ratings(spark, sf_dir))


def supplier_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.recommend(views.supplier_ratings(spark, sf_dir))


def score_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.score_products(views.ratings(spark, sf_dir))


def predicted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.predicted_scores(views.ratings(spark, sf_dir))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.recommend(views.ratings(spark, sf_dir))


def latest_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last rating of each customer and brand, by the time in its line."""
    lines = views.timed_rating_lines(spark, sf_dir)
    return latest_entries(records.parse_timed_ratings(lines).withColumn("sequence", F.lit(0)))


def latest_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = records.parse_timed_ratings(views.timed_rating_lines(spark, sf_dir)).withColumn("sequence", F.lit(0))
    return recommend.recommend(timed, repeated="latest")


def part_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median price of every part, in cents."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    lines = views.table(spark, sf_dir, "lineitem").select("l_partkey", cents.alias("cents"))
    found = group_medians(lines, "l_partkey", "cents")
    return found.select("l_partkey", "size", ((F.col("low") + F.col("high")) / 2).alias("median"))


def scored_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forum.scored_questions(views.postings(spark, sf_dir))


def domain_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forum.domain_points(views.postings(spark, sf_dir))


def sample_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forum.sample_centroids(domain_points(spark, sf_dir), seed=views.SEED)


def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = staged(domain_points(spark, sf_dir))
    return lloyd.assigned(points, lloyd.centroid_list(forum.sample_centroids(points, seed=views.SEED)))


def lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = forum.staged_points(domain_points(spark, sf_dir))
    return lloyd.cluster_means(points, lloyd.centroid_list(forum.sample_centroids(points, seed=views.SEED)))


def centroid_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total squared shift of the first round, which decides whether another follows."""
    points = forum.staged_points(domain_points(spark, sf_dir))
    drawn = lloyd.centroid_list(forum.sample_centroids(points, seed=views.SEED))
    return spark.createDataFrame([(lloyd.one_round(points, drawn).shift,)], "shift double")


def lloyd_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = forum.staged_points(domain_points(spark, sf_dir))
    return forum.lloyd_kmeans(points, forum.sample_centroids(points, seed=views.SEED))


def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = forum.staged_points(domain_points(spark, sf_dir))
    final = forum.lloyd_kmeans(points, forum.sample_centroids(points, seed=views.SEED))
    return forum.cluster_report(points, final)


def token_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_clusters.clean_tokens(views.texts(spark, sf_dir), views.stop_words(spark)).select("doc_id", "tokens")


def clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_arrays(spark, sf_dir).select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


def w2v_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(token_arrays(spark, sf_dir))


# Parameters of the trained vectors that the DuckDB query repeats.
VECTORS = {"vector_size": 4, "min_count": 5, "seed": 1, "window": 2, "steps": 3}
CENTERS, ROUNDS = 5, 4


def embed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = text_clusters.embed_texts(token_arrays(spark, sf_dir), **VECTORS).vectors
    parts = [F.round(F.get("vector", F.lit(i)), 6) + 0.0 for i in range(VECTORS["vector_size"])]
    return embedded.select("doc_id", *(part.alias(f"v{i}") for i, part in enumerate(parts)))


def stored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "embeddings")
    return staged(rows.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector")))


def cluster_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster centres by component."""
    vectors = stored_vectors(spark, sf_dir)
    centers = vector_clusters.k_means(vectors, CENTERS, ROUNDS, views.SEED, 0.0, F.col("vec_id"))
    rows = vector_clusters.center_rows(vector_clusters.assigned(vectors, centers), centers)
    return rows.select("cluster", "size", F.posexplode("center").alias("dim", "value")).withColumn(
        "value", F.round("value", 6) + 0.0
    )


def vector_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stored_vectors(spark, sf_dir)
    centers = vector_clusters.k_means(vectors, CENTERS, ROUNDS, views.SEED, 0.0, F.col("vec_id"))
    return vector_clusters.assigned(vectors, centers).select("vec_id", "predicted_cluster")


def kmeans_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What k-means would start from: candidates by the round that drew them, with the rows nearest to each."""
    found = vector_clusters.candidates(stored_vectors(spark, sf_dir), CENTERS, views.SEED, F.col("vec_id"))
    rows = [(int(r), int(w), *(round(x, 6) + 0.0 for x in v[:2])) for v, r, w in zip(found.vectors, found.drawn, found.weights)]
    return spark.createDataFrame(rows, "drawn bigint, weight bigint, v0 double, v1 double")


def row_silhouettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_clusters.silhouettes(stored_vectors(spark, sf_dir), prediction="label")
    return rows.select("vec_id", F.round("silhouette", 9).alias("silhouette"))


def full_embedding(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    embedded = text_clusters.embed_texts(token_arrays(spark, sf_dir), model=model).vectors
    return embedded.select("doc_id", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


def embed_texts_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the default parameters: 100 dimensions, window 5."""
    return full_embedding(spark, sf_dir, "mean")


def embed_texts_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a word tree, 100 dimensions, window 5."""
    return full_embedding(spark, sf_dir, "tree")


def cluster_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain over all documents with its default parameters, and the silhouette of each text."""
    done = text_clusters.cluster_texts(views.texts(spark, sf_dir), views.stop_words(spark), model="tree")
    scored = vector_clusters.silhouettes(done.predicted)
    return scored.select("doc_id", "predicted_cluster", F.round("silhouette", 6).alias("silhouette"))


#: Queries that SQL cannot repeat: tests compare them with plain versions on small texts.
WITHOUT_SQL = {"embed_texts_full", "embed_texts_tree", "cluster_texts"}


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = stored_vectors(spark, sf_dir).withColumnRenamed("label", "predicted_cluster")
    return spark.createDataFrame([(round(vector_clusters.silhouette(labelled), 9),)], "silhouette double")


def queries() -> dict[str, Query]:
    return {
        "word_counts_by_source": word_counts_by_source,
        "stopword_filtered_counts": stopword_filtered_counts,
        "common_word_counts": common_word_counts,
        "stop_file_counts": stop_file_counts,
        "top_common_words": top_common_words,
        "written_word_counts": written_word_counts,
        "csv_texts": csv_texts,
        "parsed_ratings": parsed_ratings,
        "parsed_postings": parsed_postings,
        "kept_ratings": kept_ratings,
        "rejected_lines": rejected_lines,
        "user_score_vectors": user_score_vectors,
        "co_occurrence": co_occurrence,
        "score_products": score_products,
        "predicted_scores": predicted_scores,
        "recommend": recommendations,
        "part_co_occurrence": part_co_occurrence,
        "supplier_scores": supplier_scores,
        "supplier_recommendations": supplier_recommendations,
        "ordered_recommendations": ordered_recommendations,
        "scored_questions": scored_questions,
        "domain_points": domain_points,
        "sample_centroids": sample_centroids,
        "nearest_centroid": nearest_centroid,
        "lloyd_step": lloyd_step,
        "centroid_shift": centroid_shift,
        "lloyd_kmeans": lloyd_kmeans,
        "cluster_report": cluster_report,
        "clean_tokens": clean_tokens,
        "w2v_vocabulary": w2v_vocabulary,
        "embed_texts": embed_texts,
        "cluster_vectors": cluster_vectors,
        "vector_assignments": vector_assignments,
        "silhouette": silhouette,
        "row_silhouettes": row_silhouettes,
        "kmeans_candidates": kmeans_candidates,
        "part_medians": part_medians,
        "latest_ratings": latest_ratings,
        "latest_recommendations": latest_recommendations,
        "embed_texts_full": embed_texts_full,
        "embed_texts_tree": embed_texts_tree,
        "cluster_texts": cluster_texts,
    }
