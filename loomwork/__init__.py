"""Batch analytics over text, ratings and forum postings, written as Spark jobs."""
