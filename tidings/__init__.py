"""tidings: a Spark-native engine that collects news-article feeds,
deduplicates and caps them per fetch run, clusters each topic-day and
assembles reviewed digest articles.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions; Python only runs inside Arrow-batched pandas functions where the
built-in operators cannot express the semantics (clustering, pluggable
embedding and summarising functions).
"""

__all__ = ["session", "constants", "schemas"]
