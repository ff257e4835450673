"""korale: a Spark-first engine for bilingual corpora, chat examples and feedback tables."""
