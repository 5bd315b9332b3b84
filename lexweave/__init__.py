"""lexweave: Spark-native analytics for rule corpora, document provenance and molecular names."""

__version__ = "0.1.0"
