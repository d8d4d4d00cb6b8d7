"""Life cycle of tabular binary classifiers on Spark."""
