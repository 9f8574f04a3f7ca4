"""corpusloom: a Spark-native engine that turns raw web documents into training data."""

__version__ = "0.1.0"
