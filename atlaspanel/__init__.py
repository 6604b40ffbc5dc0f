"""atlaspanel: a Spark-native engine for country x year indicator panels."""

__version__ = "0.1.0"
