"""catloom: catalogue curation and data quality on Apache Spark DataFrames."""

__version__ = "0.1.0"
