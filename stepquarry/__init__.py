"""stepquarry: a Spark-first engine for corpora of statements with ordered construction steps."""

__version__ = "0.1.0"
