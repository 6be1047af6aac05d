"""bookflow: page, line, paragraph and section dataflow for book corpora on Spark."""

__version__ = "0.1.0"
