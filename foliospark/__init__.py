"""Document transforms, metadata and redaction as Spark jobs over tables of documents."""

__version__ = "0.1.0"
