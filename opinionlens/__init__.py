"""Opinion analytics over labelled social posts, expressed as Spark DataFrame operators."""

__version__ = "0.1.0"
