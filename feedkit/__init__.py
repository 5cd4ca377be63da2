"""feedkit: feed loading, table linking, name reconciliation and data checks as Spark DataFrame operators."""

__version__ = "0.1.0"
