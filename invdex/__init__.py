"""invdex: inverted index build and boolean keyword search on Spark."""

__version__ = "0.1.0"
