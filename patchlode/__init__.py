"""Mining of recurring source-to-sink patterns in code-change data, as Spark jobs."""

__version__ = "0.1.0"
