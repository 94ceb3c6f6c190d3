"""tidelog: incremental replication and subset queries as Spark DataFrame plans."""

__version__ = "0.1.0"
