"""terrace: a medallion warehouse for online-retail data, written as Spark jobs."""

__version__ = "0.1.0"
