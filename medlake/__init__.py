"""medlake: lake ingestion, table quality, retrieval and answering jobs on Spark."""

__version__ = "0.1.0"
