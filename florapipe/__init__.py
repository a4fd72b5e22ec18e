"""florapipe: entity enrichment as Spark DataFrame, SQL and Structured Streaming jobs."""

from florapipe.session import checkpoint_dir, get_session, scratch_path

__all__ = ["get_session", "checkpoint_dir", "scratch_path"]
