"""cityflow: data-preparation and daily-fact operators for batch medallion
pipelines, as DataFrame -> DataFrame functions on Spark."""

from .session import build_session, ensure_checkpoint_dir, pin

__all__ = ["build_session", "ensure_checkpoint_dir", "pin"]
