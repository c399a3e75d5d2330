"""entityloom: entity-centric feature engineering and binary scoring on Spark."""

from entityloom.schema import EntitySchema
from entityloom.session import build_session, ensure_checkpoint_dir

__all__ = ["EntitySchema", "build_session", "ensure_checkpoint_dir"]
