"""stayloom: multimodal hospital-stay datasets, features and metrics as Spark jobs."""

from stayloom.config import TrainingConfig
from stayloom.session import build_session, settle, tune

__all__ = ["TrainingConfig", "build_session", "settle", "tune"]
