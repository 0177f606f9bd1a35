"""Entity mastering on Spark: feeds in, golden records out."""

from goldweave.config import MasteringConfig
from goldweave.session import build_session, tune

__all__ = ["MasteringConfig", "build_session", "tune"]
