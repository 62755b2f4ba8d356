"""tidepool: behaviour-analytics operators expressed as Spark DataFrame plans.

Every operator takes DataFrames and returns DataFrames. Batch forms are
declarative (Catalyst plans them); streaming forms live in
``tidepool.streaming``.
"""

from tidepool.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
