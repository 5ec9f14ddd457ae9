"""bidscope: procurement-contract analytics expressed as Spark DataFrame plans.

Every operator is a pure function ``DataFrame -> DataFrame`` (or a small
family of them) keyed by an explicit ``uid`` column.  Nothing is collected
to the driver except bounded scalars (a handful of thresholds, one row per
shuffle partition at most).
"""

from bidscope.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
