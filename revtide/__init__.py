"""Change-log projection, retrieval and recovery as Spark DataFrame operators."""

from revtide.session import build_session, scratch_dir
from revtide.verdicts import Refused, require_ok

__all__ = ["Refused", "build_session", "require_ok", "scratch_dir"]
