"""Full-replace publishing of datasets and marts."""

from martwright.sinks.publish import publish
from martwright.sinks.scratch import clean, written

__all__ = ["clean", "publish", "written"]
