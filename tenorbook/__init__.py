"""Treasury deposit analytics as plain Spark DataFrame functions."""

from tenorbook.config import Config
from tenorbook.plans.build import build, publish_views
from tenorbook.plans.publishing import PublishFailed, is_current, publish
from tenorbook.sources.files import Sources
from tenorbook.sources.loading import load_deals, loaded_deals, rejected_lines
from tenorbook.sources.versions import published_counts, published_tables, retire

__all__ = [
    "Config",
    "PublishFailed",
    "Sources",
    "build",
    "is_current",
    "load_deals",
    "loaded_deals",
    "publish",
    "publish_views",
    "published_counts",
    "published_tables",
    "rejected_lines",
    "retire",
]
