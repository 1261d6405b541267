"""All registered queries."""

from . import feature_plans, funnel_plans, model_plans, quality_plans, segment_plans, star_plans, stats_plans  # noqa: F401
from .registry import QUERIES  # noqa: F401
