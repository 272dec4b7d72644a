"""All registered queries."""

from vitalgrid.plans import q_sources, q_series, q_detect, q_forecast, q_features, q_reports, q_window_features  # noqa: F401
from vitalgrid.plans.registry import ORACLES, QUERIES  # noqa: F401
