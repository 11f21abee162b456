"""All registered queries."""

from lumenframe.plans import bins, classify, curves, detect, lines, quality, selection, spatial, spectra  # noqa: F401
from lumenframe.plans.registry import ORACLES, QUERIES  # noqa: F401
