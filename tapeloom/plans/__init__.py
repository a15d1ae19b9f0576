"""Whole pipelines from raw trades to analytics tables."""

from tapeloom.plans.flat_table import flat
from tapeloom.plans.job import Job, run
from tapeloom.plans.silver_table import SilverOptions, silver, silver_by_company

__all__ = ["Job", "SilverOptions", "flat", "run", "silver", "silver_by_company"]
