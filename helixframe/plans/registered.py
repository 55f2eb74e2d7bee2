"""Imports every module that registers queries."""

from helixframe.plans import alignment_queries, classifier_queries, extraction_queries, family_queries, format_queries, gate_queries, interval_queries, kernel_queries, sampling_queries, sequence_queries, set_queries, source_queries, structure_queries  # noqa: F401
from helixframe.plans.catalog import QUERIES  # noqa: F401
