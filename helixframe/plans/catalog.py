"""Every query of the library outside the training-data operators."""

from helixframe.plans.registry import Registry

QUERIES = Registry()
