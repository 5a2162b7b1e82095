"""The queries of the library on the given tables."""

from workload import chain, history, keys, reports, shape, storage, warehouse  # noqa: F401
from workload.registry import QUERIES, SQL  # noqa: F401
