"""The runnable queries. Importing this package registers all of them."""
from regulus.plans import analysis, changes, facts, governance, graph, indicators, reports  # noqa: F401
from regulus.plans.registry import QUERIES, oracles  # noqa: F401
