"""Registered queries over the driver's tables (Spark plan + SQL oracle each).

Importing this package registers every query module.
"""

from tessera.plans.registry import HEADLINE, ORACLES, QUERIES, register  # noqa: F401
from tessera.plans import recsys, profiling, prep, evaluation, textplans, matching, models, causalplans, graphplans, framesplans, roundtrips, corpusplans  # noqa: F401,E402
