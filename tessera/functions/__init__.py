"""Column-expression helpers (JVM-side built-ins only, no Python UDFs)."""

from tessera.functions.exprs import *  # noqa: F401,F403
