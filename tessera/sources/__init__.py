"""Sources and sinks: the driver's Parquet tables, CSV/JSON/text inputs, writers."""

from tessera.sources.tables import TABLES, table, tables  # noqa: F401
from tessera.sources.files import *  # noqa: F401,F403
