"""flightmarts: monthly flight-leg cleaning, KPI marts, checks, gate and export on Spark.

Every public function takes and returns ``DataFrame``s (or writes them); the
library never pins a master, never creates a global session, and uses no UDFs.
"""

__version__ = "0.1.0"
