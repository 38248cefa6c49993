"""nearmiss — close-encounter analytics for vessel position reports on Spark.

Pure DataFrame → DataFrame operators (``nearmiss.operators``), Column helpers
(``nearmiss.functions``), sources and sinks (``nearmiss.sources``) and the stage
chains (``nearmiss.plans``). No operator creates a session, reads the
environment or collects to the driver.
"""

from nearmiss.config import EncounterConfig, ScoreWeights

__all__ = ["EncounterConfig", "ScoreWeights"]
