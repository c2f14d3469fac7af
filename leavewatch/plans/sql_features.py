"""User features as SQL text, and both forms as ML transformers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from leavewatch import fixed_values as fixed
from leavewatch.operators.sessions import session_measure_sql
from leavewatch.operators.users import feature_sql_table, user_features
from leavewatch.sources.event_log import register_view, run_sql


def feature_sql(view: str, agents: Sequence[str] = (),
                ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> str:
    """SQL text of the guarded user features over a view of the clean log."""
    def listed(measures: dict[str, str]) -> str:
        return ",\n    ".join(f"{sql} AS {name}" for name, sql in measures.items())

    features = feature_sql_table(n_agents=len(agents), ticks_per_second=ticks_per_second)
    return f"""
WITH sessions AS (
  SELECT userId, sessionId,
    {listed(session_measure_sql(agents=agents))}
  FROM {view} GROUP BY userId, sessionId
)
SELECT userId,
    {listed(features)}
FROM sessions GROUP BY userId
"""


def sql_user_features(log: DataFrame, view: str, agents: Sequence[str] = (),
                      ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> DataFrame:
    """Register the clean log as a view and run the SQL text on it."""
    register_view(log, view)
    return run_sql(log, feature_sql(view, agents, ticks_per_second))


class _AgentParams(Params):
    agents = Param(Params._dummy(), "agents", "browser labels, in column order",
                   TypeConverters.toListString)
    ticksPerSecond = Param(Params._dummy(), "ticksPerSecond", "time units of the log per second",
                           TypeConverters.toInt)


class UserFeatureTransformer(Transformer, _AgentParams, DefaultParamsReadable,
                             DefaultParamsWritable):
    """Clean log in, user features out; fits into an ML pipeline and can be saved."""

    guards = Param(Params._dummy(), "guards", "turn missing values into 0",
                   TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, agents: Sequence[str] = (), guards: bool = True,
                 ticksPerSecond: int = fixed.MILLIS_PER_SECOND):
        super().__init__()
        self._setDefault(agents=[], guards=True, ticksPerSecond=fixed.MILLIS_PER_SECOND)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return user_features(dataset, get(self.guards), False, get(self.agents),
                             get(self.ticksPerSecond))


class SqlFeatureTransformer(Transformer, _AgentParams, DefaultParamsReadable,
                            DefaultParamsWritable):
    """The same features from SQL text over a named view."""

    tableName = Param(Params._dummy(), "tableName", "view the log is registered as",
                      TypeConverters.toString)

    @keyword_only
    def __init__(self, *, tableName: str = "event_log", agents: Sequence[str] = (),
                 ticksPerSecond: int = fixed.MILLIS_PER_SECOND):
        super().__init__()
        self._setDefault(tableName="event_log", agents=[],
                         ticksPerSecond=fixed.MILLIS_PER_SECOND)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return sql_user_features(dataset, get(self.tableName), get(self.agents),
                                 get(self.ticksPerSecond))
