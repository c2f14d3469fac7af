"""The second rollup: one row of behaviour features per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.text import cleaned_user_agent
from leavewatch.operators.cleaning import fill_registration, fill_zero, rename_features
from leavewatch.operators.sessions import (
    agent_counter,
    browser_rollup,
    counted_labels,
    merged_sessions,
    named,
    session_measures,
)
from leavewatch.sources.shared_storage import cut_lineage


def _per_session(counter: str) -> str:
    """Mean of a counter that is never null.

    Same value as ``avg`` with half the buffer fields, which keeps the wide
    aggregate within generated code.
    """
    return f"sum({counter}) / count(1)"


def feature_name(measure: str) -> str:
    """Name of a session measure's mean; browser means leave out ``num``."""
    return "avg_" + measure.replace("num_userAgent", "userAgent")


def feature_sql_table(guards: bool = True, signup_pages: bool = False, n_agents: int = 0,
                      ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> dict[str, str]:
    """User feature -> SQL aggregate over the session measures, in output order.

    Times are subtracted as whole ticks and divided last.
    """
    ticks = ticks_per_second
    idle = "max(session_end) - min(session_begin) - sum(session_length)"
    song_length = "try_divide(sum(session_listening_time), sum(number_of_songs))"
    if guards:
        song_length = f"if(sum(number_of_songs) <= 0, 0D, {song_length})"
    features = {
        "avg_num_items_in_session": "avg(num_items_in_session)",
        "longest_song": "max(longest_song_in_session)",
        "longest_song_per_session": "avg(longest_song_in_session)",
        "total_number_of_sessions": "count(sessionId)",
        "listening_time_per_session": "try_divide(sum(session_listening_time), count(sessionId))",
        "avg_number_of_songs_per_session": "try_divide(sum(number_of_songs), count(sessionId))",
        "avg_song_length": song_length,
        "avg_session_length": f"avg(session_length) / {ticks}",
        "time_since_joined": f"(max(session_end) - min(registration)) / {ticks}",
        "time_to_first_session": f"(min(session_begin) - min(registration)) / {ticks}",
        "avg_time_between_sessions":
            f"if(count(sessionId) <= 1, 0D, try_divide({idle}, count(sessionId) - 1)) / {ticks}",
    }
    genders = list(fixed.GENDER_FLAGS)
    for flag in genders if guards else genders[:2]:
        features[feature_name(flag)] = _per_session(flag)
    for counter in counted_labels(signup_pages):
        if counter not in fixed.CANCEL_COUNTS:
            features[feature_name(counter)] = _per_session(counter)
    for rank in range(n_agents):
        features[feature_name(agent_counter(rank))] = _per_session(agent_counter(rank))
    features["cancelled"] = "max(cancelled)"
    return features


def features_from_sessions(sessions: DataFrame, guards: bool = True, signup_pages: bool = False,
                           n_agents: int = 0,
                           ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> DataFrame:
    """User features from :func:`session_measures`, times in seconds."""
    features = feature_sql_table(guards, signup_pages, n_agents, ticks_per_second)
    return sessions.groupBy("userId").agg(*named(features))


def user_features(log: DataFrame, guards: bool = True, signup_pages: bool = False,
                  agents: Sequence[str] = (),
                  ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> DataFrame:
    """User features straight from the clean log, in two aggregates.

    ``agents`` adds one column per browser label, in the order given.
    """
    sessions = session_measures(log, guards, signup_pages, agents)
    return features_from_sessions(sessions, guards, signup_pages, len(agents), ticks_per_second)


def user_features_extended(log: DataFrame, agents: Sequence[str] = (),
                           alternate_names: bool = False,
                           ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> DataFrame:
    """The variant with sign-up pages, row-wise registration fill and no nulls."""
    features = user_features(fill_registration(log), True, True, agents, ticks_per_second)
    return without_nulls(features, alternate_names)


def without_nulls(features: DataFrame, alternate_names: bool = False) -> DataFrame:
    features = fill_zero(features)
    if alternate_names:
        features = rename_features(features, fixed.ALTERNATE_FEATURE_NAMES)
    return features


def browser_user_features(log: DataFrame, guards: bool = True, signup_pages: bool = False,
                          max_labels: int | None = None,
                          ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> DataFrame:
    """User features with one column per browser label, from one scan of the log.

    The log keeps its raw browser strings (``clean_events(agent=False)``). It
    is rolled up by session and string and stored; labels, sessions and the
    means per label all follow from that much smaller table. There may be any
    number of labels; a caller who cannot use more than ``max_labels`` gets an
    error beyond it.
    """
    parts = cut_lineage(browser_rollup(log, signup_pages))
    label = F.coalesce(cleaned_user_agent(F.col("userAgent")), F.lit(fixed.UNKNOWN))
    by_label = parts.select("userId", label.alias("label"), "n_events")
    counts = by_label.groupBy("label").agg(F.sum("n_events").alias("n"))
    rows = (counts if max_labels is None else counts.limit(max_labels + 1)).collect()
    if max_labels is not None and len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} labels in userAgent")
    labels = [r["label"] for r in sorted(rows, key=lambda r: (-r["n"], r["label"]))]
    features = features_from_sessions(merged_sessions(parts, guards, signup_pages), guards,
                                      signup_pages, ticks_per_second=ticks_per_second)
    if not labels:
        return features
    names = [feature_name(agent_counter(rank)) for rank in range(len(labels))]
    counted = (by_label.groupBy("userId").pivot("label", labels).agg(F.sum("n_events"))
               .toDF("userId", *names))
    means = [(F.coalesce(n, F.lit(0)) / F.col("total_number_of_sessions")).alias(n) for n in names]
    plain = [c for c in features.columns if c != "cancelled"]
    return features.join(counted, "userId").select(*plain, *means, "cancelled")


def user_agent_features(log: DataFrame, clean_agents: bool = False) -> DataFrame:
    """Average events per session by user and browser, one row per pair.

    The long form of the browser columns, for any number of browsers. A
    session without the browser counts as 0, so the divisor is the user's
    number of sessions. ``clean_agents`` takes raw browser strings and cleans
    them after the log has been counted.
    """
    counted = (log.groupBy("userId", "sessionId", "userAgent")
               .agg(F.count(F.lit(1)).alias("n")))
    # Counting n keeps both branches alike up to the first shuffle, which then
    # serves both.
    sessions = (counted.groupBy("userId", "sessionId").agg(F.sum("n").alias("n"))
                .groupBy("userId").agg(F.count("n").alias("n_sessions")))
    agent = F.col("userAgent")
    if clean_agents:
        agent = F.coalesce(cleaned_user_agent(agent), F.lit(fixed.UNKNOWN))
    by_agent = (counted.withColumn("userAgent", agent)
                .groupBy("userId", "userAgent").agg(F.sum("n").alias("n")))
    return (by_agent.join(sessions, "userId")
            .select("userId", "userAgent",
                    (F.col("n") / F.col("n_sessions")).alias("avg_interactions")))
