"""The first rollup: one row per user and session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leavewatch import fixed_values as fixed


def named(measures: dict[str, str]) -> list[Column]:
    """SQL expressions as columns under their names."""
    return [F.expr(f"{sql} AS {name}") for name, sql in measures.items()]


def quoted(label: str | int) -> str:
    """A label as a SQL literal."""
    if isinstance(label, int):
        return str(label)
    return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"


def count_sql(column: str, label: str | int) -> str:
    return f"count(CASE WHEN {column} = {quoted(label)} THEN 1 END)"


def flag_sql(column: str, label: str) -> str:
    return f"max(CASE WHEN {column} = {quoted(label)} THEN 1 ELSE 0 END)"


def counted_labels(signup_pages: bool = False) -> dict[str, tuple[str, str | int]]:
    """Counter name -> (column, label), in output order."""
    groups = [
        ("status", fixed.STATUS_COUNTS),
        ("level", fixed.LEVEL_COUNTS),
        ("method", fixed.METHOD_COUNTS),
        ("page", fixed.PAGE_COUNTS),
        ("page", fixed.CANCEL_COUNTS),
    ]
    if signup_pages:
        groups.append(("page", fixed.SIGNUP_PAGE_COUNTS))
    return {name: (column, label)
            for column, labels in groups for name, label in labels.items()}


def agent_counter(rank: int) -> str:
    return f"num_userAgent_{rank}_interactions"


def session_measure_sql(guards: bool = True, signup_pages: bool = False,
                        agents: Sequence[str] = ()) -> dict[str, str]:
    """Session measure -> SQL aggregate over the clean log, in output order."""
    or_zero = "coalesce({}, 0D)" if guards else "{}"
    measures = {
        "num_items_in_session": "max(itemInSession)",
        "longest_song_in_session": or_zero.format("max(length)"),
        "session_listening_time": or_zero.format("sum(length)"),
        "number_of_songs": "count(song)",
        "session_begin": "min(ts)",
        "session_end": "max(ts)",
        "session_length": "max(ts) - min(ts)",
        "registration": "coalesce(min(registration), min(ts))" if guards else "min(registration)",
        "cancelled": flag_sql("page", fixed.LABEL_PAGE),
    }
    for name, label in fixed.GENDER_FLAGS.items():
        measures[name] = flag_sql("gender", label)
    for name, (column, label) in counted_labels(signup_pages).items():
        measures[name] = count_sql(column, label)
    for rank, label in enumerate(agents):
        measures[agent_counter(rank)] = count_sql("userAgent", label)
    return measures


def session_measures(log: DataFrame, guards: bool = True, signup_pages: bool = False,
                     agents: Sequence[str] = ()) -> DataFrame:
    """Session measures with times still in the unit of the log.

    One hash aggregate. Its map side reduces a session to one row per task
    before the shuffle, so a session or user that holds much of the log is
    no hot spot.
    """
    measures = session_measure_sql(guards, signup_pages, agents)
    return log.groupBy("userId", "sessionId").agg(*named(measures))


def browser_rollup(log: DataFrame, signup_pages: bool = False) -> DataFrame:
    """Parts of the session measures by session and browser string, and ``n_events``.

    Every session measure is a maximum, minimum, sum or count, so the parts of
    a session merge (:func:`merged_sessions`). Browser strings may be raw: they
    are few here, and cleaned later.
    """
    parts = {
        "items": "max(itemInSession)",
        "longest": "max(length)",
        "listened": "sum(length)",
        "songs": "count(song)",
        "begin": "min(ts)",
        "end": "max(ts)",
        "registered": "min(registration)",
        "n_events": "count(1)",
        "cancelled": flag_sql("page", fixed.LABEL_PAGE),
    }
    for name, label in fixed.GENDER_FLAGS.items():
        parts[name] = flag_sql("gender", label)
    for name, (column, label) in counted_labels(signup_pages).items():
        parts[name] = count_sql(column, label)
    return log.groupBy("userId", "sessionId", "userAgent").agg(*named({f"`{k}`": v for k, v in parts.items()}))


def merged_sessions(parts: DataFrame, guards: bool = True, signup_pages: bool = False) -> DataFrame:
    """The columns of :func:`session_measures` from :func:`browser_rollup`."""
    or_zero = "coalesce({}, 0D)" if guards else "{}"
    measures = {
        "num_items_in_session": "max(items)",
        "longest_song_in_session": or_zero.format("max(longest)"),
        "session_listening_time": or_zero.format("sum(listened)"),
        "number_of_songs": "sum(songs)",
        "session_begin": "min(`begin`)",
        "session_end": "max(`end`)",
        "session_length": "max(`end`) - min(`begin`)",
        "registration": "coalesce(min(registered), min(`begin`))" if guards else "min(registered)",
    }
    for flag in ["cancelled", *fixed.GENDER_FLAGS]:
        measures[flag] = f"max({flag})"
    for counter in counted_labels(signup_pages):
        measures[counter] = f"sum({counter})"
    return parts.groupBy("userId", "sessionId").agg(*named(measures))


def session_rollup(log: DataFrame, guards: bool = True, signup_pages: bool = False,
                   agents: Sequence[str] = (),
                   ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> DataFrame:
    """Session table with times in seconds.

    ``guards`` turns missing listening into 0 and a missing registration into
    the session's begin; without it they stay null. Pass
    ``ticks_per_second=1`` for a log whose times are already seconds.
    """
    sessions = session_measures(log, guards, signup_pages, agents)
    times = ["session_begin", "session_end", "session_length", "registration"]
    return sessions.withColumns({c: F.col(c) / ticks_per_second for c in times})
