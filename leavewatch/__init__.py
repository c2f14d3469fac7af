"""Leavewatch: user-event analytics on Spark, from raw log to churn model.

Every operator takes and returns DataFrames. None of them starts a session,
and none brings rows of the log to the driver.
"""
