"""Column functions: text clean-up, guarded arithmetic, stable hashing."""

from leavewatch.functions.numeric import (
    guarded_ratio,
    hash_percent,
    hours,
    sign_colour,
    stable_hash,
    student_975,
)
from leavewatch.functions.text import (
    cleaned_artist,
    cleaned_user_agent,
    user_key_by_path,
    user_key_by_pattern,
)

__all__ = [
    "cleaned_artist", "cleaned_user_agent", "guarded_ratio", "hash_percent",
    "hours", "sign_colour", "stable_hash", "student_975",
    "user_key_by_path", "user_key_by_pattern",
]
