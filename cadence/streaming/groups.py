"""Keys of the stateful Python operators: groups of users, by hash of the user id.

Each call of the engine for a key costs the Python worker several exchanges with the
state store, which is far more than folding a user's events.  The calls of a micro-batch
are bounded by the groups, however many users there are.  The number of groups belongs
to the state: a checkpoint can only be continued with the same one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

USER_GROUPS = 256
GROUP = "_user_group"


def user_group(n: int) -> Column:
    """Number (0 to n - 1) of the user's group."""
    return F.pmod(F.hash("user_id"), F.lit(n)).alias(GROUP)
