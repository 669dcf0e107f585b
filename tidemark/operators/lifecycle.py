"""Life cycle of versions behind a pointer: every step is accepted or rejected, with its reason, and one version is active.

Steps of a pointer, in order: ``insert`` a version (``to``: its status),
``member`` (something is added to it), ``move`` it (``from`` -> ``to``),
``activate`` it (``from``: the version that the writer believes active).
A step that is rejected changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.folds import fold_in_order

# Where a version starts, the moves that need no activation, and what can be activated.
FIRST = "draft"
MOVES = {("draft", "shadow"), ("shadow", "draft"), ("draft", "retired"), ("shadow", "retired")}
ACTIVATABLE = {"shadow", "retired"}


@dataclass
class Pointer:
    current: str | None = None
    status: dict = field(default_factory=dict)

    def judge(self, op: str, version: str | None, before: str | None, after: str | None) -> str | None:
        """Why the step is rejected; None: it is accepted, and done."""
        have = self.status.get(version)
        if op == "insert":
            if after != FIRST:
                return "insert_must_be_draft"
            if have is not None:
                return "exists"
            self.status[version] = after
        elif op == "member":
            if have is None:
                return "unknown_version"
            if have != FIRST:
                return "members_need_draft"
        elif op == "move":
            if (before, after) not in MOVES:
                return "move_not_allowed"
            if have != before:
                return "move_denied"
            self.status[version] = after
        elif op == "activate":
            if self.current != before:
                return "pointer_conflict"
            if self.current == version:
                return None
            if have not in ACTIVATABLE:
                return "not_activatable"
            if self.current is not None:
                self.status[self.current] = "retired"
            self.status[version], self.current = "active", version
        else:
            return "unknown_step"
        return None


def replay(log: DataFrame, pointer: str, order: list[str]) -> DataFrame:
    """``pointer, seq, op, version, accepted, reason, status`` (of the version) and ``active`` after each step; ``log``: also ``before, after``."""

    def step(state: Pointer, row: dict):
        reason = state.judge(row["op"], row["version"], row["before"], row["after"])
        yield row["seq"], row["op"], row["version"], reason is None, reason, state.status.get(row["version"]), state.current

    kind = log.schema[pointer].dataType.simpleString()
    return fold_in_order(log, pointer, order, Pointer, step, None, f"{pointer} {kind}, seq long, op string, version string, accepted boolean, reason string, status string, active string")


def active_versions(steps: DataFrame, pointer: str) -> DataFrame:
    """The one active version of each pointer after its last step (null if there is none), and how many steps were accepted."""
    return steps.groupBy(pointer).agg(F.max_by("active", "seq").alias("active"), F.count_if("accepted").alias("n_accepted"), F.count_if(~F.col("accepted")).alias("n_rejected"))


def rejections(steps: DataFrame) -> DataFrame:
    return steps.where(~F.col("accepted")).groupBy("op", "reason").agg(F.count(F.lit(1)).alias("n"))
