"""Life of queued work: claim, heartbeat, dispatch, fail and finish, with fencing tokens and visibility timeouts.

A claim gives the entry a new fencing token and hides it for a while; the
holder's other calls must bring that token, so a worker that lost its claim
can change nothing.  When the while is over, the entry is free again
(``reclaim``, at the very time it ran out).  Times are whole seconds.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame

from tidemark.operators.folds import fold_in_order

HELD = ("claimed", "dispatched")
#: Bounds of the visibility and of the retry delay, in seconds.
VISIBLE, RETRY = (60, 7200), (60, 86400)
ROWS = "seq long, at long, op string, accepted boolean, reason string, status string, token long, attempts int"


@dataclass
class Entry:
    """State of one queue entry; a new one is pending."""

    status: str = "pending"
    token: int = 0
    attempts: int = 0
    visible: int | None = None
    retry: int | None = None

    def row(self, seq: int | None, at: int, op: str, reason: str | None = None) -> tuple:
        return seq, at, op, reason is None, reason, self.status, self.token, self.attempts

    def run_out(self, now: int) -> list[tuple]:
        """The reclaim row, if the claim ran out by ``now``."""
        if self.status not in HELD or self.visible is None or self.visible > now:
            return []
        at, self.status, self.visible = self.visible, "pending", None
        return [self.row(None, at, "reclaim")]

    def call(self, op: str, now: int, token: int | None, seconds: int, budget: int) -> str | None:
        """Why the call is refused; None: it is done. ``seconds``: visibility of a claim or heartbeat, retry delay of a failure."""
        if op == "claim":
            due = self.status == "failed" and self.attempts < budget and self.retry is not None and self.retry <= now
            if self.status != "pending" and not due:
                return "not_eligible"
            self.status, self.attempts, self.token, self.retry = "claimed", self.attempts + 1, self.token + 1, None
            self.visible = now + min(max(seconds, VISIBLE[0]), VISIBLE[1])
            return None
        if op not in ("heartbeat", "dispatch", "fail", "finish"):
            return "unknown_call"
        if token != self.token:
            return "fencing_mismatch"
        if op == "fail":
            self.status, self.visible, self.retry = "failed", None, now + min(max(seconds, RETRY[0]), RETRY[1])
            return None
        if self.status not in HELD:
            return "bad_status"
        if op == "heartbeat":
            self.visible = now + min(max(seconds, VISIBLE[0]), VISIBLE[1])
        elif op == "dispatch":
            self.status = "dispatched"
        else:
            self.status, self.visible = "done", None
        return None

    def take(self, call: dict, budget: int) -> list[tuple]:
        """Rows of one call: a reclaim that is due, then the call itself."""
        out = self.run_out(int(call["at"]))
        reason = self.call(call["op"], int(call["at"]), None if call["token"] is None else int(call["token"]), int(call["seconds"]), budget)
        return [*out, self.row(int(call["seq"]), int(call["at"]), call["op"], reason)]

    def values(self) -> tuple:
        return astuple(self)


def replay(calls: DataFrame, key: str, until: int, budget: int = 3) -> DataFrame:
    """What became of every call, in order of ``at, seq``, and every reclaim up to ``until``; ``calls``: key, seq, at, op, token, seconds."""
    kind = calls.schema[key].dataType.simpleString()
    return fold_in_order(calls, key, ["at", "seq"], Entry, lambda e, c: e.take(c, budget), lambda e: e.run_out(until), f"{key} {kind}, {ROWS}")
