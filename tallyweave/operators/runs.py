"""Reconciling in bites, for runs that must stop early and go on later.

One job over everything (`reconcile.drilldown`) is what a cluster should do. Against a live database with a time limit a
run goes from range to range instead: bites grow while there are no errors and shrink to what a second allows, and the run
stops by a streak of correct rows, a number of bites or time. Its state is plain data; with it the next run goes on.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.operators import reconcile as R
from tallyweave.sources import storage

#: Factor by which bites grow, and milliseconds that a bite should take.
GROWTH, TARGET_MS = 5, 1000
STATUSES = ("correct", "incorrect", "missing", "extra")


def fresh(limit: int = 9000) -> dict:
    return {"status": "initializing", "next": None, "limit": limit, "pause": 0, "bites": 0, "totals": dict.fromkeys((*STATUSES, "streak", "progress"), 0), "sample": {s: [] for s in STATUSES[1:]}}


def run(master: DataFrame, slave: DataFrame, key: str, fields: list[str], state: dict | None = None, limit: int = 9000, most: int = 1_000_000, stop_streak: int | None = None, stop_bites: int | None = None, stop_seconds: float | None = None, allowance: int = 1, keep: int = 4, save: Callable[[dict], None] | None = None) -> dict:
    """The state after as many bites as the stops allow; status is `complete` once the last id has been compared."""
    state = json.loads(json.dumps(state)) if state and state["status"] != "complete" else fresh(limit)
    began, bites = time.monotonic(), 0
    ends = R.id_range(master, key).first()
    state["status"] = "running"
    start, at_start = state["next"], state["next"] is None
    try:
        while True:
            # the first bite takes what the slave has below the master's least id, the last what it has above
            low = ends["min"] if at_start else start
            page = [r[0] for r in R.nibble(master, [key], state["limit"], None if low is None else (low,)).collect()]
            end, after = (page[0], page[1]) if len(page) == 2 else (None, None)
            within = F.lit(True) if at_start else F.col(key) >= F.lit(start)
            within = within if end is None else within & (F.col(key) < F.lit(after))
            within = within | F.col(key).isNull() if at_start else within
            clock = time.monotonic()
            found = _bite(master.where(within), slave.where(within), key, fields, keep)
            _add(state, found, clock, most, allowance, keep)
            bites += 1
            state["next"], start, at_start = after, after, False
            if after is None:
                state["status"] = "complete"
                break
            if save:
                save(state)
            if (stop_streak is not None and state["totals"]["streak"] >= stop_streak) or (stop_bites is not None and bites >= stop_bites) or (stop_seconds is not None and time.monotonic() - began >= stop_seconds):
                break
    except Exception:
        state["status"] = "error"
        if save:
            save(state)
        raise
    if save:
        save(state)
    return state


def _bite(master: DataFrame, slave: DataFrame, key: str, fields: list[str], keep: int) -> dict:
    """Totals of a range and some ids of each status; rows are only compared one by one where the sums differ."""
    m, s = (R.batch(x, key, fields).first() for x in (master, slave))
    if m == s:
        return {"correct": m["qty"], "sample": {}}
    statuses = R.diff(master, slave, key, fields)
    totals = R.totals(statuses).first().asDict()
    return totals | {"sample": {name: [r["id"] for r in statuses.where(F.col("status") == name).orderBy("id").limit(keep).collect()] for name in STATUSES[1:] if totals[name]}}


def _add(state: dict, found: dict, clock: float, most: int, allowance: int, keep: int) -> None:
    wrong = sum(found.get(s, 0) for s in STATUSES[1:])
    totals = state["totals"]
    for s in STATUSES:
        totals[s] += found.get(s, 0)
    totals["streak"] = 0 if wrong else totals["streak"] + found["correct"]
    totals["progress"] += found["correct"] + wrong
    state["bites"] += 1
    for name, ids in found["sample"].items():
        state["sample"][name] = (state["sample"][name] + ids)[:keep]
    if wrong:
        state["pause"] = allowance
    elif state["pause"]:
        state["pause"] -= 1
    else:
        took = max(1.0, 1000 * (time.monotonic() - clock))
        state["limit"] = max(1, min(GROWTH * state["limit"], most, round(TARGET_MS / took * state["limit"])))


def stored(spark: SparkSession, root: str) -> dict | None:
    """The last state saved under `root`, None if there is none or it is complete."""
    found = storage.versions(spark, root)
    state = json.loads(spark.read.text(f"{root}/version-{found[-1]}").first()["value"]) if found else None
    return state if state and state["status"] != "complete" else None


def saver(spark: SparkSession, root: str) -> Callable[[dict], None]:
    """Saves states under `root`, each a complete version."""

    def save(state: dict) -> None:
        found = storage.versions(spark, root)
        storage.write_version(spark.createDataFrame([(json.dumps(state, default=str),)], "value string").coalesce(1), root, found[-1] + 1 if found else 0, "text", keep=2)

    return save


def materialised(df: DataFrame, name: str) -> DataFrame:
    """A query's rows written once and named, for checksums that go over them many times; gives the table as `name`."""
    from tallyweave.session import cut

    out = cut(df)
    out.createOrReplaceTempView(name)
    return out
