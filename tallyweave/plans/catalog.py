"""Named queries and their oracle SQL, gathered from the query modules."""

from __future__ import annotations

from tallyweave.plans import checks, feeds, flows, measures, stars

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (checks, stars, feeds, measures, flows):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
