"""Queries over the given tables, each plan module with QUERIES and SQL."""

from rollcall.plans import careers, entities, gates, incremental, intervals, ranking, relations, scalars, streams

PLANS = [intervals, scalars, incremental, ranking, relations, entities, careers, gates, streams]
