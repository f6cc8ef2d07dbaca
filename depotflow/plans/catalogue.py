"""Loads every module that registers queries."""

from depotflow.plans import exercises, jobs, joins, scans, selections, sql_objects, summaries
from depotflow.plans.registry import QUERIES

MODULES = (scans, selections, summaries, joins, exercises, jobs, sql_objects)
NAMES = tuple(sorted(QUERIES))
