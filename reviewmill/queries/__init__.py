"""Registered queries: one or more per operator, each with the SQL its result must equal."""

from . import classify, ingest, measures, relational, sampling, sentiment, tables, upserts
from .registry import ORACLES, QUERIES
