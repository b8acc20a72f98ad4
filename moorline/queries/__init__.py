"""Queries over the given tables, by area."""

from moorline.queries import control, landing, publishing, scans, stages
from moorline.queries.registry import ORACLES, QUERIES, Tables
