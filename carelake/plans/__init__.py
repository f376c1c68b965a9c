"""Bindings of the operators to the star-schema tables."""

from . import basics, documents, files, hl7_messages, people, readers, round_trips, visits  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
