"""Spark-native preparation of medical-imaging metadata, HL7 messages and workflow events.

Every operator is a function ``DataFrame -> DataFrame`` (use ``df.transform``) or
``Column -> Column``; they work on batch and streaming DataFrames alike unless said otherwise.
"""

from scanloom.session import build_session

__all__ = ["build_session"]
__version__ = "0.1.0"
