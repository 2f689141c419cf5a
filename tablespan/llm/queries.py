"""All queries of this package."""

from tablespan.llm import (  # noqa: F401
    conversations,
    decontamination,
    extraction,
    jaccard,
    language,
    packing,
    personal,
    quality,
    rules,
    secrets,
    spelling,
    substrings,
    warc,
)
from tablespan.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
