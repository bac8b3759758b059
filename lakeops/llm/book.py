"""All corpus queries; importing this module registers them."""

import corpus_pipeline
from lakeops.llm import (  # noqa: F401
    blockknn,
    collocations,
    langid,
    licenses,
    mixing,
    packing,
    pieces,
    resampling,
    secrets,
    simhash,
    toxicity,
    urls,
    voronoi,
)
from lakeops.llm.registry import ORACLES, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["ORACLES", "QUERIES"]
