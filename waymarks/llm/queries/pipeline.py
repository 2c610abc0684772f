"""The whole pipeline over all documents."""

import corpus_pipeline
from waymarks.llm.registry import query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
