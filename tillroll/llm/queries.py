"""Every registered corpus query: ``name -> (run, equivalent SQL or None)``."""

from __future__ import annotations

from importlib import import_module

import corpus_pipeline

AREAS = ("token_counts", "packing", "simhash", "subspace_join", "decontamination", "quality", "language", "html_template", "pii", "lm_scoring", "shard_tree", "vector_codes", "whitening")

QUERIES: dict = {}
for area in AREAS:
    QUERIES.update(import_module(f"tillroll.llm.{area}").QUERIES)
QUERIES["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
