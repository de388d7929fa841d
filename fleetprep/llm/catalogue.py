"""The queries of this folder: run, and SQL where SQL can say the same."""

from __future__ import annotations

import importlib

from fleetprep.llm.tables import RUN, SQL

MODULES = ["quality_rules", "mixing", "licenses", "line_dedup", "passage_dedup", "sharding", "quality_classifier", "decontamination", "lm_scoring", "token_files", "ngram_join", "whitening", "piece_encoding", "period_runs"]


def registered():
    for module in MODULES:
        importlib.import_module(f"fleetprep.llm.{module}")
    return RUN, SQL
