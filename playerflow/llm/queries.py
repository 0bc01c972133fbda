"""All queries of this package: importing the modules registers them."""

from importlib import import_module

from playerflow.llm.registry import ORACLES, QUERIES  # noqa: F401

MODULES = ("secrets", "lm_scores", "bpe_codec", "quality_rules", "quality_classifier", "pseudonyms", "jaccard_join", "url_filter", "decontaminate", "token_counts", "best_fit_packing", "merkle_manifest", "collocations")

for _name in MODULES:
    import_module(f"playerflow.llm.{_name}")
