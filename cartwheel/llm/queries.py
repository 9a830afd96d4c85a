"""The queries of this package: name → (query, SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from cartwheel.llm.shipping import ship

MODULES = ("suffix_dedup", "packing", "mixing", "token_rollup", "katz", "simhash", "quality_rules", "toxicity", "phrase_dedup", "vptree",
           "minhash", "alignment", "prefix_trie")


def shipped(run: Callable) -> Callable:
    """``run`` after the package was sent to the workers."""
    def query(spark, sf_dir):
        ship(spark)
        return run(spark, sf_dir)

    return query


def registered() -> dict:
    """{name: (query, SQL or None)} of every operator module."""
    found = {}
    for name in MODULES:
        found |= {n: (shipped(run), sql) for n, (run, sql) in importlib.import_module(f"cartwheel.llm.{name}").QUERIES.items()}
    return found
