"""The registered queries of this subpackage: name to (callable, SQL or None)."""

from __future__ import annotations


def catalog() -> dict[str, tuple]:
    from tallyloom.llm import (
        bpe,
        divergence,
        gam,
        jaccard,
        licenses,
        mixing,
        omh,
        packing,
        rules,
        runs,
        substring,
        tokens,
        warc,
    )

    modules = (bpe, tokens, substring, jaccard, rules, mixing, omh, licenses, warc, gam, divergence, packing, runs)
    return {name: query for module in modules for name, query in module.QUERIES.items()}
