"""All queries of the corpus operators: importing this module registers them."""

from urbanlake.llm import (  # noqa: F401
    divergence,
    fixity,
    html_text,
    infill,
    minhash,
    mixing,
    ngram_join,
    packing,
    rules,
    secrets,
    suffixes,
    syncmers,
    toxicity,
)
from urbanlake.llm.common import ORACLE, QUERIES  # noqa: F401
