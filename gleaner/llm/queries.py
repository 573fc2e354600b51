"""Every query of the corpus operators."""

from . import (  # noqa: F401
    queries_benchmark,
    queries_chats,
    queries_copies,
    queries_divergence,
    queries_lines,
    queries_mixing,
    queries_packing,
    queries_quality,
    queries_runs,
    queries_scores,
    queries_simhash,
    queries_tokens,
    queries_urls,
)
from .registry import QUERIES, SQL  # noqa: F401
