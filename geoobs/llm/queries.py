"""All registered queries of this package."""

from . import (  # noqa: F401
    alignment_queries, chat_queries, repeat_queries, secret_queries, text_queries, trie_queries,
    vector_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
