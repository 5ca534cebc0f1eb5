"""The token alignment query over the whole ``documents`` table."""

from __future__ import annotations

import public_tokenizers

from . import alignment
from .common import table
from .registry import query


@query("op13_token_alignment")
def op13_token_alignment(spark, sf_dir):
    """Groups and links between byte-level and sentencepiece tokens of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = alignment.align_tokens(
        docs, "text", a_path=public_tokenizers.path("byte_bpe_50k.json"),
        b_path=public_tokenizers.path("piece_bpe_32k.model"),
    )
    return done.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
