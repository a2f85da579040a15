"""Cross-tokenizer alignment of the documents."""

from __future__ import annotations

import public_tokenizers

from savora.llm import token_alignment
from savora.llm.common import table
from savora.llm.queries import query


@query("op13_alignment")
def _(spark, folder):
    aligned = token_alignment.chunks(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return token_alignment.documents(aligned, token_alignment.link_counts(aligned))
