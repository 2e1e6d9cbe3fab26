from .text import (
    empty_to_unk,
    ngrams,
    pad_sentence,
    perplexity,
    skip_symbols,
    tokenize,
)

__all__ = ["empty_to_unk", "ngrams", "pad_sentence", "perplexity", "skip_symbols", "tokenize"]
