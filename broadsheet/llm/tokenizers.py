"""Public tokenizers, loaded once per Python worker from a folder that is a parameter."""

from __future__ import annotations

import base64
import os
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The folder with the vocabulary files. It must exist at the same place on every executor.
FOLDER = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"

# Fixed value: how the byte-level vocabulary cuts a text before merging.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_bpe(folder: str, name: str):
    """A byte-level tokenizer; marks of special tokens in a text are ordinary text."""
    import tiktoken

    with open(os.path.join(folder, name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(name, pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(folder: str, name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, name))
