"""Public tokenizer files, and encoders kept by a Python worker between its tasks."""

from __future__ import annotations

import base64
import functools
import os

import public_tokenizers


def vocabulary_path(name: str) -> str:
    """A public vocabulary by its file name; a path with a folder is taken as it is."""
    return name if os.path.dirname(name) else public_tokenizers.path(name)


@functools.cache
def json_tokenizer(name: str):
    """A ``tokenizers`` encoder with the library's defaults, one thread per task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.cache
def rank_tokenizer(name: str, pattern: str = public_tokenizers.PATTERN):
    """A ``tiktoken`` encoder over a local rank file, without special tokens."""
    import tiktoken

    with open(vocabulary_path(name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(os.path.basename(name), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
