"""Token ids by public vocabularies, loaded once per worker."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken

#: Ranks of the byte-level vocabulary; the same ids as its tokenizers file.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: A vocabulary of pieces that falls back to bytes for characters it lacks.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: The token that the tokenizers file adds, and finds in texts too, to those of the ranks.
ADDED = {"<|endoftext|>": 50256}


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED)


def token_ids(path: str, text: str, added: bool = False) -> np.ndarray:
    """Ids of a whole text as unsigned 32-bit numbers.

    Strings of ADDED are one token each with ``added``, else ordinary text.
    """
    return byte_encoder(path).encode_to_numpy(text, allowed_special=set(ADDED) if added else set(), disallowed_special=())


@lru_cache(maxsize=4)
def own_characters(path: str) -> np.ndarray:
    """For each code point, whether the vocabulary has a piece for it."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = np.zeros(0x110000, bool)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if len(piece) == 1:
            known[ord(piece)] = True
    return known
