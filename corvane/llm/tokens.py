"""Token ids and token bytes of public tokenizers, whose files are a parameter."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

# The characters that the pre-token pattern takes as white space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Runs of white space from this length on are cut off by hand: the pattern's look-ahead takes stack for each character.
LONG_RUN = 1_000
_LONG_WHITE = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _written_bytes() -> dict[str, int]:
    """The character by which vocabulary files write each byte: printable ones as they are,
    the others in order by those from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """A byte-level tokenizer file: its encoder, the bytes of its ids, and its special tokens."""

    encoder: object
    token_bytes: list[bytes]
    special: dict[str, int]

    def special_parts(self, text: str) -> list[str]:
        """The text cut at special tokens, which are the odd entries."""
        if not self.special:
            return [text]
        either = "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True))
        return re.split(f"({either})", text)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The tokenizer of a file, kept by the worker. Ids are those of the file."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {x["content"]: x["id"] for x in model.get("added_tokens", ())}
    byte_of = _written_bytes()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    token_bytes = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        token_bytes[i] = token
    encoder = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Vocabulary(encoder, token_bytes, special)


def _encode_plain(encoder, text: str) -> list[np.ndarray]:
    """Ids of a text without special tokens, part by part.

    A long run of white space is one pre-token by itself, but for its last character where other
    text follows: that one goes with what follows. So cutting there changes no id.
    """
    found, begin = [], 0
    for run in _LONG_WHITE.finditer(text) if len(text) >= LONG_RUN else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        found.append(encoder.encode_to_numpy(text[begin : run.start()], disallowed_special=()))
        found.append(np.asarray(encoder._encode_single_piece(text[run.start() : end]), np.uint32))
        begin = end
    return [*found, encoder.encode_to_numpy(text[begin:], disallowed_special=())]


def encode(path: str, text: str | None, special: bool = False) -> np.ndarray:
    """The text's ids as 32-bit numbers. The strings of special tokens are these tokens if ``special``, else ordinary text."""
    if not text:
        return np.zeros(0, np.uint32)
    known = vocabulary(path)
    found = []
    for k, part in enumerate(known.special_parts(text) if special else [text]):
        found += [np.array([known.special[part]])] if k % 2 else _encode_plain(known.encoder, part)
    return np.concatenate(found).astype(np.uint32)


@lru_cache(maxsize=2)
def pieces(path: str):
    """A sentence-piece model and the bytes that each of its ids stands for, kept by the worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token_bytes = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            token_bytes.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            token_bytes.append(b"")
        else:
            token_bytes.append(piece.replace("\u2581", " ").encode())
    return model, token_bytes
