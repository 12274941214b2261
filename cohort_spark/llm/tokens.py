"""Byte-level BPE encoding inside tasks with the ``tokenizers`` library.

The tokenizer's own pre-tokenisation never joins two chunks of ``CHUNK``, so a
text's ids are its chunks' ids in turn; a bounded table of the chunks that this
Python worker has met twice saves encoding a frequent word again.
"""
from __future__ import annotations

import re
import struct

from .common import worker_table, working_for

#: Unicode White_Space, as the tokenizer's own pattern reads ``\s`` (fixed values).
_WS = "\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: A Latin word before white space, full stop or comma; a run of other
#: characters; or white space (all but the last of a run stand together).
CHUNK = re.compile(
    f" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[{_WS}.,])| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
MAX_CACHED, MAX_CHUNK, SIGHT_BITS = 700_000, 64, 25


class Encoder(dict):
    """chunk -> its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.most = MAX_CACHED
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.met = bytearray(1 << SIGHT_BITS - 3)  # a bit by hash: most chunks come once and need no entry

    def raw(self, text: str) -> bytes:
        ids = self.tok.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.raw(chunk)
        if len(chunk) <= MAX_CHUNK and len(self) < self.most:
            at = hash(chunk) & (1 << SIGHT_BITS) - 1
            if self.met[at >> 3] >> (at & 7) & 1:
                self[chunk] = ids
            else:
                self.met[at >> 3] |= 1 << (at & 7)
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, CHUNK.findall(text))) if text else b""


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, most: int = MAX_CACHED) -> Encoder:
    """One encoder per worker process and vocabulary file, of ``most`` table entries; for a task
    that encodes."""
    working_for("chunks")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].most = most
    return _ENCODERS[path]


def release() -> bool:
    """Empty the chunk tables of this worker process; whether they held anything."""
    filled = [known for known in _ENCODERS.values() if known]
    for known in filled:
        known.clear()
        known.met = bytearray(len(known.met))
    return bool(filled)


worker_table("chunks", release)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def vocabulary_size(path: str) -> int:
    return encoder(path).tok.get_vocab_size()
