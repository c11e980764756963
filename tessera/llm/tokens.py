"""Token ids of whole texts with the tokenizers library.

Real text repeats its words, so a worker merges each distinct pre-token once and
joins the ids. Pre-tokens are those of the tokenizer's own splitting, which its
merges never cross, so the ids equal those of the whole text; a text with
characters outside printable ASCII and Latin-1 is encoded whole.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np

CACHE_BYTES = 48 << 20  # of pre-tokens and their ids that a worker remembers; beyond it starts anew
ENTRY_BYTES = 150  # of one of them, besides its ids
_PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ÿ]*\Z")
# How the two tokenizers split a text before their merges, for the letters and numbers of Latin-1.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
_PRE_TOKEN = {
    "word": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+"),
    "byte": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"),
}
_PROBE = "It's l'été, don't 'tis 12 3.4 (x)  y\n\n z--w !! Ça ªb µm ½ "


def _byte_letters() -> str:
    """The letter that stands for each byte: itself if it prints in Latin-1, else the next one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, n = [], 256
    for b in range(256):
        out.append(chr(b if b in printed else n))
        n += b not in printed
    return "".join(out)


_LETTERS = dict(enumerate(_byte_letters()))


class _Known(dict):
    """Ids of the pre-tokens met so far, as bytes; an unknown one goes to the merge model."""

    def __init__(self, model, code: str):
        super().__init__()
        self.tokenize, self.code, self.room = model.tokenize, code, CACHE_BYTES

    def __missing__(self, t: str) -> bytes:
        if self.room < 0:
            self.clear()
            self.room = CACHE_BYTES
        letters = t if t.isascii() and t.isalnum() else t.encode().decode("latin-1").translate(_LETTERS)
        ids = [x.id for x in self.tokenize(letters)]
        self[t] = out = struct.pack(f"<{len(ids)}{self.code}", *ids)
        self.room -= ENTRY_BYTES + len(out)
        return out


class Encoder:
    """Ids as little-endian arrays; ``kind`` is 'word' (lower case, white space dropped) or 'byte' (text kept as it is).

    A text is split into its pre-tokens here, and each distinct one goes to the
    library's merge model once. That this gives what the whole tokenizer gives
    is tried on a probe when the encoder is made; if not, texts are encoded whole.
    """

    def __init__(self, path: str, kind: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split, self.lower = _PRE_TOKEN[kind].findall, kind == "word"
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = _Known(self.model, "H" if self.dtype.itemsize == 2 else "I")
        self.by_model = self._joined([_PROBE])[0] == self._whole(_PROBE)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _joined(self, texts: list[str]) -> list[bytes]:
        get = self.known.__getitem__
        return [b"".join(map(get, self.split(t.lower() if self.lower else t))) for t in texts]

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """Ids of each text with ``end`` appended, as bytes of ``dtype``."""
        last = np.array([end], self.dtype).tobytes()
        plain = [self.by_model and bool(_PLAIN.match(t)) and not any(s in t for s in self.special) for t in texts]
        joined = iter(self._joined([t for t, p in zip(texts, plain) if p]))
        return [(next(joined) if p else self._whole(t)) + last for t, p in zip(texts, plain)]


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary file, made once."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
