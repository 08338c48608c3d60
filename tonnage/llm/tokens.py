"""Exact, fast use of a ``tokenizers`` file whose pre-tokens never cross white space.

``word_bpe_49k.json`` normalises (NFC, white space to one blank, lower case) and then drops white
space; no pre-token spans it.  The ids of a text are therefore those of its blank-separated chunks,
one after another, and a chunk met before need not be encoded again.  ASCII letters are lower-cased
first, so that chunks differing in case only are one; texts that hold ``<|`` might hold a special
token and go through the library whole.

ASCII and plain Latin letters are further cut where the file's own pattern cuts them.  Such pieces
are one pre-token each, so many fresh ones are encoded as one blank-separated text and taken apart
after each id whose token ends a word.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tonnage.llm.common import ASCII_LOWER

#: Latin letters that stay one letter under NFC and lower-casing.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_PLAIN = re.compile(f"[\t\n\r\x20-\x7e{_LATIN}]+").fullmatch
#: The tokenizer file's split pattern, for plain chunks.
_PIECES = re.compile(f"[{_LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\\s{_LATIN}0-9]+").findall


class ChunkEncoder:
    """Encodes UTF-8 texts to little-endian unsigned ids (``kind``: of 16 bits where they fit), with a bounded cache."""

    def __init__(self, path: str, cache_pieces: int = 1_000_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.width = int(self.kind[-1])
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces

    def whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.asarray(ids, self.kind).tobytes()

    def _each(self, fresh: list[str]) -> list[bytes]:
        """The ids of each of ``fresh`` (one pre-token each, as a rule)."""
        out: list[bytes] = []
        groups = [fresh[i : i + 512] for i in range(0, len(fresh), 512)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.asarray(found.ids, self.kind)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(group) and ends[-1] == len(ids):
                raw, cuts = ids.tobytes(), (ends * self.width).tolist()
                out += [raw[a:b] for a, b in zip([0, *cuts], cuts)]
            else:
                out += [self.whole(x.encode()) for x in group]
        return out

    def _chunked(self, text: str) -> list[str]:
        """The blank-separated chunks of a text that is not plain; plain chunks in their pieces."""
        out: list[str] = []
        for chunk in text.split(" "):
            if _PLAIN(chunk):
                out += _PIECES(chunk)
            elif chunk:
                out.append(chunk)
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split: list[list[str] | None] = []
        for raw in texts:
            text = raw.translate(ASCII_LOWER).decode("utf-8", "replace")
            split.append(None if "<|" in text else _PIECES(text) if _PLAIN(text) else self._chunked(text))
        if len(self.cache) > self.cache_pieces:
            self.cache.clear()
        get = self.cache.get
        parts = [None if x is None else list(map(get, x)) for x in split]
        gaps = [[k for k, v in enumerate(x) if v is None] if x else () for x in parts]
        wanted = {pieces[k] for pieces, at in zip(split, gaps) for k in at}
        plain = [x for x in wanted if _PLAIN(x)]
        self.cache.update(zip(plain, self._each(plain)))
        self.cache.update((x, self.whole(x.encode())) for x in wanted.difference(plain))
        for pieces, found, at in zip(split, parts, gaps):
            for k in at:
                found[k] = self.cache[pieces[k]]
        return [self.whole(t) if x is None else b"".join(x) for t, x in zip(texts, parts)]
