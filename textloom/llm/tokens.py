"""Token ids of whole texts by a stored tokenizer, with each distinct word encoded once per worker."""

from __future__ import annotations

import json

import numpy as np
import regex

# The normaliser of word-wise tokenizers, for which white space separates words without a trace.
WORD_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
# Characters that normalisation leaves alone but for lower case, and that all Unicode versions class alike.
PLAIN = regex.compile("[!-~¡-ÿ]+")
# Distinct words and their pieces kept per worker; beyond it the memory starts anew. It bounds memory only. Words
# come with all their punctuation and cases, so there are more of them, but pieces cost more to encode.
MOST_WORDS, MOST_PIECES = 400_000, 1_200_000


def path_of(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TextEncoder:
    """Gives the ids that the tokenizers library gives, as little-endian unsigned 32-bit bytes.

    Where the tokenizer drops white space and treats words alone, texts are cut at ASCII white
    space and each distinct word is encoded once; other tokenizers get whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.by_word = (
            (parts["normalizer"] or {}).get("normalizers") == WORD_NORMALIZER
            and parts["post_processor"] is None
            and [s.get("type") for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["invert"]
            and splits[0]["behavior"] == "Removed"
            and not splits[1]["add_prefix_space"]
            and not splits[1]["use_regex"]
        )
        self.specials = [t["content"] for t in parts["added_tokens"]]
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        if self.by_word:
            self.split = regex.compile(splits[0]["pattern"]["Regex"]).findall
            self.model = self.tokenizer.model
            # The printable stand-ins of byte-level vocabularies: printable Latin-1 stays, other bytes follow from 256 on.
            printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
            others = iter(range(256, 512))
            self.stand_ins = {b: b if b in printable else next(others) for b in range(256)}

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if not PLAIN.fullmatch(text) or any(s in text for s in self.specials):
            return self._library(text)
        ids = b""
        for piece in self.split(text.lower()):
            found = self.pieces.get(piece)
            if found is None:
                if len(self.pieces) >= MOST_PIECES:
                    self.pieces.clear()
                tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.stand_ins))
                found = self.pieces[piece] = np.array([t.id for t in tokens], "<u4").tobytes()
            ids += found
        return ids

    def encode(self, text: bytes | None) -> bytes:
        """The ids of a whole UTF-8 text; NULL counts as empty."""
        if not text:
            return b""
        if not self.by_word:
            return self._library(text.decode())
        words, cache = text.split(), self.words
        for word in set(words).difference(cache):
            if len(word) > 256:  # rarely met twice
                continue
            if len(cache) >= MOST_WORDS:
                cache.clear()
            cache[word] = self._word(word)
        try:
            return b"".join(map(cache.__getitem__, words))
        except KeyError:
            return b"".join([cache[w] if w in cache else self._word(w) for w in words])


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for ``path``, loaded once per process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
