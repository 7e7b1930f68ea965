"""Token ids of whole texts, by the tokenizers library with a cache of words.

The tokenizer drops white space and never joins text across it, so a text's ids are its words' ids in order. Each
worker keeps the ids of words it has met, as little-endian 32-bit bytes; only new words go to the library. To have fewer
of them, texts are brought to lower case first and punctuation at a word's end becomes a word, where the tokenizer's own
split does the same. A new word of Latin letters or of punctuation is one piece of that split and goes to its model
directly; any other word takes the library's full path.
"""

from __future__ import annotations

import codecs
import os
import re
import struct

from .common import tokenizer_file

#: Words kept per worker; beyond it and after each task only the first KEPT_WORDS stay, results do not depend on it.
CACHE_WORDS = 500_000
KEPT_WORDS = 300_000
#: Longer words go to the library each time.
CACHE_WORD_BYTES = 64

#: Punctuation of ASCII other than the apostrophe; letters of ASCII and U+00C0 to U+00FF (possessive: linear).
MARK = rb"[!-&(-/:-@\[-`{-~]"
WIDE_LETTER = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
PIECE = re.compile(rb"(?:[A-Za-z]++|" + WIDE_LETTER + rb")++|" + MARK + rb"++")
#: Punctuation from a letter to the end of the word.
TAIL = re.compile(MARK + rb"(?:(?<=[A-Za-z].)|(?<=" + WIDE_LETTER + rb".))" + MARK + rb"*+(?=[ \t-\r]|\Z)", re.DOTALL)
#: Bytes of characters under U+0300: no text of them alone holds marks that combine with a letter of one case only.
NO_COMBINING = bytes(range(0xCC))


def byte_characters() -> dict[int, str]:
    """The character that byte-level BPE shows for each byte: printable Latin-1 as is, the rest from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b <= 0xFF and b != 0xAD)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Words(dict):
    """Ids by word: those of a word that is not there are made, and kept if it is short."""

    def __init__(self, encoder: WordEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        ids = self.encoder.new(word)
        if len(word) <= CACHE_WORD_BYTES:
            if len(self) >= CACHE_WORDS:
                self.shrink()
            self[word] = ids
        return ids

    def shrink(self) -> None:
        """Leave the words met first: the frequent ones are among them."""
        for _ in range(len(self) - KEPT_WORDS):
            self.popitem()


class WordEncoder:
    def __init__(self, tokenizer: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(tokenizer))
        self.model = self.tokenizer.model
        self.words = Words(self)
        shown = byte_characters()
        self.characters = "".join([shown[b] for b in range(256)])
        #: Tokens that the library finds before it splits, in lower case.
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Whether the split above is this tokenizer's own; else every new word takes the full path.
        self.plain = True
        tried = [w.encode() for w in ("Word", "éÀüß", "word,", "Été.%%", "a", "X-", "naïve...", "won)*", "É", "...")]
        self.plain = all(self.encode(w) == self._full(w) for w in tried)
        self.words.clear()

    def forget(self) -> None:
        """Free most of the cache, at the end of a task: workers stay, and other tasks need their memory."""
        self.words.shrink()

    def _full(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode_batch_fast([word.decode("utf-8", "replace")], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def new(self, word: bytes) -> bytes:
        """The ids of one word, by the library."""
        if not self.plain or not PIECE.fullmatch(word):
            return self._full(word)
        if word.isascii():
            shown = word.decode().lower()
        else:
            lower = word.decode().lower().encode()
            if lower != word:
                return self.words[lower]
            shown = codecs.charmap_decode(word, "strict", self.characters)[0]
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        if self.plain:
            lower = text.lower()
            if not any(t in lower for t in self.added):
                text = TAIL.sub(rb" \g<0>", text if text.translate(None, NO_COMBINING) else lower)
        return b"".join(map(self.words.__getitem__, text.split()))
