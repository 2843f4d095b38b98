"""Token ids by a public tokenizer, inside tasks, at the speed of a dictionary.

The tokenizer's pre-tokenizer never joins across a space that follows a non-space: what follows
such a space is another word, and the space belongs to it. So a text falls apart there into words
that are encoded on their own, and a word's ids are remembered as bytes. Most words of a corpus
repeat; a text is then one dictionary look-up per word and one join of bytes. A new word of letters
alone is a single pre-token: it goes straight to the tokenizer's byte-pair model, in the byte-level
alphabet that the pre-tokenizer would write it in. Punctuation after letters is a pre-token too, and so is
a line feed between words; these are put together from their parts.
"""

from __future__ import annotations

import os
import re
from array import array

#: remembered words per worker process, about 200 bytes each; the older half is forgotten beyond it. MANY is
#: for tasks that do nothing but encode
REMEMBERED, MANY = 400_000, 1_200_000
BATCH = 5000

#: white space before a space: no safe cut there
UNSAFE = re.compile(r"\s ")
SAFE_CUT = re.compile(r"(?<=\S)(?= )")
#: letters, and punctuation of ASCII after them: a pre-token each. No apostrophe, which may start a contraction, and
#: no character that a special token starts with
PLAIN = re.compile(r"([^\W\d_]+)([!-&(-/:;=?@\[-`{}~]*)")
#: first words and words after a line feed that a worker process remembers
BARE = 100_000

#: words of letters up to here take the short way
LATIN = "\u024f"


def byte_alphabet() -> dict[int, int]:
    """The byte-level alphabet: visible Latin-1 characters stand for their bytes, the code points
    from 256 on for the other bytes, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in visible]
    return {b: 256 + k for k, b in enumerate(others)}


_encoders: dict[tuple[str, int], Encoder] = {}


class Encoder:
    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a worker per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # ids of " " + word, by word
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # ids without a space before them: of first words, and of what follows letters or a line feed
        self.bare: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.line_feed = self.encode(["\n"])[0]
        alphabet = byte_alphabet()
        letters = (chr(c) for c in (0x20, *range(0x41, ord(LATIN) + 1)))
        self.written = {c: c.encode().decode("latin-1").translate(alphabet) for c in letters}
        self.packed = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]
        self.model = self.tokenizer.model

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def letters(self, written: str) -> bytes:
        """Ids of letters, with or without a space before them."""
        return b"".join([self.packed[token.id] for token in self.model.tokenize("".join(map(self.written.__getitem__, written)))])

    def plain(self, word: str, spaced: bool) -> bytes | None:
        """Ids of letters with punctuation after them; None of any other word."""
        found = PLAIN.fullmatch(word)
        if not found:
            return None
        stem, tail = found.groups()
        if not stem.isascii() and (not stem.isalpha() or max(stem) > LATIN):
            return None
        if tail not in self.tails:
            if len(self.tails) >= BARE:
                self.tails = {"": b""}
            self.tails[tail] = self.encode([tail])[0]
        if not spaced:
            return self.letters(stem) + self.tails[tail]
        ids = self.recent.get(stem) or self.older.get(stem) or self.letters(f" {stem}")
        self.recent[stem] = ids
        return ids + self.tails[tail]

    def lines(self, word: str, spaced: bool) -> bytes | None:
        """The same of plain words with a single line feed between them, which is a pre-token of its own."""
        if "\n" not in word:
            return self.plain(word, spaced)
        first, *rest = word.split("\n")
        found = [self.plain(first, spaced), *(self.first(line) if PLAIN.fullmatch(line) else None for line in rest)]
        return None if None in found else self.line_feed.join(found)

    def first(self, word: str) -> bytes:
        """Ids of a word without a space before it."""
        ids = self.bare.get(word)
        if ids is None:
            ids = self.lines(word, False)
            if ids is None:
                ids = self.encode([word])[0]
            if len(word) <= 100:
                if len(self.bare) >= BARE:
                    self.bare = {}
                self.bare[word] = ids
        return ids

    def learn(self, words: set[str]) -> None:
        if len(self.recent) + len(words) > self.remembered // 2:
            self.older, self.recent = self.recent, {}
        missing = []
        for word in words:
            ids = self.older.get(word)
            if ids is None:
                if word.isalpha() and (word.isascii() or max(word) <= LATIN):
                    ids = self.letters(f" {word}")
                else:
                    ids = self.lines(word, True)
            if ids is None:
                missing.append(word)
            else:
                self.recent[word] = ids
        for at in range(0, len(missing), BATCH):
            part = missing[at : at + BATCH]
            self.recent.update(zip(part, self.encode([" " + word for word in part]), strict=True))

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; of a null text none."""
        if not text:
            return b""
        if UNSAFE.search(text):
            first, *words = SAFE_CUT.split(text)
            words = [word[1:] for word in words]
        else:
            first, *words = text.split(" ")
        found = list(map(self.recent.get, words))
        if None in found:
            gaps = [k for k, ids in enumerate(found) if ids is None]
            self.learn({words[k] for k in gaps})
            recent = self.recent.get
            for k in gaps:
                found[k] = recent(words[k])
        return (self.first(first) if first else b"") + b"".join(found)


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """The encoder of this worker process for a tokenizer file."""
    if (path, remembered) not in _encoders:
        _encoders[path, remembered] = Encoder(path, remembered)
    return _encoders[path, remembered]


def byte_bpe() -> str:
    """The tokenizer file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
