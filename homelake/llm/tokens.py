"""Token ids of whole texts, with the ids of words that were seen before looked up."""

from __future__ import annotations

import re
from functools import lru_cache

# Words made of these alone stay as they are under composition, and each letter has one lower
# case, so that lower-casing and the tokenizer's split are plain here. Others go through the
# tokenizer's own normaliser.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
#: Bytes of words and ids that a process remembers, about, and length of words that it does not. A worker keeps
#: them when its task is over, beside whatever the next stages do.
REMEMBERED, LONG = 32 << 20, 64
_ENTRY = 130  # bytes of an entry beside those of its word and ids
# Texts on which looking words up must give what the tokenizer gives.
_PROBES = (
    " \t\n", "The cat's 12,345 things -- they'll've don't! İstanbul", 'a-b_c/d.e (f) [g] "h" <i> ... ?!', "É à ç ß ñ ÿ × ÷ ° œ Ω 漢字 🙂 é",
    "UPPER lower MiXeD 2nd x2y 3.14e-5 C++ #tag @me 50% $9 'tis rock'n'roll", "it's we're I'm you'd <|endoftext|> <| x |>", "a\x00b \x7f     z",
)


def _byte_table() -> dict[int, str]:
    """The visible character that byte-level vocabularies use for each byte."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class _Words(dict):
    """Ids of words by their bytes, worked out when first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.tokenize = tokenizer.model.tokenize
        self.ids = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]
        self.table = _byte_table()
        self.before: dict[bytes, bytes] = {}
        self.bytes = 0

    def forget(self) -> None:
        """Start anew; words known so far stay for one more turn if they are asked for."""
        self.before = self.copy()
        self.clear()
        self.bytes = 0

    def __missing__(self, word: bytes) -> bytes:
        out = self.before.pop(word, None)
        if out is None:
            # A piece is a word of its own elsewhere, and is looked up as that.
            if word.isalpha():  # ASCII letters
                out = self._piece(word.decode().lower())
            elif word[:-1].isalpha() and 33 <= word[-1] <= 47 and word[-1] != 39:  # and a mark at the end
                out = self[word[:-1]] + self[word[-1:]]
            else:
                text = word.decode("utf-8", "surrogatepass")
                if "<|" in text or not _PLAIN.fullmatch(text):
                    ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                    out = b"".join([self.ids[i] for i in ids])
                else:
                    pieces = _PIECES.findall(text.lower())
                    out = self._piece(pieces[0]) if len(pieces) == 1 else b"".join([self[p.encode()] for p in pieces])
            if len(word) > LONG:
                return out
        self[word] = out
        self.bytes += len(word) + len(out) + _ENTRY
        return out

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.table)
        ids = self.ids
        found = self.tokenize(shown)
        return ids[found[0].id] if len(found) == 1 else b"".join([ids[t.id] for t in found])


class WordTokenizer:
    """Ids of a lower-casing byte-level word tokenizer whose words never cross white space.

    Text is split at ASCII white space and each distinct word is encoded once; about ``remembered``
    bytes of words and ids are kept, those of frequent words always and those of long ones never. Equal
    to encoding the text as a whole, which the tests compare. A tokenizer that splits texts in another
    way, as probe texts show, encodes every text as a whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = _Words(self.tokenizer)
        self.remembered = remembered
        self.by_word = True
        self.by_word = all(self.encode(p) == self._whole(p) for p in _PROBES)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text; null is empty."""
        if not text:
            return b""
        if not self.by_word:
            return self._whole(text)
        known = self.known
        if known.bytes > self.remembered // 2:
            known.forget()
        content = text.encode("utf-8", "surrogatepass")
        # ASCII case never matters but in the names of special tokens.
        words = (content if b"<|" in content else content.lower()).split()
        return b"".join(map(known.__getitem__, words))

    def _whole(self, text: str) -> bytes:
        return b"".join([self.known.ids[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker process, so that later tasks know the words of earlier ones."""
    return WordTokenizer(path)
