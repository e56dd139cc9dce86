"""Encoding of distinct words with a public tokenizer's vocabulary file.

The file's text is read on the driver and broadcast (its size is the
vocabulary's, not the data's), so executors need no copy of it.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np


def tokenizer_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def open_tokenizer(text: str):
    """A tokenizer without truncation and padding that uses one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode_words(tokenizer, words: list[str], at_once: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words that the tokenizer treats independently: flat, with offsets by word."""
    flat, counts = [], []
    for low in range(0, len(words), at_once):
        part = words[low:low + at_once]
        found = tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
        flat.append(np.array(found.ids, np.uint32))
        counts.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part))
                      if found.ids else np.zeros(len(part), np.int64))
    if not words:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    return np.concatenate(flat), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def gather(flat: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """The slices ``flat[offsets[i]:offsets[i + 1]]`` for every pick, one after the other."""
    size = offsets[picks + 1] - offsets[picks]
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    shift = np.repeat(offsets[picks] - (ends - size), size)
    return flat[shift + np.arange(ends[-1])]


class WordTable(dict):
    """Words by place in the table; a new word gets the next place."""

    def __missing__(self, word):
        place = self[word] = len(self)
        return place

    def places(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def byte_pieces(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id of a byte-level vocabulary: flat, with offsets by id."""
    model = json.loads(text)
    # The published byte alphabet: printable bytes stand for themselves, all
    # others for the code points from 256 on, in order.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    names = {i: token for token, i in model["model"]["vocab"].items()}
    names |= {t["id"]: t["content"] for t in model["added_tokens"]}
    pieces = [b""] * (max(names) + 1)
    for i, token in names.items():
        known = all(c in byte_of for c in token)
        pieces[i] = bytes(byte_of[c] for c in token) if known else token.encode()
    return (np.frombuffer(b"".join(pieces), np.uint8),
            np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64))


class LowerWords:
    """Texts as keys that are encoded on their own, for byte-level vocabularies of lower-case words.

    Words of Latin letters (U+0020 to U+00FF) and punctuation are cut by the tokenizer's
    own pattern; such a piece goes to the library's BPE model directly.  All other words between ASCII white
    space (contractions, special tokens, other alphabets, marks) are keys as a
    whole, marked by ``WHOLE``, and go through the library's full encoding.
    """

    WHOLE = "\0"
    LATIN = "!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"          # no apostrophe
    WORD = re.compile(f"[{LATIN}]+")
    TEXT = re.compile(f"[{LATIN}\t-\r ]*")
    PIECE = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9\t-\r ]+")

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(256 + i) for i, b in enumerate(rest)}

    def keys(self, body: bytes) -> list[str]:
        if b"<|" not in body:
            text = body.decode()
            if self.TEXT.fullmatch(text):
                return self.PIECE.findall(text.lower())
        out: list[str] = []
        for word in map(bytes.decode, body.split()):
            if self.WORD.fullmatch(word) and "<|" not in word:
                out += self.PIECE.findall(word.lower())
            else:
                out.append(self.WHOLE + word)
        return out

    def encode(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct keys: flat, with offsets by key."""
        rest, rest_at = encode_words(self.tokenizer, [k[1:] for k in keys if k[0] == self.WHOLE])
        rest, at = rest.tolist(), rest_at.tolist()
        flat: list[int] = []
        ends, n = [0], 0
        for key in keys:
            if key[0] == self.WHOLE:
                flat += rest[at[n]:at[n + 1]]
                n += 1
            else:
                mapped = key if key.isascii() else key.encode().decode("latin-1").translate(self.alphabet)
                flat += [t.id for t in self.model.tokenize(mapped)]
            ends.append(len(flat))
        return np.array(flat, np.uint32), np.array(ends, np.int64)
