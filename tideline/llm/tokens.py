"""Tokenizer vocabularies inside tasks.  The files belong to the installed
``public_tokenizers`` package (or any path given); they are read once per
Python worker and never copied."""

from __future__ import annotations

import base64
import json
import os
import re
from functools import lru_cache

import regex
import tiktoken

#: Pre-token pattern of the rank files, as published with them.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def added_tokens(path: str) -> dict[str, int]:
    """Added tokens of the tokenizer file beside a rank file; none without one."""
    file = path.removesuffix(".tiktoken") + ".json"
    if not os.path.exists(file):
        return {}
    with open(file, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    for t in added:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
            raise ValueError(f"{file}: added token {t['content']!r} is not matched literally")
    return {t["content"]: t["id"] for t in added}


#: Characters from which a text is split here: the library's own splitter gives up on a run of some 700,000 blanks.
LONG_TEXT = 100_000


def encode_word(own: tiktoken.Encoding, word: str | bytes) -> list[int]:
    """Ids of one pre-token, which is not split again."""
    return own._encode_single_piece(word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass"))


def encode_plain(own: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of a text without special tokens, however long its runs are."""
    if len(text) <= LONG_TEXT:
        return own.encode_ordinary(text)
    out, known = [], {}
    for m in splitter().finditer(text):
        word = m.group()
        ids = known.get(word)
        if ids is None:
            ids = encode_word(own, word)
            if len(known) < LONG_TEXT:
                known[word] = ids
        out += ids
    return out


@lru_cache(maxsize=4)
def tokenizer_encode(path: str):
    """``text -> ids`` as the tokenizer file gives them without the tokens of a
    template: its added tokens are cut out first."""
    added, own = added_tokens(path), encoding(path)
    if not added:
        return lambda text: encode_plain(own, text)
    cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")

    def encode(text: str) -> list[int]:
        parts = cut.split(text)
        if len(parts) == 1:
            return encode_plain(own, text)
        out = []
        for k, part in enumerate(parts):               # every second part is an added token
            out += [added[part]] if k % 2 else encode_plain(own, part)
        return out
    return encode


@lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks(path).items()}


@lru_cache(maxsize=1)
def splitter() -> regex.Pattern:
    return regex.compile(PATTERN)


# The pattern's classes among the first 256 code points: white space, letters, numbers.
_SPACE, _LETTERS, _NUMBERS = r" \t\n\r\x0b\x0c\x85\xa0", "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"


@lru_cache(maxsize=1)
def latin_splitter() -> re.Pattern:
    """The same pattern for texts of those code points, in the faster of the two regex libraries."""
    return re.compile(rf" ?[{_LETTERS}]+| ?[{_NUMBERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_SPACE}{_LETTERS}{_NUMBERS}]+"
                      rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def split_words(text: str) -> list[str]:
    """All matches of ``PATTERN``."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return splitter().findall(text)
    return latin_splitter().findall(text)
