"""Vocabulary files of public tokenizers: paths, cached loading and exact pre-tokenisation.

A vocabulary file is never copied: operators take its path, by default where the
installed ``public_tokenizers`` module says.  Each Python worker loads a file once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

from .textbatch import single_threaded

#: Fixed: how the byte-level vocabulary splits texts before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed: how the lower-cased word vocabulary splits texts.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters on whose classes all regex engines agree: ASCII without the separators 28 to 31, Latin
#: letters, common punctuation. Texts with others are split by the tokenizer library itself.
PLAIN_CHARACTERS = r"\x00-\x1b\x20-\x7f\xa1\xa3\xa7\xa9\xab\xae\xb0\xb7\xbb\xbf-\u024f\u2010-\u2027\u20ac"
_PLAIN = re.compile(f"[{PLAIN_CHARACTERS}]*")
#: What the two patterns above mean on plain characters, for the standard library's faster engine.
_PLAIN_LETTERS, _PLAIN_REST = r"[^\W\d_]+", r"(?:[^\s\w]|_)+"
PLAIN_BYTE_LEVEL = re.compile(BYTE_LEVEL_PATTERN.replace(r"[^\s\p{L}\p{N}]+", _PLAIN_REST).replace(r"\p{L}+", _PLAIN_LETTERS).replace(r"\p{N}+", r"\d+"))
PLAIN_WORD = re.compile(WORD_PATTERN.replace(r"[^\s\p{L}\p{N}]+", _PLAIN_REST).replace(r"[\p{L}]+", _PLAIN_LETTERS).replace(r"[\p{N}]", r"\d"))


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def is_plain(text: str) -> bool:
    return _PLAIN.fullmatch(text) is not None


@lru_cache(maxsize=4)
def tokenizer(path: str):
    single_threaded()
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=4)
def definition(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(printable))
    return out


@lru_cache(maxsize=4)
def special_pattern(path: str):
    specials = [x["content"] for x in definition(path)["added_tokens"]]
    return re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None


def special_ids(path: str) -> dict[str, int]:
    return {x["content"]: x["id"] for x in definition(path)["added_tokens"]}


def sections(path: str, text: str) -> Iterator[tuple[bool, str]]:
    """The text cut at special strings: (is special, part), empty parts left out."""
    pattern = special_pattern(path)
    if pattern is None or "<|" not in text:
        if text:
            yield False, text
        return
    for i, part in enumerate(pattern.split(text)):
        if part:
            yield i % 2 == 1, part
