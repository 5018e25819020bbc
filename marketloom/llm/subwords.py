"""Subword tokenizers of public vocabulary files, for use inside tasks.

A vocabulary file is opened once in each Python worker. Texts are cut at places where no pre-token of a byte-level pattern can
continue (before a space that a non-space follows); a piece between two cuts always has the same ids, so ids of common pieces are
remembered, in a dictionary of bounded size, and only unseen pieces go through the library.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k.json"

#: Remembered pieces of one worker (about 200 bytes each); beyond that only the latest texts' pieces stay. Six times as many save 5 %
#: of the time and take 120 MB more, which a reused worker never gives back.
MOST_PIECES = 100_000
#: Longer pieces (a text without spaces) are never remembered.
LONGEST_PIECE = 64

_CUT = re.compile(r"(?= \S)")
#: A space with white space on both sides or at a text's end after white space: plain splitting at spaces would cut inside a run.
_RUN = re.compile(r"\s (?!\S)")
_ASCII_RUNS = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ", "\x1c ", "\x1d ", "\x1e ", "\x1f ")


@lru_cache(maxsize=1)
def tokenizer(name: str = VOCABULARY):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(public_tokenizers.path(name))
    out.no_truncation()
    out.no_padding()
    return out


def pieces(text: str) -> list[str]:
    """Cuts of a text; joined they give the text again."""
    if any(x in text for x in _ASCII_RUNS) if text.isascii() else _RUN.search(text):
        return [x for x in _CUT.split(text) if x]
    first, *rest = text.split(" ")
    return ([first] if first else []) + [f" {x}" for x in rest]


def _ranks(name: str) -> str | None:
    """The rank file of a vocabulary, if it has one."""
    import public_tokenizers

    path = public_tokenizers.path(name).removesuffix(".json") + ".tiktoken"
    return path if os.path.exists(path) else None


def _marks(name: str) -> set[str]:
    """First two characters of each special string."""
    return {x.content[:2] for x in tokenizer(name).get_added_tokens_decoder().values()}


@lru_cache(maxsize=1)
def _encoder(name: str):
    """Ids of one piece. A vocabulary that also has a rank file is encoded from that, which gives the same ids faster; pieces with
    a special string are left to the tokenizers library."""
    whole = tokenizer(name)
    ordinary = lambda x: whole.encode(x, add_special_tokens=False).ids
    ranks = _ranks(name)
    if not ranks:
        return ordinary
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    marks = _marks(name)
    return lambda x: ordinary(x) if any(m in x for m in marks) else fast(x)


def splitter(name: str = VOCABULARY):
    """A function that cuts a piece into pre-tokens, the matches of the vocabulary's pattern; a piece with a special string stays whole,
    and so does every piece of a vocabulary whose pattern isn't known."""
    if not _ranks(name):
        return lambda x: [x]
    import public_tokenizers
    import regex

    find, marks = regex.compile(public_tokenizers.PATTERN).findall, _marks(name)
    return lambda x: [x] if any(m in x for m in marks) else find(x)


_known: dict[str, dict[str, bytes]] = {}


def encode(texts: list[str], name: str = VOCABULARY) -> list[np.ndarray]:
    """Ids of each text, without added special tokens; special strings inside texts are handled as the library does by default."""
    known, one = _known.setdefault(name, {}), _encoder(name)
    cut = [pieces(x) for x in texts]
    distinct = set().union(*cut)
    long = {x: array("I", one(x)).tobytes() for x in distinct if len(x) > LONGEST_PIECE}
    for x in distinct - known.keys() - long.keys():
        known[x] = array("I", one(x)).tobytes()
    get = (lambda x: long[x] if len(x) > LONGEST_PIECE else known[x]) if long else known.__getitem__
    out = [np.frombuffer(b"".join(map(get, p)), dtype="<u4") for p in cut]
    if len(known) > MOST_PIECES:  # what these texts use stays
        _known[name] = {x: known[x] for x in distinct if x in known}
    return out


def portions(texts: list[str], most_chars: int = 2_000_000):
    """(from, to) of runs of texts with about most_chars together, so that a batch's pieces never exist at once."""
    start = held = 0
    for i, x in enumerate(texts):
        held += len(x)
        if held >= most_chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def count(strings: list[str], name: str = VOCABULARY) -> np.ndarray:
    """Number of ids of each string."""
    one = _encoder(name)
    return np.fromiter((len(one(x)) for x in strings), dtype=np.int64, count=len(strings))
