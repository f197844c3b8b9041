"""Byte-level BPE ids of Arrow text columns, from a tokenizer file of the ``tokenizers`` library.

The file's vocabulary is read as merge ranks into ``tiktoken``, which gives the same ids
several times faster; the tests compare both.  Added tokens of the file are recognised in
texts, as ``tokenizers`` does by default.
"""

from __future__ import annotations

import json
import re
from functools import cache

import tiktoken

# The splitting pattern of the byte-level pre-tokenizer.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# White space as the pattern means it.  Runs beyond this length overflow the library's matcher.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 10_000
_LONG_RUN = re.compile(f"[{BLANKS}]{{{LONG_RUN},}}")


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def encoding(path: str) -> tiktoken.Encoding:
    """The encoding of a tokenizer file; built once per Python worker."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    byte_of = _byte_of()
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in spec["model"]["vocab"].items()
        if token not in added
    }
    return tiktoken.Encoding(
        "byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


def encode_plain(path: str, text: str) -> list[int]:
    """The ids of a text in which the strings of added tokens are plain text.

    A run of blanks is one part without its last blank, which goes with what follows; at the
    end of the text the run is one part as a whole.  Long runs are cut out by that rule.
    """
    enc = encoding(path)
    at, out = 0, []
    for run in _LONG_RUN.finditer(text) if len(text) >= LONG_RUN else ():
        stop = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > at:
            # What stands before is no blank, but for the last blank of an earlier run.
            out += enc.encode_ordinary(text[at : run.start()])
        out += enc._encode_single_piece(text[run.start() : stop])
        at = stop
    return out + enc.encode_ordinary(text[at:]) if at else enc.encode_ordinary(text)


@cache
def _added(path: str) -> re.Pattern | None:
    names = encoding(path).special_tokens_set
    longest_first = sorted(names, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, longest_first))) if names else None


def encode(path: str, text: str) -> list[int]:
    added = _added(path)
    if added is None or not added.search(text):
        return encode_plain(path, text)
    out, at = [], 0
    for token in added.finditer(text):
        out += encode_plain(path, text[at : token.start()])
        out.append(encoding(path)._special_tokens[token.group()])
        at = token.end()
    return out + encode_plain(path, text[at:])


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id; added tokens stand for their text."""
    enc = encoding(path)
    return [enc.decode_single_token_bytes(i) for i in range(enc.n_vocab)]
