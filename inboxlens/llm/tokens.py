"""Whole texts to token ids with a public ``tokenizers`` vocabulary.

A byte-pair encoder spends most of its time on words it has met before.  The text is
cut only where the tokenizer's own pre-tokenisation cuts as well, each distinct piece is
encoded once per task, and the pieces' ids are joined, which gives the same ids as one
call on the whole text (``tests/llm/test_tokens.py`` compares them).  The strings of the
vocabulary's added tokens are cut out first and have their own ids, as in the library.  Most pieces are a
word of Latin letters and closing marks: the word goes to the tokenizer's model directly,
once for all its marks, and skips the general normaliser and splitter, which would leave
it as it is but for its case.
"""

from __future__ import annotations

import codecs
import functools
import json
import operator
import os
import re
import struct
from collections.abc import Callable

# White space as the tokenizers' patterns understand it (Unicode White_Space).
_SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CONTROL = re.compile("[\x1c-\x1f]")
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"  # letters that composition and splitting leave alone
_MARKS = ".,!?;:%$&*#"
_WORD = re.compile(f"([ \n]?)([{_LATIN}]+)([{_MARKS}]*)")
_PIECES = re.compile(f"[ \n]?[^{_SPACES}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]")


def _drops_spaces(spec: dict) -> bool:
    """The normaliser composes and lower-cases, and the pre-tokeniser splits at white space
    and removes it."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or []]
    return (kinds == ["NFC", "Replace", "Lowercase"] and bool(steps)
            and steps[0].get("type") == "Split" and steps[0].get("invert") is True)


def _keeps_spaces(spec: dict) -> bool:
    """Byte-level pre-tokenisation that joins one space to the word after it."""
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and pre.get("use_regex") is True
            and not pre.get("add_prefix_space") and spec.get("normalizer") is None)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: printable ones stand for
    themselves, the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


def encoder(path: str, cache: int = 800_000) -> Callable[[list[str]], list[bytes]]:
    """``encode(texts)``: each text's ids as little-endian unsigned 32-bit integers.

    ``cache`` bounds the number of remembered pieces: of two halves the older one is dropped,
    but for what was met since.  A vocabulary whose
    pre-tokenisation is not one of the two known kinds, or whose added tokens do not match
    just as they are written, is encoded text by text.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import numpy as np
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tok = Tokenizer.from_file(path)
    added = spec.get("added_tokens") or []
    # the library looks for these in the text as it is, before all else
    fixed = {a["content"]: struct.pack("<I", a["id"]) for a in added if a["content"]}
    simple = not any(a.get(flag) for a in added for flag in ("normalized", "single_word", "lstrip", "rstrip"))
    around = re.compile("(" + "|".join(map(re.escape, sorted(fixed, key=len, reverse=True))) + ")") if fixed else None

    def direct(text: str) -> bytes:
        return np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    few = functools.lru_cache(4096)(direct)  # runs of marks
    lower, letters = _drops_spaces(spec), _byte_letters()
    model = tok.model

    packers = [struct.Struct(f"<{n}I").pack for n in range(64)]
    byte_letters = "".join(letters[b] for b in range(256))
    space, id_of = letters[0x20], operator.attrgetter("id")

    def ids_of(word: str) -> bytes:
        if not word.isascii():
            word = codecs.charmap_decode(word.encode(), "strict", byte_letters)[0]
        elif word[0] == " ":
            word = space + word[1:]
        found = model.tokenize(word)
        n = len(found)
        return packers[n](*map(id_of, found)) if n < 64 else struct.pack(f"<{n}I", *map(id_of, found))

    class Known(dict):
        """Ids by piece; a new piece is looked for in the older half, and encoded when it is
        not there: a word with marks from the piece that is the word alone."""

        def __init__(self, old: dict[str, bytes]):
            self.old = old

        def __missing__(self, piece: str) -> bytes:
            ids = self[piece] = self.old.get(piece) or self.encoded(piece)
            return ids

        def encoded(self, piece: str) -> bytes:
            if not lower and piece[0] == " " and piece.isascii():
                # a plain word after a space, the commonest piece where spaces are kept
                if piece[1:].isalpha():
                    return ids_of(piece)
                word = piece.rstrip(_MARKS)
                if word[1:].isalpha():
                    return self[word] + few(piece[len(word):])
            m = _WORD.fullmatch(piece)
            if not m:
                return direct(piece)
            lead, word, marks = m.groups()
            if lower:
                word = word.lower()
            elif lead == " ":
                word, lead = " " + word, ""
            if word == piece:
                return ids_of(word)
            ids = self[word]
            if lead:
                ids = few(lead) + ids
            return ids + few(marks) if marks else ids

    known = Known({})

    def joined(texts: list[str], cut: Callable[[str], list[str]]) -> list[bytes]:
        nonlocal known
        out = []
        for text in texts:
            if len(known) > cache // 2:
                known.old = {}
                known = Known(known)
            out.append(b"".join(map(known.__getitem__, cut(text))))
        return out

    def spaced(texts: list[str]) -> list[bytes]:
        return [direct(text) if _CONTROL.search(text) else joined([text], str.split)[0]
                for text in texts]

    def apart(encode: Callable[[list[str]], list[bytes]]) -> Callable[[list[str]], list[bytes]]:
        """``encode`` for texts in which added tokens may stand: what is between them is
        encoded by itself, as the library does."""
        def encoded(texts: list[str]) -> list[bytes]:
            out = encode([t for t in texts if not around.search(t)])
            if len(out) == len(texts):
                return out
            rest = iter(out)
            return [b"".join(fixed.get(part) or encode([part])[0] for part in around.split(t) if part)
                    if around.search(t) else next(rest) for t in texts]

        return encoded if around else encode

    if simple and _drops_spaces(spec):
        return apart(spaced)
    if simple and _keeps_spaces(spec):
        return apart(lambda texts: joined(texts, _PIECES.findall))
    return lambda texts: [direct(text) for text in texts]
