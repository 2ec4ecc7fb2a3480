"""Token ids of whole texts by the tokenizers library, with a bounded memory of words."""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable
from types import ModuleType

import numpy as np

END_ID = 1
MEMORY = 300_000        # words, and pieces of them, that a worker remembers (each twice)
WORD = 64               # longest one

#: Words whose normal form and pieces are plain: printable ASCII and Latin letters with marks.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*").fullmatch
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall
#: Such vocabularies write the bytes of a character as these characters.
_AS_BYTES = {c: "".join(chr(b) if b >= 161 and b != 173 else chr(256 + (b - 127 + 33 if b < 161 else 67))
                        for b in chr(c).encode()) for c in range(0xC0, 0x100)}
#: The normal form and the cut into pieces that the above stands for, as a vocabulary file states them.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


VOCABULARY = "word_bpe_49k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file on this machine (a driver's or an executor's)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def kept(name: str, make: Callable):
    """``make()`` once in a worker process: what later tasks of the worker find again. This package
    travels to workers by value, so it is held by a module made for that."""
    memory = vars(sys.modules.setdefault("earshot_worker_memory", ModuleType("earshot_worker_memory")))
    if name not in memory:
        memory[name] = make()
    return memory[name]


class _Memory(dict):
    """``make(word)`` by word, remembered. Words not met since the memory was last full are forgotten."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, word: str) -> bytes:
        found = self.before[word] if word in self.before else self.make(word)
        if len(word) <= WORD:
            if len(self) >= MEMORY:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found


class Encoder:
    """``ids(text)``: the ids of ``Tokenizer.encode(text, add_special_tokens=False)`` and the end id.

    Where a vocabulary file's own settings say that it drops white space and no token reaches over
    it, a text's ids are those of its words between spaces and line ends, one after the other: a
    plain word is cut into pieces, each merged alone (by ranks, if the vocabulary can be read so), other
    words go through the whole tokenizer, and their ids are remembered. With any other vocabulary the whole text is encoded at once.
    """

    def __init__(self, path: str) -> None:
        import tokenizers
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        how = json.loads(self.tokenizer.to_str())
        self.by_word = _drops_spaces(how)
        self.merge = self.tokenizer.model.tokenize
        self.plain_ids = _ranked(self.tokenizer.model, how["model"]) if self.by_word else None
        self.pieces, self.words = _Memory(self.piece), _Memory(self.word)

    @classmethod
    def shared(cls, name: str) -> Encoder:
        """One encoder per worker process."""
        path = vocabulary(name)
        return kept(f"encoder {path}", lambda: cls(path))

    def piece(self, piece: str) -> bytes:
        """Packed ids (little-endian uint32) of a plain lower-case piece, by the vocabulary's merges."""
        return _packed([t.id for t in self.merge(piece if piece.isascii() else piece.translate(_AS_BYTES))])

    def word(self, word: str) -> bytes:
        """Packed ids of a word between spaces."""
        if _PLAIN(word) and "<|" not in word:
            pieces = _PIECES(word.lower())
            if self.plain_ids:
                return _packed(self.plain_ids(" ".join(pieces) + " ")) if pieces else b""
            return b"".join(map(self.pieces.__getitem__, pieces))
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def packed(self, text: str | None) -> bytes:
        """The ids of a whole text (null: like an empty one) as little-endian uint32."""
        text = text or ""
        if self.by_word:
            if text.isascii() and "<|" not in text:
                text = text.lower()                # as the normal form does: words in either case are one
            return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" "))) + _END
        return _packed([*self.tokenizer.encode(text, add_special_tokens=False).ids, END_ID])

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u4")


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


_END = _packed([END_ID])


def _ranked(model, how: dict) -> Callable[[str], list[int]] | None:
    """The ids of pieces with a space after each, which stands for the end of a word: the vocabulary read as ranks,
    which is faster than its merges. None where the two could differ.

    They are the same where ids rank the merges, the marked last characters come first, and the merges make every
    token whole out of its own characters: merges that left a token's two parts beside each other in some piece would
    leave them so in the token alone."""
    from tokenizers import models
    vocab, end = how["vocab"], how["end_of_word_suffix"]
    merged = [vocab[a + b] for a, b in how["merges"]]
    bytes_of = {c: b for b, c in _byte_characters()}
    plain = {t: i for t, i in vocab.items() if all(c in bytes_of for c in t.removesuffix(end or ""))}
    base = {t: i for t, i in plain.items() if len(t.removesuffix(end or "")) == 1}
    if (not end or how["dropout"] or how["unk_token"] or how["continuing_subword_prefix"] or how["ignore_merges"]
            or merged != sorted({*merged}) or len(base) != 512 or max(base.values()) >= min(merged)
            or len(base) + len(merged) != len(plain)
            or max(i for t, i in base.items() if not t.endswith(end)) >= min(i for t, i in base.items() if t.endswith(end))):
        return None
    inside = models.BPE(vocab=vocab, merges=[tuple(m) for m in how["merges"]])
    for t, i in plain.items():
        found = model.tokenize(t.removesuffix(end)) if t.endswith(end) else inside.tokenize(t)
        if len(found) != 1 or found[0].id != i:
            return None
    ranks = {bytes(bytes_of[c] for c in t.removesuffix(end)) + b" " * t.endswith(end): i for t, i in plain.items()}
    if len(ranks) != len(plain):
        return None
    import tiktoken
    return tiktoken.Encoding("own", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _byte_characters() -> list[tuple[int, str]]:
    """Each byte and the character that byte-level vocabularies write for it."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [(b, chr(b) if b in printable else chr(next(others))) for b in range(256)]


def _drops_spaces(how: dict) -> bool:
    """Do a vocabulary's settings (normal form, cut into pieces) equal those known here?"""
    normal, cut = how["normalizer"] or {}, how["pre_tokenizer"] or {}
    steps, cuts = normal.get("normalizers"), cut.get("pretokenizers") or [{}]
    return (steps == _NORMAL and cuts[0].get("type") == "Split" and cuts[0].get("pattern") == {"Regex": _CUT}
            and cuts[0].get("behavior") == "Removed" and cuts[0].get("invert") is True
            and [c.get("type") for c in cuts[1:]] == ["ByteLevel"] and cuts[1].get("add_prefix_space") is False)
