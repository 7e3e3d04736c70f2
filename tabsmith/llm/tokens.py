"""Whole-text encoding with a file of the ``tokenizers`` library.

The library spends most of its time merging the same words again and again,
so a worker keeps the ids of words it has seen. That is exact as long as a
text is cut only where the tokenizer itself never joins characters; texts for
which this is not certain (unusual characters, runs of white space, an added
token's content) are handed to the library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tabsmith.llm.common import caches, only

# Texts with other characters take the plain path: within these, Python and the
# tokenizers library agree on letters, digits, white space and lower case.
_SAFE = re.compile("[\n\x20-\x7e¡-ɏ‐-‧€]*")
# Letters and the punctuation after them are encoded apart by both patterns (an
# apostrophe may begin an ending of its own, so it is none of it).
_CLOSED = r"^(\n?\p{L}+)([!-&(-/:-@\[-`{-~]+)$"


def _spelling() -> dict[int, int]:
    """How byte-level tokenizers spell bytes (read as Latin-1): those that print
    stand for themselves, the others for the characters from 256 on, in order.
    The space is left, to part words."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden) if b != 32}


_SPELLING = _spelling()


class Encoder:
    """Ids of texts as little-endian bytes (2 per id when the vocabulary fits).

    ``special_as_text``: a special token's content in a text is encoded like any
    other characters; else it becomes the token, as in the library by default.
    """

    def __init__(self, path: str, limit: int = 800_000, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.n_ids = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.n_ids <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.mode = _mode(spec)
        added = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
        if any(" " in content.strip() for content in added):
            self.mode = None  # words encoded together could form it
        #: what a text must not hold to be cut
        self.added = [c.lower() if self.mode == "dropped" else c for c in added if not special_as_text]
        self.cache: dict[str, bytes] = {}
        self.limit = limit
        caches.append(self.cache)
        if self.mode == "dropped":
            without = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
            self.merges = Tokenizer.from_str(json.dumps({**spec, **without}))
        vocab = self.tokenizer.get_vocab()
        #: for ids of words encoded together: whether an id ends ("dropped") or begins ("spaced") a word
        self.edge = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
        for token, at in vocab.items():
            self.edge[at] = token.endswith("</w>") if self.mode == "dropped" else token.startswith("Ġ")

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The same for words of letters only, a thousand to a call. In lower-case
        words, normalizer and pattern change nothing but the spelling of their
        bytes, so the tokenizer's merges get them spelt, without both (for words
        that carry their space that was measured to save nothing)."""
        out: list[bytes] = []
        lead = " " if self.mode == "spaced" else ""
        if not lead:
            words.sort(key=str.isascii)  # only calls with other letters must spell them out
        for k in range(0, len(words), 1000):
            some = " ".join(words[k : k + 1000])
            if lead:
                (found,) = self.tokenizer.encode_batch_fast([lead + some], add_special_tokens=False)
            else:
                spelt = some if some.isascii() else some.encode().decode("latin-1").translate(_SPELLING)
                (found,) = self.merges.encode_batch_fast([spelt], add_special_tokens=False)
            ids = np.array(found.ids, dtype=self.dtype)
            at = np.flatnonzero(self.edge[ids])
            cuts = [*at.tolist(), len(ids)] if lead else [0, *(at + 1).tolist()]
            data, size = ids.tobytes(), self.dtype.itemsize
            out += [data[a * size : b * size] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _parted(self, text: str) -> str | None:
        """The text with one space between pieces whose ids, joined, are the
        text's ids; None if unsure."""
        if self.mode is None or not _SAFE.fullmatch(text):
            return None
        if self.mode == "dropped":
            text = text.lower()
        if any(content in text for content in self.added):
            return None
        spaces = text.replace("\n", " ")
        if self.mode == "dropped":
            return spaces
        if "  " in spaces:
            return None
        # each piece but the first, and but those around a line break, begins with
        # its space; "\n" is the mark of a piece without one
        return "\n" + text.replace("\n", " \n\n \n")

    def _plain(self, piece: str) -> str:
        if self.mode == "dropped":
            return piece
        return piece[1:] if piece[0:1] == "\n" else " " + piece

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces; those not in the cache are encoded. The
        cache starts anew when they would not all fit."""
        found = list(map(self.cache.get, pieces))
        fresh = [p for p, ids in zip(pieces, found, strict=True) if ids is None]
        words = [p for p in fresh if p.isalpha()]
        others = [p for p in fresh if not p.isalpha()]
        new = dict(zip(words, self._encode_words(words), strict=True))
        new.update(zip(others, self._encode([self._plain(p) for p in others]), strict=True))
        if len(self.cache) + len(new) > self.limit:
            self.cache.clear()
        if len(new) <= self.limit:
            self.cache.update(new)
        return [new[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, in order. Arrow cuts the texts, numbers their
        different pieces and lays the pieces' ids end to end, so that Python sees
        each different word once a call."""
        only(self.cache)
        parted = [self._parted(t) for t in texts]
        sure = pa.array([t for t in parted if t is not None], pa.large_string())
        first, pieces = _split(sure)
        second, words = _split(pc.replace_substring_regex(pieces.dictionary, _CLOSED, r"\1 \2" if self.mode == "dropped" else "\\1 \n\\2"))
        ids = pa.array(self._ids(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        found = iter(_laid(_laid(ids, words, second), pieces, first).to_pylist())
        whole = iter(self._encode([t for t, p in zip(texts, parted, strict=True) if p is None]))
        return [next(whole if p is None else found) for p in parted]


def _split(texts: pa.LargeStringArray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The places at which texts begin and end among their pieces, and the pieces."""
    cut = pc.split_pattern(texts, " ")
    return cut.offsets.to_numpy(), cut.flatten().dictionary_encode()


def _laid(ids: pa.LargeBinaryArray, pieces: pa.DictionaryArray, places: np.ndarray) -> pa.LargeBinaryArray:
    """The ids of texts, from those of their different pieces."""
    _, ends, data = ids.take(pieces.indices).buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[places]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(ends), data])


def _mode(spec: dict) -> str | None:
    """How this tokenizer treats white space, where a cut is known to be safe.

    ``spaced``: byte-level words that carry their leading space. ``dropped``:
    lower-cased words, white space thrown away. None: no cutting.
    """
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "spaced"
    steps = pre.get("pretokenizers") or []
    kinds = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    if (
        steps
        and steps[0].get("type") == "Split"
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert")
        and "[^\\s\\p{L}\\p{N}]+" in steps[0].get("pattern", {}).get("Regex", "")
        and steps[1:] == [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        and kinds == ["NFC", "Replace", "Lowercase"]
    ):
        return "dropped"
    return None


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = True) -> Encoder:
    """One encoder per worker process, file and option."""
    key = path, special_as_text
    if key not in _encoders:
        _encoders[key] = Encoder(path, special_as_text=special_as_text)
    return _encoders[key]


def as_u32(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()
