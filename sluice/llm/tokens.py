"""Exact, memoised encoding with the files of public tokenizers.

Pre-tokenisation of both vocabularies never joins text across the end of a run of non-space characters, nor
across a full stop or comma between a letter or digit and white space.  A text is cut there; each distinct chunk is encoded by
the tokenizers library once and kept, and a slice of texts is put together from the kept ids by array indexing.  Texts with
white space other than U+0020 and U+000A go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np

MOST_KEPT = 600_000
LONGEST_KEPT = 200

_ODD_SPACE = re.compile(r"[^\S \n]")
#: Letters and digits that are such to every engine, and that stay one letter in lower case (U+0130 does not).
_PLAIN = "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0391-\u03a1\u03a3-\u03ff\u0410-\u044f"
#: A full stop or comma that does not stand between one of these and white space or the end.
_ODD_STOP = re.compile(rf"[.,](?:(?<![{_PLAIN}][.,])|(?![ \n]|\Z))")
_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_END = ""  # no key of a text is empty; those that begin with U+000D are texts and chunks to be encoded as they are
_encoders: dict[tuple[str, int], Encoder] = {}


class _Codes(dict):
    """key -> number, counting up; keys met for the first time are noted in new."""

    def __init__(self, *args):  # noqa: ANN002
        super().__init__(*args)
        self.new: list[str] = []
        self.next = max(self.values(), default=-1) + 1

    def __missing__(self, key: str) -> int:
        code = self[key] = self.next
        self.next += 1
        self.new.append(key)
        return code


class Encoder:
    """texts -> (all ids, bounds of each text's), an end id after each text."""

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # the strings of special tokens are ordinary text
        pieces = {i: t for t, i in self.library.get_vocab().items()}
        self.words = self.library.pre_tokenizer.__class__.__name__ == "Sequence"  # white space is dropped
        self.edge = np.array([pieces.get(i, "").endswith("</w>") if self.words else pieces.get(i, "").startswith("Ġ") for i in range(max(pieces) + 1)])
        self.newline = np.array([pieces.get(i) == "Ċ" for i in range(max(pieces) + 1)])
        self.end_id = end_id
        self._reset()

    def _reset(self) -> None:
        self.codes = _Codes({_END: 0})
        self.ids, self.first, self.size = np.array([self.end_id], dtype=np.uint32), np.zeros(1, np.int32), np.ones(1, np.int32)  # where the ids of a number are

    def _text(self, key: str) -> str:
        if key[0] == "\r":
            return key[1:]
        return key if self.words or key[0] in "\n " or key in (".", ",") else " " + key

    def _stops_apart(self, text: str) -> str | None:
        """Stops set apart from words where that is safe; None if the byte-level chunks could be mistaken."""
        if not _ODD_STOP.search(text):
            return text.replace(".", " .").replace(",", " ,")
        if not self.words and re.search(r"(?:\A|[ \n])[.,](?![^ \n])", text):
            return None
        return "\n".join(x if _ODD_STOP.search(x) else x.replace(".", " .").replace(",", " ,") for x in text.split("\n"))

    def _keys(self, text: str) -> list[str]:
        if _ODD_SPACE.search(text):
            return ["\r" + text]
        if self.words:
            return self._stops_apart(text).split()
        if text and text[0] not in " \n" and text[-1] not in " \n" and "  " not in text and "\n\n" not in text and " \n" not in text and "\n " not in text:
            apart = self._stops_apart(text)
            if apart is not None:
                out = apart.replace("\n", " \n").split(" ")
                out[0] = "\r" + out[0]
                return out
        return ["\r" + x for x in _CHUNK.findall(text)]

    def _learn(self) -> None:
        """Encodes the new keys, in their order."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        first, size = np.full(len(new), -1, dtype=np.int32), np.zeros(len(new), dtype=np.int32)
        found, at = [self.ids], len(self.ids)
        # runs of letters are one pre-token each, so many can go to the library as one text
        letters = [k for k, x in enumerate(new) if x.isalpha()]
        begins = [] if self.words else [k for k, x in enumerate(new) if x[0] == "\n" and x[1:].isalpha()]
        parts = [(part[a : a + 50], edge) for part, edge in ((letters, self.edge), (begins, self.newline)) for a in range(0, len(part), 50)]
        texts = ["".join([new[k] for k in part]) if edge is self.newline else ("" if self.words else " ") + " ".join([new[k] for k in part]) for part, edge in parts]
        for (part, edge), e in zip(parts, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype=np.uint32)
            cut = np.flatnonzero(edge[ids])
            if len(cut) == len(part):
                bounds = np.concatenate(([0], cut + 1)) if self.words else np.concatenate((cut, [len(ids)]))
                first[part], size[part] = at + bounds[:-1], np.diff(bounds)
                found.append(ids)
                at += len(ids)
        rest = np.flatnonzero(first < 0).tolist()
        for k, e in zip(rest, self.library.encode_batch_fast([self._text(new[k]) for k in rest], add_special_tokens=False)):
            first[k], size[k] = at, len(e.ids)
            found.append(np.array(e.ids, dtype=np.uint32))
            at += len(e.ids)
        self.ids, self.first, self.size = np.concatenate(found), np.concatenate((self.first, first)), np.concatenate((self.size, size))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.codes.next > MOST_KEPT:  # the keys met first are mostly the frequent ones
            keep = MOST_KEPT // 4
            self.codes = _Codes({k: c for k, c in self.codes.items() if c < keep})
            self.codes.next = keep
            self.first, self.size = self.first[:keep], self.size[:keep]
            self.ids = self.ids[: int((self.first + self.size).max())]
        keys = [[*self._keys(t), _END] for t in texts]
        long = [x[0] for x in keys if len(x[0]) > LONGEST_KEPT]
        many = np.array([len(x) for x in keys])
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(keys)), dtype=np.int32, count=int(many.sum()))
        self._learn()
        first, size = self.first[codes], self.size[codes]
        ends = np.cumsum(size, dtype=np.int32)
        ids = self.ids[np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        bounds = np.concatenate(([0], ends[np.cumsum(many) - 1])) if len(many) else np.zeros(1, np.int64)
        for key in long:
            self.codes.pop(key, None)
        return ids, bounds


def encoder(path: str, end_id: int) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """The encoder of a file, one per process: ids without special tokens, and end_id after each text."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]
