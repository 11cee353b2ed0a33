"""Token ids of whole texts by the tokenizers library.

A byte-level tokenizer's own splitting never joins what stands before a space
or a newline with it and the character after it, so a text's ids are those of
its pieces cut before each single space and newline.  Pieces repeat, and each
is encoded once per worker process as long as its bounded memory of pieces
holds it; words of Latin letters by themselves, marks behind them as a run, the
other new pieces of a text in one call, a line each.  Texts
where the cut could matter (a space or newline before other white space or at
the end, a special token) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct

_DOUBTFUL = re.compile(r"[ \n](?=\s|\Z)")
_OTHER_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and c not in (10, 32))


def _doubtful(text: str) -> bool:
    """The pattern's verdict, by plain searches where they can tell."""
    if text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return True
    return any(c in text for c in _OTHER_SPACES) and _DOUBTFUL.search(text) is not None


# ASCII punctuation but the apostrophe, which may begin a piece of its own kind ('s).
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and c != 39)


def _latin(word: str) -> bool:
    """Letters only, and only such as are letters in every Unicode version."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as one letter: printable Latin-1
    bytes as themselves, the others from code point 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """``remembered`` pieces are held in each of two generations: when the
    young one is full it becomes the old one, which is then forgotten."""

    def __init__(self, path: str, remembered: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._remembered = remembered
        self._firsts = {"": b""}
        form = json.loads(self._tokenizer.to_str())
        plain = form["normalizer"] is None and (form["pre_tokenizer"] or {}).get("type") == "ByteLevel" and form["model"]["type"] == "BPE"
        self._model, self._letters = self._tokenizer.model if plain else None, _byte_letters()
        self._newline = self._whole(["\n"])[0]
        self._marks: dict[str, bytes] = {"": b""}

    def _whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, dtype="<u4").tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word behind one space, or behind the newline it starts with."""
        import numpy as np

        plain, odd = words, []
        if len(self._newline) != 4:
            plain, odd = [], words
        elif len("\n".join(words).split()) != len(words):  # white space inside some word
            plain, odd = [w for w in words if len(w.split()) == 1], [w for w in words if len(w.split()) != 1]
        out = dict(zip(odd, self._whole([w if w[0] == "\n" else " " + w for w in odd])))
        if plain:
            ids = self._whole(["".join([w if w[0] == "\n" else "\n " + w for w in plain])])[0]
            ends = (np.flatnonzero(np.frombuffer(ids, "<u4") == int.from_bytes(self._newline, "little")) * 4).tolist()
            for w, low, high in zip(plain, ends, [*ends[1:], len(ids)]):
                out[w] = ids[low:high] if w[0] == "\n" else ids[low + 4:high]
        return out

    def _learn(self, words: set[str]) -> None:
        """Put words that the young generation lacks into it: those that the old
        one holds move over.  A new word of Latin letters and closing marks is
        the word's ids, then those of the run of marks (what counts as a letter
        elsewhere depends on the Unicode version)."""
        new = []
        young, old, marks = self._young, self._old, self._marks
        for w in words:
            ids = old.get(w)
            if ids is not None:
                young[w] = ids
                continue
            stem = w.rstrip(_MARKS)
            if _latin(stem):
                if stem == w:
                    if w not in young:  # not the stem of another new word
                        young[w] = self._word(w)
                    continue
                ids = young.get(stem) or old.get(stem)
                if ids is None:
                    ids = young[stem] = self._word(stem)
            elif stem[:1] == "\n" and _latin(stem[1:]):  # no space between them
                ids = self._newline + self._begin(stem[1:])
            else:
                new.append(w)
                continue
            mark = w[len(stem):]
            after = marks.get(mark)
            young[w] = ids + (self._run(mark) if after is None else after)
        if new:
            young.update(self._pieces(new))

    def _run(self, mark: str) -> bytes:
        """Ids of a run of marks behind letters: a piece of its own."""
        ids = self._whole([mark])[0]
        if len(mark) < 16 and len(self._marks) < 4096:
            self._marks[mark] = ids
        return ids

    def _begin(self, first: str) -> bytes:
        """Ids of a word with no space before it."""
        ids = self._firsts.get(first)
        if ids is None:
            ids = self._word(first, "") if _latin(first) else self._whole([first])[0]
            if len(self._firsts) > 50_000:
                self._firsts = {"": b""}
            if len(first) < 64:
                self._firsts[first] = ids
        return ids

    def _word(self, word: str, space: str = " ") -> bytes:
        """Ids of a word of letters, by default behind one space: a single piece
        to a byte-level tokenizer, so its model can be asked directly."""
        if self._model is None:
            return self._whole([space + word])[0]
        piece = space + word
        if word.isascii():  # letters are written as themselves
            found = self._model.tokenize(piece.replace(" ", self._letters[32]))
        else:
            found = self._model.tokenize(piece.encode().decode("latin-1").translate(self._letters))
        return struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if _doubtful(text) or any(s in text for s in self._special):
            return self._whole([text])[0]
        first, *rest = text.replace("\n", " \n").split(" ")
        young = self._young
        new = set(rest).difference(young)
        if new:
            self._learn(new)
        out = self._begin(first) + b"".join(map(young.__getitem__, rest))
        if new:  # memory is bounded by the number of pieces
            if max(map(len, new)) >= 64:
                for w in [w for w in new if len(w) >= 64]:
                    young.pop(w, None)
                    young.pop(w.rstrip(_MARKS), None)
            if len(young) > self._remembered:
                self._old, self._young = young, {}
        return out


def worker_encoder(path: str) -> Encoder:
    """One encoder per worker process and file.  It is kept on the library's
    module, because functions shipped by value have new globals in every task."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_encoders_by_path", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def forget_encoders() -> None:
    """Drop the encoders (and their pieces) that this worker process keeps."""
    import sys

    getattr(sys.modules.get("tokenizers"), "__dict__", {}).pop("_encoders_by_path", None)


def default_tokenizer() -> str:
    """The public vocabulary file of the queries, by path; never copied."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
