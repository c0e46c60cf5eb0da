"""Token ids of texts, by a public tokenizer file.

Byte-level BPE whose ids follow its merges is what tiktoken computes as well, several times
as fast. It gets the texts for which the two agree for certain; for all others, and other
files, pieces are remembered. Byte-level BPE never merges across the border between a word and the white space that
follows it, so a text is cut there and the ids of each piece are remembered: most pieces
of a corpus repeat. Ids are those of the whole text.
"""

from __future__ import annotations

import json
import re
import threading
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np

from paperloom.llm.worker import kept

#: White space, then everything else, up to the next white space. The four separators are
#: white space to Python only.
PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: Beyond the scripts whose letters all versions of Unicode agree on; and runs of white space
#: that tiktoken's pattern cannot take.
BEYOND = re.compile("[^\x00-\u052f]")
BLANKS = re.compile(r"\s{5000}")
#: How byte-level BPE cuts texts. A fixed value of the format.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: A worker remembers this many pieces, and as many older ones. Longer pieces are not kept.
REMEMBERED = 400_000
LONGEST = 64
#: Seconds after which a worker that has gone over to other work forgets its pieces.
IDLE = 10


def _byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: themselves where they
    can be seen, else those from 256 on, in order."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _tiktoken(described: dict):
    """The same encoding by tiktoken, or None if there is none."""
    try:
        import tiktoken
    except ImportError:
        return None
    model, cut = described["model"], described["pre_tokenizer"] or {}
    plain = (model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and described["normalizer"] is None
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space"))
    if not plain:
        return None
    added = {t["content"] for t in described["added_tokens"]}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
    pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    merged = [vocabulary.get(a + b, -1) for a, b in pairs]
    byte = _byte_characters()
    if (any(x >= y for x, y in zip(merged, merged[1:])) or min(merged, default=0) < 256 or len(vocabulary) != len(merged) + 256
            or not all(c in byte for t in vocabulary for c in t) or not all(c in vocabulary for c in byte)):
        return None
    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items()}
    return tiktoken.Encoding("of a file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts as unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = _tiktoken(json.loads(self.tokenizer.to_str()))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes = None
        self.timer: threading.Timer | None = None
        if self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, ByteLevel):
            vocabulary = self.tokenizer.get_vocab()  # a character of a token stands for a byte
            self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _encode_joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with white space and end without: encoded as one text,
        and told apart by the number of bytes that each token stands for. Should the borders
        not meet, each piece is encoded by itself."""
        text = "".join(pieces)
        ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        at = np.cumsum(list(map(len, pieces)) if text.isascii() else [len(p.encode()) for p in pieces])
        upto = np.cumsum(self.bytes[ids])
        ends = np.minimum(np.searchsorted(upto, at), len(upto) - 1)
        if not (upto[ends] == at).all():
            return self._encode(pieces)
        raw, stops = ids.tobytes(), (4 * ends + 4).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def _learn(self, new: set[str], edges: set[str]) -> dict[str, bytes]:
        """Encode pieces and remember them; returns those too long to be remembered. `edges`
        may begin without white space, or end with it, and are encoded by themselves."""
        single = list(new) if self.bytes is None else list(new & edges)
        joined = [] if self.bytes is None else list(new - edges)
        found = dict(zip(single, self._encode(single))) if single else {}
        if joined:
            found.update(zip(joined, self._encode_joined(joined)))
        long = {p: found.pop(p) for p in [p for p in found if len(p) > LONGEST]}
        self.known.update(found)
        return long

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if any(s in text for s in self.special):  # found before the text is cut into words
            return np.frombuffer(self._encode([text])[0], np.uint32)
        if self.fast is not None and (text.isascii() or not BEYOND.search(text)) and (len(text) < 5000 or not BLANKS.search(text)):
            return np.frombuffer(array("I", self.fast.encode_ordinary(text)), np.uint32)
        pieces = PIECE.findall(text)
        new, once = set(pieces).difference(self.known), {}
        if new and self.older:
            back = {p: self.older[p] for p in new if p in self.older}
            self.known.update(back)
            new -= back.keys()
        if new:
            once = self._learn(new, {pieces[0], pieces[-1]})
        known = self.known
        if once:
            out = b"".join([once[p] if p in once else known[p] for p in pieces])
        else:
            out = b"".join(map(known.__getitem__, pieces))
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return np.frombuffer(out, np.uint32)


@contextmanager
def encoder(path: str) -> Iterator[Encoder]:
    """The encoder of this worker process. It remembers pieces from task to task, but gives
    the memory back when no task has used it for IDLE seconds: workers outlive a stage."""
    found = kept(f"encoder of {path}", lambda: Encoder(path))
    if found.timer is not None:
        found.timer.cancel()
        found.timer.join()
    try:
        yield found
    finally:
        found.timer = threading.Timer(IDLE, found.forget)
        found.timer.daemon = True
        found.timer.start()
