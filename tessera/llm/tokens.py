"""Token ids of whole texts, encoded once per distinct word inside a task.

The byte-level BPE vocabulary never merges across a space that stands before a
non-space character, so a text splits there into independent words.  A task
keeps the ids of the words it has met (a bounded cache) and encodes the new
words of a batch in one call.  A text in which a space is followed by white
space is encoded in one piece instead, as the split would not be safe there.
Ids are those of the ``tokenizers`` file; ``tests/llm`` holds them against it.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: Id that ends every document.
END_ID = 2
#: Longest piece of a document, and capacity of a sequence.
MAX_TOKENS = 1024
#: Distinct words kept by a worker before it starts afresh.
CACHE_WORDS = 600_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Words(dict):
    """Word after a space -> its ids as little-endian bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        if not word or word[0].isspace():
            raise LookupError(word)  # not a safe place to split
        ids = self[word] = self.encode(" " + word).tobytes()
        return ids


class Encoder:
    """Texts -> id arrays for one vocabulary file."""

    def __init__(self, vocabulary: str):
        import tiktoken
        from public_tokenizers import PATTERN

        ranks = os.path.splitext(vocabulary)[0] + ".tiktoken"
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=table,
                                      special_tokens={})
        self._starts = np.zeros(max(table.values()) + 1, bool)
        self._starts[[i for token, i in table.items() if token.startswith(b" ")]] = True
        self._words = _Words(self._encode)
        with open(vocabulary, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        odd = [t["content"] for t in added
               if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if odd:
            raise ValueError(f"added tokens that match by other rules than their string: {odd}")
        # The leftmost, then the longest string counts.
        strings = sorted((re.escape(t["content"]) for t in added), key=len, reverse=True)
        self._added = re.compile(f"({'|'.join(strings) or '(?!)'})")
        self._added_ids = {t["content"]: np.array([t["id"]], "<u2").tobytes() for t in added}

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self._bpe.encode_ordinary(text), dtype="<u2")

    def _learn(self, split: list[list[str]]) -> None:
        """Encode the batch's unknown words in one call."""
        words = self._words
        if len(words) > CACHE_WORDS:
            words.clear()
        fresh = set()
        for parts in split:
            fresh.update(parts[1:])
        # A word with white space inside or none at all is left to the single path.
        fresh = [w for w in fresh.difference(words) if len(w.split()) == 1 and w == w.strip()]
        if fresh:
            ids = self._encode(" " + " ".join(fresh))
            cuts = np.flatnonzero(self._starts[ids])
            if len(cuts) == len(fresh):
                raw, ends = ids.tobytes(), [*(2 * cuts[1:]).tolist(), 2 * len(ids)]
                start = 0
                for word, end in zip(fresh, ends):
                    words[word] = raw[start:end]
                    start = end

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, END_ID appended; None counts as empty."""
        cut = [self._added.split(t or "") for t in texts]  # text, added token, text, ...
        split = [[part.split(" ") for part in parts[::2]] for parts in cut]
        self._learn([words for parts in split for words in parts])
        end = np.array([END_ID], "<u2").tobytes()
        for parts, words in zip(cut, split):
            raw = [self._joined(parts[0], words[0])]
            for token, text, inner in zip(parts[1::2], parts[2::2], words[1:]):
                raw += self._added_ids[token], self._joined(text, inner)
            yield np.frombuffer(b"".join([*raw, end]), "<u2")

    def _joined(self, text: str, words: list[str]) -> bytes:
        """The ids of a text without added tokens, given split at its spaces."""
        try:
            head = self._encode(words[0]).tobytes() if words[0] else b""
            return head + b"".join(map(self._words.__getitem__, words[1:]))
        except LookupError:
            return self._encode(text).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def in_runs(texts: Iterable[str | None], most: int = 1 << 20) -> Iterator[list[str | None]]:
    """Runs of texts of about *most* characters, so that memory stays bounded."""
    run, n = [], 0
    for text in texts:
        run.append(text)
        n += len(text or "")
        if n >= most:
            yield run
            run, n = [], 0
    if run:
        yield run


def piece_bounds(n: int, most: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of *n* >= 1 ids: all have
    *most* ids but the first, which takes the remainder."""
    first = n % most or most
    return [(0, first)] + [(s, most) for s in range(first, n, most)]
