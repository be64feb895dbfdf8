"""Operator 7: passages at a text's very start or end that others hold inside."""

import numpy as np

from tessera.llm import repeats

from .test_repeats import _same


def test_padding_is_never_text():
    raw = np.frombuffer(b"x" * 300, np.uint8)
    keys = np.arange(100, dtype=np.int64)
    out, ends = repeats.padded(np.tile(raw, 100), np.arange(101) * 300, keys)
    place = np.arange(len(out)) % ends[1]
    outside = (place < repeats.PAD) | (place >= ends[1] - repeats.PAD)
    assert (out[outside] >= 0xF8).all() and (out[~outside] == ord("x")).all()


def test_passages_at_ends_and_inside(spark):
    rng = np.random.default_rng(11)
    letters = np.array([chr(c) for c in range(32, 127)])
    noise = lambda n: "".join(rng.choice(letters, n))
    rows = []
    for _ in range(48):
        passage = noise(230)
        for _ in range(24):
            rows += [passage + noise(8), noise(8) + passage]
        rows += [noise(9) + passage + noise(9) for _ in range(12)]
    _same(spark, list(enumerate(rows)))
