from __future__ import annotations

from itertools import islice

import numpy as np
import pytest

from pairloom.llm.toxicity import text_terms
from pairloom.llm.words import WINDOW, mapping, windows, word_hashes

LONG = b"x" * (WINDOW + 40_000)
CASES = [b"", b"a", b"a " + LONG, b"a " + LONG + b" b", LONG + b" " + LONG, b" " + LONG + b"  " + LONG + b" c d", b" " * 3 * WINDOW, b"a" + b" " * WINDOW + LONG, b"word " * WINDOW]


@pytest.mark.parametrize("data", CASES)
def test_windows_end_and_lose_nothing(data):
    pieces = list(islice(windows(data), 100))
    assert len(pieces) < 100 and b"".join(pieces) == data
    assert [w for p in pieces for w in p.split()] == data.split()


@pytest.mark.parametrize("data", CASES)
def test_hashes_do_not_depend_on_windows(data):
    assert len(list(islice(windows(data), 100))) < 100
    table = mapping()
    (got,) = word_hashes([data], table)
    each = {w: h[0] for w in set(data.split()) for h in word_hashes([w], table)}
    assert np.array_equal(got, np.array([each[w] for w in data.split()], np.uint64))
    (terms,) = text_terms([data])
    apart = [t[t & 3 == 0] for w in set(data.split()) for t in text_terms([w])]
    assert set(terms[terms & 3 == 0].tolist()) == set(np.concatenate(apart).tolist() if apart else [])
