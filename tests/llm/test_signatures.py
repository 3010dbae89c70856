"""MinHash signatures of long texts."""

import numpy as np
import pytest

from riskframe.llm import fingerprints
from riskframe.llm.substrings import WordHashes


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_unrelated_long_texts_are_unlike(n):
    rng, hashes = np.random.default_rng(n), WordHashes()
    texts = [" ".join(map(str, rng.integers(0, 10**9, n).tolist())) for _ in range(2)]
    half = " ".join(texts[0].split()[: n // 2] + texts[1].split()[: n // 2])
    own, other, mixed = (fingerprints.signature(fingerprints.shingles(t, hashes)) for t in (*texts, half))
    assert fingerprints.likeness(own, other) < 0.02
    assert abs(fingerprints.likeness(own, mixed) - 1 / 3) < 0.15
