"""Properties that must hold for any text."""

import unicodedata

import pytest

pytest.importorskip("quire.llm")
import numpy as np  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from quire.llm import lookalikes, nearduplicates, packing, pii, scannoise, splitting  # noqa: E402

TEXT = st.text(alphabet=st.sampled_from("abcοеΑТ１ﬁ²é ́​ \n.-ሰላ።ÄM"), max_size=80)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_canonical_form_is_stable_and_composed(t):
    once = lookalikes.canonical_text(t)
    assert lookalikes.canonical_text(once) == once
    assert once is None or "​" not in once
    assert lookalikes.canonical_text(unicodedata.normalize("NFD", t)) == lookalikes.canonical_text(unicodedata.normalize("NFC", t))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["word ", "End. ", "x" * 37, "\n", "\n\n", "No. 5 ", "ሰላም። "]), max_size=120), st.integers(20, 200))
def test_pieces_give_the_text_again(parts, limit):
    text, overlap = "".join(parts), limit // 5
    by = [splitting.spans(text, x)[:, 1] for x in splitting.LEVELS]
    pieces = splitting.cut_offsets(by, len(text), limit, overlap)
    assert all(z - a <= limit for a, z, _ in pieces)
    assert "".join(text[a + (overlap if i else 0) : z] for i, (a, z, _) in enumerate(pieces)) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=80))
def test_packing_keeps_every_length(lengths):
    boxes = packing.pack_lengths(np.array(lengths), 60)
    assert all(sum(b) <= 60 for b in boxes) and sorted(x for b in boxes for x in b) == sorted(lengths)


@settings(max_examples=100, deadline=None)
@given(TEXT)
def test_element_hashes_count_repetition(t):
    h = nearduplicates.Hashes().of(t)
    assert len(h) == len(nearduplicates.words(t)) == len(set(h.tolist()))


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_nothing_breaks_on_odd_text(t):
    scannoise.clear_lines(t, [tuple(map(frozenset, scannoise._spelled(x))) for x in ("Water Board", "")])
    m = pii.model(str(pii.WEIGHTS))
    for a, z, _ in pii.find(m, [t, "", t + t])[0]:
        assert 0 <= a < z <= len(t)
