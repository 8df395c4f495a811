"""The gate before the lattices lets all through that a lattice can rewrite."""

import pytest

from filingspark.llm import toxicity


@pytest.mark.parametrize("text", ["@$$hole", "$7upid", "5+upid", "st***d", "iiddiioott", "s  t  u  p  i  d", "s . t . u", "f--o", "4s", "ÄäX", "1d10t"])
@pytest.mark.parametrize("around", ["%s", "you %s, you", "so\n%s\nsaid"])
def test_gate_takes_all_that_lattices_rewrite(text, around):
    whole = (around % text).encode()
    assert any(text.encode() in whole[s:e] for s, e in toxicity.suspects(whole))


def test_gate_leaves_plain_words():
    assert toxicity.suspects("The plain words, read from an author. Fin".encode()) == []
