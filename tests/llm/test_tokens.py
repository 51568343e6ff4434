"""New words are encoded many at a time, with the library's own ids."""

import public_tokenizers
import pytest

from parcelflow.llm import tokens


def test_new_words_share_a_text():
    own = tokens.UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" ".join(f"wörd{i}x{j}, it's-{j}" for j in range(40)) + "\nend of\tit İ ☃" for i in range(10)]
    given = []

    class Noted:
        def __init__(self, plain):
            self.plain = plain

        def __getattr__(self, name):
            return getattr(self.plain, name)

        def encode_batch_fast(self, units, **options):
            given.extend(units)
            return self.plain.encode_batch_fast(units, **options)

    want = [own.whole(t) for t in texts]
    own.tokenizer = Noted(own.tokenizer)
    assert list(own.encode(texts)) == want
    words = {w for t in texts for w in t.split(" ")}
    assert len(given) < len(words) / 4


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_capital_i_with_a_dot(name):
    """Lower-cased it ends with a combining mark, which joins the marks behind it."""
    own = tokens.UnitEncoder(public_tokenizers.path(name))
    texts = ["aİ<b", 'x İ" y', "İ", "aİb .İ."]
    assert list(own.encode(texts)) == [own.whole(t) for t in texts]


def test_half_a_million_words_are_learned_once(monkeypatch):
    """Words that come again after 480,000 others don't go to the library again."""
    own, given = tokens.UnitEncoder(public_tokenizers.path("byte_bpe_50k.json")), []
    monkeypatch.setattr(own, "_encode_many", lambda units: given.append(len(units)) or [b"0000"] * len(units))
    texts = [" ".join(f"w{i}" for i in range(at, at + 20_000)) for at in range(0, 480_000, 20_000)]
    for text in texts + texts:
        assert len(next(iter(own.encode([text])))) == 80_000
    assert sum(given) < 500_000
