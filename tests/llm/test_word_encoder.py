"""The word encoder against the whole tokenizer, with each piece of a word encoded once."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from secflow.llm import packing

TEXTS = ["The cat's hat. THE Cat, (1999) don't -- \"...\" 'quoted' x_1 <|end|> naïve Übergröße éé I'LL 'S 's S s ' \" 42 4 2",
         "", " \t\n ", "İstanbul ıssız é ́ 漢字 a b ​ zero<|x|> cat's. hat., .,", "hat the (( ( '( 'll ll"]


def test_ids_are_those_of_the_tokenizer(monkeypatch):
    plain = Tokenizer.from_file(packing.TOKENIZER)
    for kept in (800_000, 3):  # also with a cache that is emptied again and again
        monkeypatch.setattr(packing, "_WORDS_KEPT", kept)
        encoder = packing.WordEncoder(packing.TOKENIZER)
        for text in [*TEXTS, *reversed(TEXTS)]:
            assert encoder.ids(text.encode()).tolist() == plain.encode(text, add_special_tokens=False).ids
            assert encoder.ids(text.encode()).dtype == np.uint32


def test_pieces_are_encoded_once_and_kept():
    encoder = packing.WordEncoder(packing.TOKENIZER)
    asked, model = [], encoder.tokenize
    encoder.tokenize = lambda shown: asked.append(shown) or model(shown)
    for text in ("Cat's hat.", "cat HAT 's .", "CAT hat"):
        encoder.ids(text.encode())
    assert sorted(asked) == ["'s", ".", "cat", "hat"]
    assert packing.encoder_of(packing.TOKENIZER) is packing.encoder_of(packing.TOKENIZER)
