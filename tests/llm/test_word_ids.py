"""Ids of texts with chat markup, against the library."""

from __future__ import annotations

import numpy as np
import pytest

from windrow.llm import queries
from windrow.llm.word_ids import WordIds


@pytest.mark.parametrize("text", ["<|im_start|> Hello THE", "Hello <| World", "THE <|endoftext|> <|ENDOFTEXT|> The", "École Русский <|x|> naïve"])
def test_capitals_beside_markup(text):
    encoder = WordIds(queries.tokenizer_file("word_bpe_49k.json"))
    (got,) = encoder.packed([text])
    assert np.frombuffer(got, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
