"""The contract's tokenizers file decides, its added tokens included."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ticklore.llm import packing


@pytest.mark.parametrize("text", ["<|endoftext|>", "a b<|endoftext|> c  <|endoftext|><|endoftext|>\n\n d", "x <|endoftext|", "  <|endoftext|>  y"])
def test_added_token(text):
    made = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert np.frombuffer(packing.encoder(None).ids(text), np.uint16).tolist() == made.encode(text, add_special_tokens=False).ids
