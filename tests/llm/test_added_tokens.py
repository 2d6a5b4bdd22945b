"""The string of an added token in a text is that token, as the tokenizer of the file has it."""

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tracewell.llm import queries, tokens

END = "<|endoftext|>"


@pytest.mark.parametrize("text", [f"x {END} y", END, f"{END}{END}", f"a{END}b c, d.", f"x {END}", f" {END} \n{END}", "x <|endoftext| > y", "no such string"])
def test_ids_are_those_of_an_untouched_tokenizer(text):
    own, plain = tokens.encoder(queries.tokenizer_file()), Tokenizer.from_file(queries.tokenizer_file())
    got = np.frombuffer(b"".join(own.encode_all(pa.array([text, "after it"]))), f"<u{own.width}").tolist()
    assert got == plain.encode(text, add_special_tokens=False).ids + plain.encode("after it", add_special_tokens=False).ids
    assert got.count(50256) == text.count(END)
