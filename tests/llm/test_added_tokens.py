"""Texts with an added token of the vocabulary against the library's plain call."""

import numpy as np
from tokenizers import Tokenizer

from wattline.llm import queries, token_files


def test_added_tokens_are_the_library_ids():
    library = Tokenizer.from_file(queries.VOCABULARY)
    mark = "<|endoftext|>"
    texts = [mark, f"end{mark}next", f"end {mark} next", f"a  {mark}\n\n{mark}{mark}b", f"{mark} x\ny", f"y\n{mark}\nz", "<|endoftext", "<|endof text|>", "plain words\nhere", ""]
    texts += [f"word{i} w{i % 7}" + (f"\n{mark}" if i % 3 == 0 else "") for i in range(3 * token_files.CALL)]
    got = token_files.Units(queries.VOCABULARY).encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert want[0] == [50256] and len(want[1]) == 3
