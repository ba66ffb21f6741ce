"""Units that the library's model encodes without its other steps."""

import random

import numpy as np
from tokenizers import Tokenizer

from wattline.llm import queries, token_files


def test_simple_units_go_to_the_model_alone(monkeypatch):
    library, units = Tokenizer.from_file(queries.VOCABULARY), token_files.Units(queries.VOCABULARY)
    texts = ["words, Words! 123abc (x) étrepale&&& 7.5\nnext-line {a_b}", "é ÀſĀ×", "a", "", "two\nwords"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    whole = []
    monkeypatch.setattr(units, "ids", lambda text, real=units.ids: whole.append(text) or real(text))
    assert [np.frombuffer(g, "<u4").tolist() for g in units.encode(texts)] == want
    assert whole == [" ÀſĀ×", ""]  # a sign beyond ASCII, and the empty text


def test_odd_units_are_the_library_ids(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT", 500)
    library, units = Tokenizer.from_file(queries.VOCABULARY), token_files.Units(queries.VOCABULARY)
    rng = random.Random(3)
    signs = [*"abAZ019'.,#&!_-`{}~[]@/:; \n\t", *"éÀßñĀŁſ×÷ªµº²½ɐʼ日本ไعӓ🙂̀\u0085​　\x00\x7f", " the", "'s", "'ll"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(rng.choices("abéZ09.,#'  \n", k=rng.randrange(40))) for _ in range(3000)]
    texts += [f"a{c}b {c} 1{c}2 .{c}, {c}{c}" for c in map(chr, range(33, 0x250))]
    got = [g for at in range(0, len(texts), 100) for g in units.encode(texts[at : at + 100])]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert units.old  # the cache was renewed meanwhile
