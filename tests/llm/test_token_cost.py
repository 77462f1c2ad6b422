"""Encoding cuts known words no more and decoding handles whole columns, with the same results."""

import json

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("ahocorasick")
public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from modelwarden.llm import bpe  # noqa: E402
from modelwarden.llm.queries import TOKENIZER  # noqa: E402

FILE = public_tokenizers.path(TOKENIZER)
SPEC = json.load(open(FILE))


def test_a_known_word_is_looked_up_whole():
    model, calls = bpe.Bpe(SPEC), []
    cut, encode_piece = model.pieces, model.encode_piece
    model.pieces, model.encode_piece = lambda t: calls.append(t) or cut(t), lambda t: calls.append(t) or encode_piece(t)
    text = "Hello, wörld's end. It's 3.5 (or 4)!\nhello again," * 3
    first = [model.encode(text) for _ in range(2)][0]
    calls.clear()
    assert model.encode(text) == first and calls == []


def test_words_between_blanks_are_encoded_as_the_library_does():
    tok = Tokenizer.from_file(FILE)
    kinds = [*range(0x530), *range(0x2000, 0x2070), 0x1680, 0x180E, 0x3000, 0xFEFF, 0xE000]
    texts = [f"It'S{chr(c)}'ll a{chr(c)}b 12{chr(c)}{chr(c)}x.{chr(c)} 's, e{chr(c)}́" for c in kinds]
    for cache in (160_000, 20):  # a small cache is turned over all the time
        model = bpe.Bpe(SPEC, cache)
        for _ in range(2):
            for text in texts:
                assert np.frombuffer(model.encode(text), np.int32).tolist() == tok.encode(text, add_special_tokens=False).ids, ascii(text)


def test_names_are_joined_by_column():
    names = pa.array(["a", "", "c", "d e"])
    rows = [[0, 2], None, [], [1], [3, None, -1, 4, 99, 0], [2]]
    ids = pa.array([[7], *rows], pa.list_(pa.int32()))[1:]
    assert bpe.joined_names(ids, names).to_pylist() == ["a c", "", "", "", "d e a", "c"]
    assert bpe.joined_names(ids, pa.array([], pa.string())).to_pylist() == [""] * 6
    got = [b for most in (1, 3, 100) for b in [list(bpe.id_slices(iter([pa.record_batch({"ids": ids})]), "ids", most))]]
    assert all([x for b in some for x in b["ids"].to_pylist()] == rows for some in got) and [len(x) for x in got][2] == 1 and len(got[0]) > len(got[1])


def test_texts_do_not_go_through_the_decoder(spark, sf):
    from modelwarden.llm.queries import op1_bpe

    plan = op1_bpe(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    outer = next(line for line in plan.splitlines() if "MapInArrow" in line)
    assert "decoded" in outer and "text#" not in outer
