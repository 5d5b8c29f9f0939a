import array
import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import token_files
from textloom.llm.common import scratch
from textloom.llm.store import open_store
from textloom.llm.tokens import TextEncoder, path_of

WORD = "word_bpe_49k.json"
TRICKY = [
    "", " ", "It's they'll I'D'VE x's", "a\x1cb\x85c d e", "Ça ÉTÉ ß µ ² ½ ª", "é ́x e ́", "<|endoftext|> a<|startoftext|>b <|x",
    "İstanbul ΑΣ ΣΑΣ", "漢字 かな 한글 🙂👍🏽", "x" * 700, "1234 5.6e7 #$%& ***", "﻿bom​zero­soft", "퟿ ﬁ ½",
]


def ids_of(encoder, text):
    return encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def word_encoder():
    return TextEncoder(path_of(WORD))


@pytest.mark.parametrize("name", [WORD, "byte_bpe_50k.json"])
def test_same_ids_as_library(name):
    encoder = TextEncoder(path_of(name))
    assert encoder.by_word == (name == WORD)
    for text in [*TRICKY, " ".join(TRICKY), "\n".join(TRICKY) * 2]:
        assert array.array("I", encoder.encode(text.encode())).tolist() == ids_of(encoder, text), text


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8", max_codepoint=0x24F), st.characters(codec="utf-8")), max_size=60))
def test_any_text(word_encoder, text):
    assert array.array("I", word_encoder.encode(text.encode())).tolist() == ids_of(word_encoder, text)


ROWS = [(3, "Hello world"), (None, "no id"), (1, None), (2, ""), (2, "again"), (2, "again"), (9, "long " * 20000), (-5, "negative é")]


def expected_files(encoder, rows, end):
    out, at = [], 0
    for name, ids in rows:
        whole = [*ids, end]
        out.append((name, at, len(whole), zlib.crc32(array.array("I", whole).tobytes())))
        at += len(whole)
    return out


@pytest.mark.parametrize("width", [16, 32])
def test_round_trip(spark, make, word_encoder, width):
    docs = make([(i, t, "x") for i, t in ROWS], "doc_id long, text string, n_tokens string")
    folder = scratch(spark, "test-token-files")
    manifest = token_files.write_token_files(docs, folder, path_of(WORD), 2, width=width)
    got = [tuple(r) for r in token_files.read_token_files(spark, folder).collect()]
    got.sort(key=lambda r: r[1])
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert [g[0] for g in got] == sorted([i for i, _ in ROWS], key=lambda i: (i is not None, i or 0))
    ids = {(i, t): ids_of(word_encoder, t or "") for i, t in ROWS}
    expected = sorted([(i, *expected_files(word_encoder, [(i, ids[(i, t)])], 2)[0][2:]) for i, t in ROWS], key=key)
    assert sorted([(g[0], *g[2:]) for g in got], key=lambda r: (key(r), r)) == sorted(expected, key=lambda r: (key(r), r))
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    assert manifest["n_tokens"] == sum(g[2] for g in got)
    # The plain files read without this library.
    fs, path = open_store(folder)
    raw = b"".join(fs.open_input_stream(f"{path}/{p['file']}.ids").read() for p in manifest["parts"])
    flat = np.frombuffer(raw, {16: "<u2", 32: "<u4"}[width])
    assert len(flat) == manifest["n_tokens"]
    assert json.loads(fs.open_input_stream(f"{path}/manifest.json").read()) == manifest
    for g in got:
        assert zlib.crc32(flat[g[1] : g[1] + g[2]].astype("<u4").tobytes()) == g[3]


def test_empty_table(spark, make):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_file_rows(docs, path_of(WORD), 2).collect() == []


def test_too_narrow(spark, make):
    docs = make([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="width=32"):
        token_files.write_token_files(docs, scratch(spark, "test-narrow"), path_of(WORD), 70_000)
