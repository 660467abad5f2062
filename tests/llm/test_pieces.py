"""Ids of texts encoded by parts are those of whole texts."""

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sqlyard.llm.common import PieceEncoder, run_hashes

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["", " ", "  a", "a  b ", "\n\na b\tc", "don't we'll", "a<|endoftext|> b", "x  y", "x  y", "é ́a", "ΑΣ Σ", "1 2  3",
       "a \x1c b", "\x85 a", "it's 'sword \'\'s x\'", "a\n\nb", "a \n b", "a\n b", "a\n  b", "(word) 1word2", "ªº µm ×÷", "aж бa", "\xa0\xa0a \xa0b", "A'S", "x  y", "🙂 🙂🙂", "İ I ı", "a\r\n b", "' s", "a 's",
       "She said “hello” to the world ", "你好 C ", "a – b ", "“ x ”  y ", " “word ", "日本 word word ", "… I ", "Ω a b  "]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param)
    return PieceEncoder(path, (1,), most=50), Tokenizer.from_file(path)


def agree(pair, texts):
    mine, library = pair
    for got, whole in zip(mine.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == [*whole.ids, 1]


def test_odd_texts(pair):
    agree(pair, ODD)
    agree(pair, ["".join(ODD), " ".join(ODD), ""])


def test_documents(pair, sf):
    agree(pair, [r[0] or "" for r in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet'").fetchall()])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'.,<|>-aAbé1½ßǅ́ "), st.characters(exclude_categories=["Cs"]))), max_size=4))
def test_any_text(texts):
    for name in FILES:
        agree((PieceEncoder(public_tokenizers.path(name), (1,)), Tokenizer.from_file(public_tokenizers.path(name))), texts)


def test_run_hashes_depend_on_content_and_order():
    h = np.array([1, 2, 3, 1, 2, 3, 3, 2, 1], np.uint64)
    runs = run_hashes(h, 3, 1)[:7]
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 6
