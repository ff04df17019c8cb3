import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lynxrisk.llm import packing
from lynxrisk.llm.queries import QUERIES, tokenizer_path

from .helpers import docs


def by_file(text):
    """Ids by the tokenizer file, as they come from it."""
    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a b" + " \n" * 1_000_000 + "c", "x " * 60_000 + "　" * 1_200_000])
def test_long_white_space(text):
    assert next(packing.encoder(tokenizer_path())([text])).tolist() == by_file(text)


MARKED = ["<|endoftext|> a <|endoftext|>", "a<|endoftext|><|endoftext|>b  <|endoftext|> \n", "<|endoftext", "  <|endoftext|>  x\n\n", "<|endoftext|>" + " " * 200_000 + "<|endoftext|>", "plain", ""]


def test_added_tokens_have_their_id():
    assert by_file(MARKED[0]) == [50256, 257, 220, 50256]
    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json"):
        encode = packing.encoder(str(public_tokenizers.path(name)), added=True)
        assert [ids.tolist() for ids in encode(MARKED)] == [by_file(t) for t in MARKED], name


def test_query_gives_the_ids_of_the_tokenizer_file(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(MARKED) if len(t) < 1000]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in QUERIES["op7_best_fit_packing"](spark, str(tmp_path)).collect()}
    assert got == {i: (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())) for i, t in rows for ids in [[*by_file(t), 0]]}
