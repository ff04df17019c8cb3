import os
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from lynxrisk.llm import packing
from lynxrisk.llm.queries import tokenizer_path

from .helpers import clashing, docs

ENCODERS = [packing.encoder(str(public_tokenizers.path(f))) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")]


def slow_best_fit(lengths, capacity, most_open):
    """The same rule by looking at every open sequence."""
    open_, places, n = [], [], 0
    for length in lengths:
        fits = [(free, number) for free, number in open_ if free >= length]
        if fits:
            least = min(f for f, _ in fits)
            free, number = next(x for x in reversed(open_) if x[0] == least)
            open_.remove((free, number))
        else:
            free, number = capacity, n
            n += 1
        places.append((number, capacity - free))
        if free - length:
            open_.append((free - length, number))
            if len(open_) > most_open:
                least = min(f for f, _ in open_)
                open_.remove(next(x for x in reversed(open_) if x[0] == least))
    return places


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120), st.integers(1, 6))
def test_best_fit_against_a_plain_loop(lengths, most_open):
    fit = packing.BestFit(30, most_open)
    assert [fit.place(n) for n in lengths] == slow_best_fit(lengths, 30, most_open)
    assert fit.open <= most_open


def test_cut():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)] and packing.cut(4, 4) == [(0, 4)]


def json_path():
    return str(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_ranks_give_the_ids_of_the_tokenizer(text):
    by_rank, by_json = ENCODERS
    assert next(by_rank([text])).tolist() == next(by_json([text])).tolist()


def test_ranks_give_the_ids_of_the_tokenizer_on_given_documents(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    by_rank, by_json = ENCODERS
    assert all((a == b).all() for a, b in zip(by_rank(texts), by_json(texts), strict=True))


def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(json_path())
    t.encode_special_tokens = True
    return t


def check(pieces, rows, capacity):
    """Whole round trip: the ids of every row, and gapless sequences of at most the capacity."""
    t = tokenizer()
    want = sorted((str(d), [*t.encode(x or "", add_special_tokens=False).ids, 0]) for d, x in rows)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, dtype="<u4").tolist()
        assert len(ids) == p.length <= capacity
        by_doc.setdefault(str(p.doc_id), []).append((p.piece, p.start, ids))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    got = []
    for doc_id, parts in by_doc.items():
        ids = []
        for piece, start, part in sorted(parts):
            if piece == 0 and ids:
                got.append((doc_id, ids))
                ids = []
            assert start == len(ids) and (len(part) == capacity or piece == 0)
            ids = ids + part
        got.append((doc_id, ids))
    assert sorted(got) == want
    return len(by_sequence), sum(len(i) for _, i in want)


def test_given_documents_round_trip_and_are_packed_tightly(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000).coalesce(1)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    sequences, tokens = check(packing.pack(table, tokenizer_path()).collect(), rows, 2048)
    assert sequences <= 1.03 * tokens / 2048


def test_edges(spark):
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (None, "no id"), (4, "word " * 20_000), (5, "<|endoftext|> plain"), (6, "é中\U0001f600")]
    rows += [(10 + i, "".join(rng.choice("ab é中\n ") for _ in range(rng.randint(0, 300)))) for i in range(60)]
    check(packing.pack(clashing(docs(spark, rows)).repartition(4), tokenizer_path(), capacity=64, most_open=3).collect(), rows, 64)
    twice = packing.pack(docs(spark, [(7, "same"), (7, "same")]).coalesce(1), tokenizer_path()).collect()
    assert [(p.doc_id, p.piece, p.offset) for p in twice] == [(7, 0, 0), (7, 0, 2)]
    assert packing.pack(docs(spark, []), tokenizer_path()).count() == 0
