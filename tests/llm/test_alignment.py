import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lynxrisk.llm import alignment
from lynxrisk.llm.queries import QUERIES

from .helpers import clashing, docs

FOLDER = "/root/testdata/sf0.01"
RANKS, JSON, PIECES = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute(rows):
    """Links and groups by walking both lists of spans, token by token."""
    a_tokens = Tokenizer.from_file(JSON)
    a_tokens.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = alignment.byte_letters()
    out, counts = [], Counter()
    for d, text in rows:
        a = a_tokens.encode(" " + text, add_special_tokens=False) if text else None
        b = model.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in t) for t in a.tokens] if a else []
        b_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in b)]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            out.append((d, None))
            continue
        a_ids = a.ids
        ends_a, ends_b = (np.cumsum([len(t) for t in ts]).tolist() for ts in (a_bytes, b_bytes))
        links, first = [], 0
        for i, end in enumerate(ends_a):
            start = end - len(a_bytes[i])
            while ends_b[first] <= start:
                first += 1
            j = first
            while j < len(b) and ends_b[j] - len(b_bytes[j]) < end:
                links.append((a_ids[i], b[j]))
                j += 1
        counts.update(links)
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            ni, nj = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a_ids[i:ni])) + "|" + ",".join(map(str, b[j:nj])))
            i, j = ni, nj
        out.append((d, (len(a_ids), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    full = lambda r: (r[0], r[1], r[2], len(r[3]), sum(counts[x] == most[x[1]] for x in r[3]), sum(counts[x] for x in r[3]), r[4])
    return sorted(((d, *(full(r) if r else (0, 0, 0, 0, 0, 0, ""))) for d, r in out), key=str)


def answer(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert answer(QUERIES["op13_cross_alignment"](spark, FOLDER)) == brute(rows)


@pytest.mark.parametrize("vocabulary", [RANKS, JSON])
@pytest.mark.parametrize("few", [True, False])
def test_edges(spark, monkeypatch, vocabulary, few):
    """Nulls, signs that the pieces' model changes, special strings, repeated rows; counts sent or joined by shuffle."""
    if not few:
        monkeypatch.setattr("lynxrisk.llm.common.SMALL_VALUES", 3)
    rng = random.Random(2)
    odd = " \n\t é漢字🙂́▁<|endoftext|></s>ab12"
    rows = [(i, "".join(rng.choice(odd) for _ in range(rng.randint(1, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "<|endoftext|> <s> plain"), (102, "same text"), (102, "same text"), (103, "a ▁ b"), (104, "  lead and trail  "), (105, " ")]
    assert answer(alignment.cross_align(clashing(docs(spark, rows)).repartition(3), vocabulary, PIECES)) == brute(rows)
    assert alignment.cross_align(docs(spark, rows).limit(0), vocabulary, PIECES).count() == 0


def test_long_texts_in_parts_have_the_same_ids(monkeypatch):
    pieces = alignment.Pieces(PIECES)
    rng = random.Random(4)
    for length in (8, 25):
        monkeypatch.setattr(alignment, "LONG_TEXT", length)
        for _ in range(400):
            text = "".join(rng.choice("ab  \n é漢") for _ in range(rng.randint(1, 120)))
            assert pieces.encode(text).tolist() == pieces.model.encode(text), repr(text)


def test_very_long_texts(spark):
    rows = [(1, "some words and " * 60_000), (2, " " * 300_000), (3, "x" * 60_000), (4, "\n" * 60_000)]
    got = {r.doc_id: r for r in alignment.cross_align(docs(spark, rows), RANKS, PIECES).collect()}
    assert got[1].n_a == 180_001 and got[1].n_links >= max(got[1].n_a, got[1].n_b)
    assert all(got[i].n_groups > 0 for i in (2, 3, 4))


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_gallop_against_bisect(monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(50):
        long = np.array(sorted(rng.sample(range(500), rng.randint(1, 90))))
        short = np.array(sorted(rng.sample(range(500), rng.randint(1, 30))))
        assert alignment.gallop(short, long).tolist() == [bisect.bisect_left(long.tolist(), x) for x in short]
