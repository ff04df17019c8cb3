from collections import Counter

import numpy as np

from lynxrisk.llm import packing
from lynxrisk.llm.queries import tokenizer_path

from .helpers import docs
from .test_packing import tokenizer


def test_copies_of_a_document_that_is_cut(spark):
    """A mix takes long documents more than once: each copy has all its pieces, equal to the other copy's."""
    long, short = " ".join(f"w{i} x" for i in range(1500)), "a b c"
    rows = [(1, long, "en", "s"), (2, short, "en", "s"), (1, long, "en", "s"), (2, short, "en", "s")]
    pieces = packing.pack(docs(spark, rows), tokenizer_path()).collect()
    for doc_id, text in ((1, long), (2, short)):
        ids = [*tokenizer().encode(text, add_special_tokens=False).ids, 0]
        got = Counter((p.start, tuple(np.frombuffer(p.ids, dtype="<u4").tolist())) for p in pieces if p.doc_id == doc_id)
        assert set(got.values()) == {2}
        assert [x for _, part in sorted(got) for x in part] == ids
