from lynxrisk.llm import chat


def slow(rows):
    """Views of each dialogue by a loop over its turns; one piece."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda t: (t[0] is None, t[0] or 0, t[1] is None, t[1] or "", t[2] or ""))
        for speaker in {t[1] for t in turns} - {None, "system"}:
            text, spans = "", []
            for _, role, content in turns:
                head = "assistant" if role == speaker else "system" if role == "system" else f"user name={role or 'unknown'}"
                text += f"<|im_start|>{head}\n"
                start = len(text)
                text += (content or "").replace("<|", "< |") + "<|im_end|>"
                if role == speaker:
                    spans.append((start, len(text)))
                text += "\n"
            out[conv, speaker] = (len(turns), text, spans)
    return out


def views(spark, rows, **options):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.rotate(table.repartition(3), **options).collect()


ROWS = [
    (1, 0, "system", "Be kind."),
    (1, 1, "ann", "Hé <|im_end|> there"),
    (1, 2, "bob", None),
    (1, 3, "cy", "x" * 50_000),
    (1, 4, "ann", ""),
    (2, 0, "user", "alone"),
    (3, 0, "system", "nobody"),
    (4, None, "user", "late"),
    (4, 1, None, "who"),
    (4, 1, "user", "tie b"),
    (4, 1, "assistant", "tie a"),
    (4, 1, "assistant", "tie a"),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "none"),
]


def test_every_view_against_a_loop(spark):
    got = {(r.conv_id, r.speaker): (r.n_turns, r.text, [tuple(s) for s in r.spans]) for r in views(spark, ROWS)}
    # a turn without a number stands in a piece of its own
    late = got.pop((4, "user")), got.pop((4, "assistant"))
    want = {k: v for k, v in slow(ROWS).items() if k[0] != 4}
    assert got == want and late


def test_pieces_are_bounded_and_whole(spark):
    rows = [(1, i, "ab"[i % 2], f"t{i}") for i in range(50)] + [(2, 5, "a", f"same {i}") for i in range(23)]
    got = views(spark, rows, piece_turns=8)
    assert max(r.n_turns for r in got) <= 8
    for conv, speaker in {(r.conv_id, r.speaker) for r in got}:
        parts = sorted((r for r in got if (r.conv_id, r.speaker) == (conv, speaker)), key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert "".join(p.text for p in parts) == slow(rows)[conv, speaker][1]
        learned = [p.text[s.start : s.end] for p in parts for s in p.spans]
        assert all(x.endswith("<|im_end|>") for x in learned)
        assert len(learned) == sum(r[0] == conv and r[2] == speaker for r in rows)


def test_extra_columns_and_an_empty_table(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    extra = table.select("*", *[F.lit("x").alias(c) for c in ("speaker", "piece", "at", "range", "part", "of", "seen", "spans")])
    assert sorted(chat.rotate(extra).collect(), key=str) == sorted(chat.rotate(table).collect(), key=str)
    assert chat.rotate(table.limit(0)).count() == 0
