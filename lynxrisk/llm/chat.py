"""Chat formatting of dialogues with several parties, once from each participant's view.

For every participant the dialogue is rendered with that speaker as the assistant and the others as named users. The mask has the
spans that are to be learned: the assistant's words and the end mark after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the format.
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"

#: Most turns of one rendered piece.
PIECE_TURNS = 256


def _turns(pieces: Column, speaker: Column) -> Column:
    """Each turn from the speaker's view: rendered text, length of its head, whether it is the assistant's."""

    def one(t: Column) -> Column:
        own = t["role"].eqNullSafe(speaker)
        title = (
            F.when(own, F.lit("assistant"))
            .when(t["role"].eqNullSafe(F.lit(SYSTEM)), F.lit(SYSTEM))
            .otherwise(F.concat(F.lit("user name="), F.coalesce(t["role"], F.lit(UNKNOWN))))
        )
        head = F.concat(F.lit(START), title, F.lit("\n"))
        return F.struct(F.concat(head, t["text"], F.lit(END + "\n")).alias("all"), F.length(head).alias("head"), own.alias("own"))

    return F.transform(pieces, one)


def rotate(turns: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """(conv_id, speaker, piece, n_turns, text, spans): every dialogue from every participant's view.

    ``turns`` has conv_id, turn (a whole number), role (the speaker) and text. Participants are all different roles but null and ``system``,
    which are rendered (null as a user named unknown) but have no view. Turns come in the order of turn (null last), role, text; repeated rows
    are repeated turns. A null text is empty, and ``<|`` in a text becomes ``< |``, so no text can end its turn. A dialogue without a
    participant has no view. Rows with a null conv_id are one dialogue.

    ``spans`` are start and end (code points, end exclusive) of what is to be learned in ``text``. A long dialogue is rendered in pieces: a piece has the
    turns whose numbers lie in the same ``piece_turns`` wide range, and further pieces begin where turn numbers repeat so often that these are
    more than that. So no row and no task ever holds a dialogue whole. ``piece`` counts a dialogue's pieces from 0, in order.
    """
    clean = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    )
    wide = F.coalesce(F.floor(F.col("turn") / piece_turns).cast("long"), F.lit((1 << 63) - 1))
    in_range = clean.withColumn("range", wide)
    order = Window.partitionBy("conv_id", "range").orderBy(F.col("turn").isNull(), "turn", F.col("role").isNull(), "role", "text")
    placed = in_range.withColumn("at", F.row_number().over(order) - 1).withColumn("part", F.floor(F.col("at") / piece_turns).cast("long"))
    pieces = placed.groupBy("conv_id", "range", "part").agg(F.array_sort(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    numbered = pieces.withColumn("piece", F.row_number().over(Window.partitionBy("conv_id").orderBy("range", "part")) - 1)

    people = clean.filter(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    views = numbered.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).withColumn("seen", _turns(F.col("turns"), F.col("speaker")))

    place = lambda a, t: F.struct(
        (a["at"] + F.length(t["all"])).alias("at"),
        F.when(t["own"], F.array_append(a["spans"], F.struct((a["at"] + t["head"]).alias("start"), (a["at"] + F.length(t["all"]) - 1).alias("end"))))
        .otherwise(a["spans"])
        .alias("spans"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.aggregate("seen", F.struct(F.lit(0).alias("at"), none.alias("spans")), place, lambda a: a["spans"])
    return views.select("conv_id", "speaker", "piece", F.size("turns").alias("n_turns"), F.array_join(F.transform("seen", lambda t: t["all"]), "").alias("text"), spans.alias("spans"))
