"""Removing lines that are similar to an earlier line: an exact set-similarity join.

A line's tokens are the hashes of its five-word shingles; lines link at a Jaccard similarity of 4/5 or more. The words of a shorter line are one
token, so that equal short lines are one class.
Tokens are ordered by rarity, so that the first ones of a line (its prefix) are rare. Similar lines share a token of
their prefixes (several, as these are longer than one common token needs), which is where candidates meet; length, position and a parity signature of 256 bits filter them, and
the Jaccard similarity of the whole token sets is verified. Only DataFrame and SQL functions are used.

For 100 TB:

* Lines with the same token set are one class, found by a grouping that combines before the shuffle; a line that
  repeats a million times is one row from there on. A class stands at its first line.
* Tokens stand in the order of their hashes, but for frequent ones, which stand last, by their count. Which are frequent is counted exactly
  where it matters, in the prefixes: only lines with such a token there are ordered anew. So no token is
  joined to its count but those of these lines. The order is the same for all lines; the result doesn't depend on it.
* A large group of similar lines is not expanded into pairs. Only whether a class has *any* earlier similar class matters. So each
  posting of a long list is first compared to the first ones and the last ones before it in its token's list, by window functions. Only classes
  that have found nothing there are joined to all earlier ones. Lists of up to ``NEAR + 2`` postings are joined at once.
* Prefix tokens are counted by a grouping that combines; only those that two classes have go on, and only classes with several of these. Their token
  sets are fetched once, signatures are made of them by a grouping, and to be verified only the sets of classes in a pair are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.llm.common import SPACE, WORD, settle, small_join, text_or_empty, words

SHINGLE = 5
#: Least Jaccard similarity of linked lines, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
#: Prefix tokens of more classes than this are frequent. Shorter lists cost less than ordering their lines anew.
FREQUENT = 1000
#: Numbers of 64 bits in a signature: enough that lines of some hundred words that share a passage differ in more bits than similar ones.
SIGNATURE = 4
#: How many postings before each are looked at without a join, where a token has more than two more than that.
NEAR = 6
#: Similar lines share at least so many tokens of their prefixes; a class that shares fewer with all others has no similar one.
COMMON = 3
#: Classes of fewer tokens have no similar class but themselves: one token more or less is already too far.
LEAST_LINKED = -(-NUMERATOR // (DENOMINATOR - NUMERATOR))


def _long_enough(least_words: int) -> str:
    return f"(?:{WORD}{SPACE}){{{least_words - 1}}}{WORD}"


def lines(docs: DataFrame, least_words: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, line_no, line): lines of at least so many words."""
    # cut first, then explode: a line must not carry its document's text along
    cut = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split(text_or_empty(F.col("text")), "\n", -1).alias("all_lines"))
    parts = cut.select("doc_id", "text_hash", F.posexplode_outer("all_lines").alias("line_no", "line"))
    return parts.filter(F.col("line").rlike(_long_enough(least_words)))


def _shingles(line: Column) -> Column:
    """Hashes of a line's five-word shingles, repeats included; a shorter line's words are one. One expression, so that words are hashed once."""
    hashes = F.transform(words(line), lambda w: F.xxhash64(w))

    def joined(h: Column) -> Column:
        one = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])  # noqa: E731  (words that aren't there are passed over)
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - SHINGLE, F.lit(0))), one)

    return F.get(F.transform(F.array(hashes), joined), 0)


def token_sets(table: DataFrame) -> DataFrame:
    """Lines with ``tokens``: the hashes of their different shingles, in order."""
    return table.withColumn("tokens", F.array_distinct(F.sort_array(_shingles(F.col("line"))))).drop("line")


def _key(tokens: str) -> list[Column]:
    return [F.xxhash64(F.lit(1), tokens).alias("h1"), F.xxhash64(F.lit(2), tokens).alias("h2")]


def _position(doc_id: Column, text_hash: Column, line_no: Column) -> Column:
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), text_hash.alias("text_hash"), line_no.alias("line_no"))


def _spare(n: Column) -> Column:
    """How many tokens of n a similar set may lack. With one more, the first tokens in order have one in common with the other's."""
    return n - F.floor((n * NUMERATOR + DENOMINATOR - 1) / DENOMINATOR).cast("int")


def _prefix(tokens: str) -> Column:
    """The first tokens of an ordered set: so many that COMMON of them are in each similar set's, too."""
    return F.slice(tokens, F.lit(1), _spare(F.size(tokens)) + COMMON)


def line_classes(sets: DataFrame) -> DataFrame:
    """One row for each different token set: id, h1, h2, n, prefix, first (place of its first line)."""
    rows = sets.select(
        *_key("tokens"),
        F.size("tokens").alias("n"),
        _prefix("tokens").alias("prefix"),
        _position(F.col("doc_id"), F.col("text_hash"), F.col("line_no")).alias("first"),
    )
    grouped = rows.groupBy("h1", "h2").agg(
        F.min("first").alias("first"),
        F.first("n").alias("n"),
        F.first("prefix").alias("prefix"),
    )
    return settle(grouped.withColumn("id", F.monotonically_increasing_id()))


def _bit(token: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(token, 32).bitwiseAND(F.lit(63)).cast("int"))


def _signed(token_table: DataFrame) -> DataFrame:
    """(id, first, n, s0 to s3), the signature being parities of the tokens' bits: sets that differ in so many tokens differ in at most so many bits."""
    word = F.shiftrightunsigned("t", 38).bitwiseAND(F.lit(SIGNATURE - 1))
    parity = lambda i: F.bit_xor(F.when(word == i, _bit(F.col("t"))).otherwise(F.lit(0).cast("long")))
    each = token_table.select("id", "first", F.explode("tokens").alias("t"))
    return each.groupBy("id", "first").agg(F.count("*").cast("int").alias("n"), *[parity(i).alias(f"s{i}") for i in range(SIGNATURE)])


def _tokens_of(classes: DataFrame, table: DataFrame) -> DataFrame:
    """(id, first, tokens) of some classes, made again from the classes' first lines, which their places tell."""
    wanted = settle(classes.select("id", F.col("first.doc_id").alias("w_id"), F.col("first.text_hash").alias("w_hash"), F.col("first.line_no").alias("w_line")))
    there = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")) & (F.col("line_no") == F.col("w_line"))
    place = _position(F.col("doc_id"), F.col("text_hash"), F.col("line_no"))
    found = settle(token_sets(small_join(table, wanted, there).select("id", place.alias("first"), "line")))
    if found.count() > wanted.count():  # the input has equal rows
        found = settle(found.dropDuplicates(["id"]))
    return found


def _postings(classes: DataFrame) -> DataFrame:
    return classes.select("id", F.posexplode("prefix").alias("at", "t"))


def _met(postings: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Postings (t, at, id, c) of tokens that c > 1 of n classes have, for classes with at least COMMON of them; and those classes (met_id)."""
    counts = settle(postings.groupBy(F.col("t").alias("shared_t")).agg(F.count("*").alias("c")).filter("c > 1"), rows=n)
    shared = settle(small_join(postings, counts, F.col("t") == F.col("shared_t")).select("t", "at", "id", "c"))
    enough = settle(shared.groupBy(F.col("id").alias("met_id")).count().filter(F.col("count") >= COMMON).select("met_id"), rows=n)
    return small_join(shared, enough, F.col("id") == F.col("met_id"), "left_semi"), enough


def frequent_last(token_table: DataFrame, frequent: DataFrame, n: int | None = None) -> DataFrame:
    """(id, prefix) of all classes of the token table (n at most), where frequent tokens stand last, by their counts."""
    counts = settle(frequent.select(F.col("t").alias("f"), "c").distinct(), rows=n)
    having = settle(frequent.select(F.col("id").alias("having_id")).distinct(), rows=n)
    sets = small_join(token_table, having, F.col("id") == F.col("having_id"), "left")
    ranked = small_join(sets.filter("having_id IS NOT NULL").select("id", F.explode("tokens").alias("t")), counts, F.col("t") == F.col("f"), "left")
    ordered = ranked.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "t"))).alias("all"))
    moved = ordered.select("id", F.transform(_prefix("all"), lambda x: x["t"]).alias("prefix"))
    return settle(moved.union(sets.filter("having_id IS NULL").select("id", _prefix("tokens").alias("prefix"))), rows=n)


def _may_link(x: str, y: str) -> Column:
    """Whether two postings of a token can belong to similar lines: length, position and parity filters."""
    num, den = NUMERATOR, DENOMINATOR
    need = f"ceil(({num}D * ({x}.n + {y}.n)) / {num + den}D)"
    return F.expr(
        f"{num} * greatest({x}.n, {y}.n) <= {den} * least({x}.n, {y}.n)"
        f" AND least({x}.n - {x}.at, {y}.n - {y}.at) + least({x}.at, {y}.at) >= {need}"
        f" AND {' + '.join(f'bit_count({x}.s{i} ^ {y}.s{i})' for i in range(SIGNATURE))} <= {x}.n + {y}.n - 2 * {need}"
    )


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (x, y) whose Jaccard similarity is high enough. Only the token sets of the pairs' classes are moved."""
    ids = settle(pairs.select(F.explode(F.array("x", "y")).alias("in_pair")).distinct(), rows=sets.count())
    few = small_join(sets.select("id", "tokens"), ids, F.col("id") == F.col("in_pair"), "left_semi")
    both = pairs.join(few.select(F.col("id").alias("x"), F.col("tokens").alias("xt")), "x").join(
        few.select(F.col("id").alias("y"), F.col("tokens").alias("yt")), "y"
    )
    common = F.size(F.array_intersect("xt", "yt"))
    union = F.size("xt") + F.size("yt") - common
    return both.filter(common * DENOMINATOR >= union * NUMERATOR).select("x", "y")


def _earlier(postings: DataFrame, others: DataFrame) -> DataFrame:
    """Pairs (x, y) of a class and an earlier one of the others that may be similar, by a join on the token."""
    earlier = F.expr("x.t = y.t AND (y.first < x.first OR (y.first = x.first AND y.id < x.id))")
    return postings.alias("x").join(others.alias("y"), earlier & _may_link("x", "y")).select(F.col("x.id").alias("x"), F.col("y.id").alias("y"))


def _nearest(postings: DataFrame) -> DataFrame:
    """For each posting the likeliest pair (x, y) with the first or one of the last before it in its token's list."""
    posting = F.struct("id", "n", "at", *[f"s{i}" for i in range(SIGNATURE)]).alias("p")
    listed = postings.select("t", "first", posting)
    order = Window.partitionBy("t").orderBy("first", "p.id")
    before = F.array_compact(F.array(F.first("p").over(order.rowsBetween(Window.unboundedPreceding, -1)), *[F.lag("p", k).over(order) for k in range(1, NEAR + 1)]))
    near = listed.select("p", before.alias("before")).filter(F.size("before") > 0)
    fits = F.filter("before", lambda y: _linkable("p", y))
    apart = lambda y: F.struct(_bits_apart("p", y).alias("d"), y["id"].alias("id"))
    best = near.select(F.col("p.id").alias("x"), F.array_min(F.transform(fits, apart)).alias("b")).filter("b IS NOT NULL")
    return best.select("x", F.col("b.id").alias("y"))


def classes_with_earlier(classes: DataFrame, table: DataFrame, n: int | None = None) -> DataFrame:
    """(id) of classes (n, counted here if not given) that have an earlier similar class; ``table`` has the lines."""
    n = classes.count() if n is None else n  # as many rows as a table of classes has at most
    places, met = _met(_postings(classes.filter(F.col("n") >= LEAST_LINKED)), n)
    token_table = _tokens_of(small_join(classes, met, F.col("id") == F.col("met_id"), "left_semi"), table)
    frequent = settle(places.filter(F.col("c") > FREQUENT))
    if not frequent.isEmpty():
        places, met = _met(_postings(frequent_last(token_table, frequent, n)), n)
    signed = _signed(small_join(token_table, met, F.col("id") == F.col("met_id"), "left_semi"))
    shared = settle(places.join(signed, "id").filter(F.col("at") <= _spare(F.col("n"))), rows=n)

    short, long = shared.filter(F.col("c") <= NEAR + 2), shared.filter(F.col("c") > NEAR + 2)
    tried = settle(_earlier(short, short).union(_nearest(long)).distinct())
    found = settle(_similar(tried, token_table).select(F.col("x").alias("id")).distinct(), rows=n)

    rest = settle(_earlier(long.join(found, "id", "left_anti"), long).distinct())
    more = _similar(rest, token_table).select(F.col("x").alias("id")).distinct()
    return settle(found.union(more), rows=n)


def _linkable(x: str, y: Column) -> Column:
    """The filters of _may_link for a posting column and a lambda variable."""
    n, m = F.col(f"{x}.n"), y["n"]
    need = F.ceil((n + m) * F.lit(float(NUMERATOR)) / F.lit(float(NUMERATOR + DENOMINATOR)))
    length = F.greatest(n, m) * NUMERATOR <= F.least(n, m) * DENOMINATOR
    place = F.least(n - F.col(f"{x}.at"), m - y["at"]) + F.least(F.col(f"{x}.at"), y["at"]) >= need
    return length & place & (_bits_apart(x, y) <= n + m - need * 2)


def _bits_apart(x: str, y: Column) -> Column:
    bits = [F.bit_count(F.col(f"{x}.s{i}").bitwiseXOR(y[f"s{i}"])) for i in range(SIGNATURE)]
    return sum(bits[1:], bits[0])


def dedup_lines(docs: DataFrame, least_words: int = SHINGLE) -> DataFrame:
    """All rows and columns, with the text less its lines that are similar to an earlier line, and n_lines, n_removed (long).

    Lines end at \\n. Their order is that of doc_id (null last), then of a hash of the text, then in the text. A line of five words or more (as they stand, capitals count) goes if
    an earlier line, kept or not, of this or another document has the same shingles or a Jaccard similarity of at least
    4/5. A shorter line goes if an earlier one has the same words; lines of fewer than ``least_words`` words stay. At 1, as in
    the query and the pipeline, these are the lines without a word. A document whose lines all go has an empty text. A null text stays null (0 lines). Rows
    that are equal in doc_id and text are one document here: they are treated alike. An empty table gives an empty result. Input columns
    named n_lines or n_removed are replaced.
    """
    table = lines(docs, least_words)
    classes = line_classes(token_sets(table))
    n = classes.count()
    removed = classes_with_earlier(classes, table, n)
    kept = classes.join(removed, "id", "left_anti").select("first.*")
    by_doc = settle(kept.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("kept")).select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), "kept"), rows=n)

    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("row.text") == F.col("kept_hash"))
    joined = small_join(rows, by_doc, same, "left", lists="kept")
    numbered = F.transform(F.split(F.col("row.text").cast("string"), "\n", -1), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    stays = F.filter(
        numbered,
        lambda s: F.coalesce(F.array_contains("kept", s["i"]), F.lit(False)) | ~s["line"].rlike(_long_enough(least_words)),
    )
    cut = joined.select("row", numbered.alias("all_lines"), stays.alias("stay"))
    text = F.array_join(F.transform("stay", lambda s: s["line"]), "\n")
    count = lambda c: F.coalesce(F.nullif(F.size(c), F.lit(-1)), F.lit(0)).cast("long")
    result = cut.select("row.*", text.alias("_text"), count("all_lines").alias("_lines"), (count("all_lines") - count("stay")).alias("_removed"))
    return replace_text(result, docs.columns)


def replace_text(result: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the input in their order, with the new text in place of the old one."""
    kept = [c for c in columns if c.lower() not in ("n_lines", "n_removed")]
    return result.select(
        *[F.col("_text").alias(c) if c == "text" else F.col(f"`{c}`") for c in kept],
        F.col("_lines").alias("n_lines"),
        F.col("_removed").alias("n_removed"),
    )
