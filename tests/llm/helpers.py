"""Plain versions of what the operators share."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def docs(spark, rows, schema=SCHEMA):
    """Documents from (doc_id, text[, lang[, source]]) tuples."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, schema)


def clashing(df):
    """The same rows with extra columns that are named like what operators add or use inside."""
    from pyspark.sql import functions as F

    names = "fp fingerprint component_id row key path size source_size target copies unit shard slot block rank sub h1 tokens line words kept n_lines n_removed lang_pred score rejected t id piece".split()
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def groups(pairs, nodes):
    """Connected components by brute force: node -> least node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
