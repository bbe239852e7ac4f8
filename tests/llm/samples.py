"""Hand-made documents for the tests of the training-data operators."""

from pyspark.sql import types as T

SF001 = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
#: Documents plus columns whose names the operators use themselves.
CLASHING = T.StructType([*DOCS.fields, *(T.StructField(n, T.StringType()) for n in ("kept", "digest", "row", "slot", "rate", "__row", "score", "body", "key", "copy"))])


def words(n, seed=0):
    """n invented words, the same for the same seed."""
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(n))


#: Null, empty, blank, short, very long, repeated rows, null ids and ties.
def awkward():
    long = words(30000, 5)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t", "en", "a"), (4, "x", None, "a"), (5, "!!! 123 ...", "en", None),
        (6, long, "en", "b"), (7, long, "en", "b"), (7, long, "en", "b"), (None, long, "en", "b"), (None, None, None, None),
        (8, "é́ 🙂   ﬁ ½", "fr", "c"), (9, words(300, 1), "en", "b"), (10, words(300, 1) + " tail", "en", "b"), (9, words(300, 1), "en", "b"),
    ]
