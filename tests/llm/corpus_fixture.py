"""Small corpora with every odd case: nulls, empty and very long texts, ties,
repeated rows, an empty table, extra columns with clashing names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
CLASH = ("score", "predicted", "size", "copies", "fp", "mark", "covered", "u", "bucket", "shard", "row", "tail", "h", "v")


def words(rng, n):
    parts = "an be ca do ed fo ga he in jo ka lo mi no or pa re so ti un".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(seed=1, n=60):
    rng = random.Random(seed)
    base = ["\n".join(words(rng, rng.randint(4, 12)) for _ in range(rng.randint(1, 9))) for _ in range(n)]
    out = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(base)]
    out += [(100, None, None, None, None), (101, "", "en", "s1", 0), (102, " \n\t \n ", "en", "s2", 6),
            (None, base[0], "en", None, len(base[0])), (None, None, None, None, None),
            (103, base[1], "en", "s0", len(base[1])), (104, base[1], "en", "s0", len(base[1])),
            (3, base[3], "en", "s3", len(base[3])), (3, base[3], "en", "s3", len(base[3])),   # repeated rows
            (4, "another text with the same id", "en", "s0", 29),
            (105, "word " * 60_000, "en", "s1", 300_000), (106, "x" * 200_000, "en", "s1", 200_000),
            (107, "été à la plage, ñandú über   \U0001f600 straße", "fr", "s2", 40),
            (108, "\x00 null byte\x0b and \x0c control\x1f", "en", "s2", 30)]
    return out


def frame(spark, data=None, clash=False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASH:
            df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def labels(spark, data):
    return spark.createDataFrame(data, "doc_id long, quality int, toxic int")
