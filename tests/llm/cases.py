"""Fixtures shared by the operator tests: awkward rows and brute-force versions."""
import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def awkward_docs(seed=0, n=60):
    """Nulls in every column, empty and long texts, repeats inside and across
    documents, repeated rows, odd white space, wide characters."""
    rng = random.Random(seed)
    vocabulary = ["ab", "cde", "f", "ghé", "日本", "x" * 40, "kl'm", "zz,", "q|r"] + [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = [(900, None, None, None, None), (901, "", "en", "s1", 0), (902, " \t\n\x0b\x0c\r ", "en", "s1", 7),
            (None, passage, "en", "s2", None), (None, passage, "en", "s2", None), (903, "a" * 300, "en", "s3", 300),
            (904, "a" * 299 + "b", None, "s3", 300), (905, "ab ab ab " * 200, "en", None, 5),
            (906, " ".join(rng.choice(vocabulary) for _ in range(6000)) + passage, "en", "s1", 1),
            (907, "one\u00a0word two\u2003words <|endoftext|> end", "en", "s4", 1)]
    for i in range(n):
        parts = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))]
        if rng.random() < .4:
            at = rng.randrange(len(parts))
            parts[at:at] = passage.split()[rng.randrange(20):rng.randrange(35, 60)]
        text = rng.choice([" ", "  ", "\n"]).join(parts) if rng.random() < .5 else " ".join(parts)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s1", "s2", "s5", None]), len(text)))
    rows += [(1000 + i, rows[10 + 3 * i][1], "en", "s2", 1) for i in range(8)]
    rows += [rows[12], rows[12], rows[15]]
    own = next(r for r in rows if r[0] == 7)  # rows with one id and different texts
    rows += [(7, "front words " + (own[1] or ""), "en", "s1", 1), (7, passage, "en", "s1", 1)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def words(text):
    return (text or "").encode().split()
