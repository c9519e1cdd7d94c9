"""Small tables for the training-data operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Documents with extra columns whose names operators might use themselves.
CLASH = DOCS + ", score double, component_id long, _key string, size long, fp long, key string, seeds string, rejected int, copies int, taken int, kept string"
ODD_TEXTS = [None, "", "   ", "a", "a b", "\n\t", "123", "!!! ???", "中文 文字", "naïve Émile", "x" * 5_000, "word " * 3_000]


def odd_docs(spark, extra=True):
    """Odd texts, each twice, some with null ids, repeated ids, null languages and sources."""
    rows = []
    for i, text in enumerate(ODD_TEXTS):
        rows.append((i, text, "en" if i % 2 else None, "s" if i % 3 else None, None))
        rows.append((100 + i, text, "en", "t", 0))
    rows += [(5, "a b", "de", "s", 3), (5, "a b", "de", "s", 3), (None, "null id text here now", "de", "s", 1), (None, None, None, None, None)]
    if not extra:
        return spark.createDataFrame(rows, DOCS)
    return spark.createDataFrame([r + (0.5, 1, "k", 2, 3, "k", "s", 1, 1, 1, "y") for r in rows], CLASH)


def no_docs(spark):
    return spark.createDataFrame([], CLASH)


def prose(seed, words, vocabulary=4_000):
    """Words of a small vocabulary, some of them frequent."""
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(20) if r.random() < 0.3 else r.randrange(vocabulary)}" for _ in range(words))


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
