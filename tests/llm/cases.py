"""Documents with everything that may be odd about them."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, key int, copies string, row string, `odd.name` int, text_key string, n int"


def rows(base):
    """(doc_id, text, source) with NULLs in each column, empty and very long texts, ties and repetitions."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
    odd = [
        (900001, None, "src0"), (900002, "", "src0"), (None, "a text without id but with some words in it", "src1"),
        (None, "a text without id but with some words in it", "src1"), (900003, "a text without a source and with words", None),
        (900004, long, "src0"), (900005, " \t\n\x0b\f\r ", "src2"), (900006, "Ünïcode ß words É and \u00a0 spaces\u2028here", "src2"),
        (900007, "same id", "src2"), (900007, "same id other text", "src2"), (900008, "repeated row of words", "src3"),
        (900008, "repeated row of words", "src3"), (900009, "x", "src3"), (None, None, None), (-5, "negative id \x00 with a null byte", "\U0001f600"),
    ]
    return base + odd


def frame(spark, triples):
    data = [(i, t, None if k % 3 else "en", s, None, "x", k, "y", None, k, "z", 1) for k, (i, t, s) in enumerate(triples)]
    return spark.createDataFrame(data, SCHEMA)


def small(spark, directory, n=120):
    """The first documents of the table and the odd ones."""
    found = spark.read.parquet(f"{directory}/documents.parquet").orderBy("doc_id").limit(n).select("doc_id", "text", "source").collect()
    return rows([tuple(r) for r in found])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, triples):
    data = [(i, k % 4 and 1, int(k % 5 == 0)) for k, (i, _, _) in enumerate(triples) if k % 2] + [(None, 1, 0), (1, None, None), (424242, 1, 1)]
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int")


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
