import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n, syllables):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text, lang, source) rows, with columns that clash with working names."""

    def make(rows, extra=False, parts=3):
        full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)
        if extra:
            from pyspark.sql import functions as F

            names = ("__row", "__number", "__handle", "node", "bucket", "size", "kept", "label", "s", "at", "score", "lang_pred")
            df = df.withColumns({n: F.lit(f"own {n}") for n in names})
        return df

    return make


@pytest.fixture(scope="session")
def corpus():
    """Invented prose in two languages with copies, near copies, shared lines, odd texts, nulls and repeats."""
    rng = random.Random(5)
    sounds = {"aa": ["ka", "lo", "mi", "ten", "sur"], "bb": ["zö", "pfu", "grä", "sch", "wik"]}
    rows = []
    for i in range(160):
        lang = "aa" if i % 3 else "bb"
        lines = [words(rng, rng.randint(3, 30), sounds[lang]).capitalize() + "." for _ in range(rng.randint(1, 8))]
        rows.append([i, "\n".join(lines), lang, f"src{i % 4 if i % 2 else 0}"])
    shared = rows[7][1].split("\n")[0]
    for i in range(160, 200):  # copies and near copies of three documents, and a line that many share
        base, lang = rows[(i % 3) + 20][1:3]
        if i % 2:
            place = rng.randrange(len(base))
            base = base[:place] + rng.choice(["x", "", "yy"]) + base[place + 1 :]
        if i % 5 == 0:
            base = shared + "\n" + base
        rows.append([i, base, lang, "src1"])
    rows += [
        [200, None, "aa", "src0"], [201, "", None, None], [202, " \n\t ", "bb", "src2"], [203, "12345 !!", "aa", None],
        [204, "ka", "aa", "src3"], [205, "lo mi ka ten " * 12_000, "aa", "src3"], [206, "x" * 40_000, None, "src3"],
        [None, "ka lo mi ten sur ka", "aa", "src1"], [5, rows[5][1], rows[5][2], rows[5][3]], [5, rows[6][1], rows[6][2], "src9"],
    ]
    return [tuple(r) for r in rows]
