import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, syllables: str) -> str:
    parts = syllables.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and white texts, ties, repeated rows, odd
    characters, a very long text."""
    rng = random.Random(5)
    same = prose(rng, 40, "an the er on ti ing")
    rows = [(0, None, None, None, None), (1, "", "en", "a", 0), (2, " \t\n ", "en", "a", 4), (3, same, "en", "a", 1),
            (4, same, "en", "b", 1), (4, same, "en", "b", 1), (None, same, None, None, None), (5, "Σίσυφος İ ß 👩‍👩‍👧 \x1c\x85 é", "de", "a", 2),
            (6, "<|endoftext|> <s>[INST] x [/INST]</s>", "en", "c", 3), (7, prose(rng, 60_000, "ou le è re qu"), "fr", "c", 9),
            (8, "a" * 5000, "en", "c", 5000), (9, "12 34 --", "en", "c", 8), (-3, "The " + same, "en", "c", 8)]
    return rows


@pytest.fixture()
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names operators use inside."""
    df = spark.createDataFrame(odd_rows, DOCS)
    return df.selectExpr("*", "1 AS score", "'x' AS ids", "2 AS kept", "3 AS spans", "4 AS fp", "5 AS label", "6 AS stats",
                         "7 AS text_statistics", "8 AS found", "9 AS n_bytes", "10 AS block", "11 AS held", "12 AS length")


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def corpus(tmp_path_factory, spark):
    """A small folder of tables as the driver ships them, odd rows included."""
    rng, root = random.Random(1), tmp_path_factory.mktemp("corpus")
    voice = {"en": "an the er on ti ing th ou", "de": "sch ung ein er der ß ü en", "fr": "ou le è re qu ai eau é", "es": "ción ar os la do ñ ó ra"}
    shared = prose(rng, 14, voice["en"])
    rows, labels = [], []
    for i in range(400):
        lang = ["en", "en", "de", "fr", "es"][i % 5]
        text = prose(rng, rng.randint(5, 120), voice[lang])
        if i % 9 == 0:
            text = "$$$ ".join(text.split()) + " !!"
        if i % 7 == 0:
            text += " " + shared + " tail"
        if i % 11 == 0 and i:
            text = rows[-1][1]
        rows.append((i, text, lang, f"src{i % 3}", len(text)))
        labels.append((i, int(i % 9 != 0 and not (i % 11 == 0 and i and (i - 1) % 9 == 0)), 0))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)
