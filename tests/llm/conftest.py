import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977} thing{i * i % 613}" for i in range(20_000))
BASE = " ".join(f"alpha{i} beta" for i in range(60))


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """The shared folder of the session, set for tests alone."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture(scope="session")
def dirty_rows():
    """(doc_id, text, lang, source, n_chars): nulls, empty and very long texts, repeated rows, ties."""
    texts = [
        None, "", "   \n\t ", "one", "one two", "ONE two", BASE, BASE, BASE.upper(), BASE + " gamma delta", LONG,
        "Menu\nhome page\n" + BASE + " zeta", "a b c a b c a b c", "#*$%&|<>\n\n#*$\n#*$", "été ÉTÉ 123  x \x1c y",
        "it's <|endoftext|> we're <|ENDOFTEXT|>", "x\ny\nx\ny", "über öffentlich schön " * 30, "\x00 nul", "😀 " * 40,
    ]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("src", "other", None)[i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, BASE, "en", "src", 5), (None, None, None, None, None)]
    rows += [(100 + i, f"Menu\n  header \nbody {i} " + " ".join(f"w{i}x{j}" for j in range(70)), "en", "src", 1) for i in range(30)]
    return rows


@pytest.fixture(scope="session")
def dirty(spark, dirty_rows):
    """The rows as a table with further columns named like those that operators add."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ("host", "row", "size", "node", "root", "label", "bucket", "shard", "kept", "key", "number", "_text", "target", "`a.b`")
    df = spark.createDataFrame(dirty_rows, schema)
    return df.selectExpr("*", *[f"'x' as {c}" for c in extra]).repartition(3)


@pytest.fixture(scope="session")
def no_rows(dirty):
    return dirty.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
