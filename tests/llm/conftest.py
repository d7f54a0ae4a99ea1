import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, n string, kept string, _row string, copies string"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a table of documents from (doc_id, text[, source]), with further columns named like those the operators use."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", "y", "z", "u", "v") for r in rows]
        return spark.createDataFrame(full, COLUMNS)

    return build


PROSE = ("the river ran past old mills and under bridges while children on the bank threw stones into the slow brown water "
         "and counted the rings that spread from every splash until the evening bell called them home to bread and soup")


@pytest.fixture(scope="session")
def prose():
    return PROSE


@pytest.fixture(scope="session")
def awkward(prose):
    """Null, empty and blank texts, one word, a long text, a long word, repeated rows, a repeated id, null ids and sources."""
    words = prose.split()
    long = " ".join(words[(i * 7 + i // 11) % len(words)] + str(i % 97) for i in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, prose), (5, prose), (6, prose, None), (None, prose), (None, None, None),
            (7, long), (8, "q" * 5_000), (9, prose.upper()), (9, "another text under an id that is there already, of some ten words"),
            (10, "\n".join([prose, "short line", prose])), (-3, prose + " and more"), (11, "naïve café ☕   日本語 \x00 end")]
