from colophon.llm import lost

SCHEMA = "lemma_id bigint, text string, name string, givenname string"


def test_words_are_filled_from_the_corpus(spark):
    rows = [(1, "één knecht, Müller en Møller", "Müller", "René"), (2, "Müller ging", None, None), (3, "��n knecht van M�ller, Gr�tz en ��", "M�ller", "Ren�"), (4, None, None, None), (None, "��n", "", None), (5, "plain", "x", "y")]
    got = {r.lemma_id: tuple(r)[1:] for r in lost.filled_values(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[3] == ("één knecht van Müller, Gr�tz en ��", "Müller", "René")
    assert got[1] == rows[0][1:] and got[4] == (None, None, None) and got[None] == ("��n", "", None) and len(got) == 6


def test_empty_table(spark):
    assert lost.filled_values(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_field(spark):
    df = spark.createDataFrame([(1, "één"), (2, "��n")], "lemma_id bigint, text string")
    assert sorted(tuple(r) for r in lost.filled_values(df, fields=("text",)).collect()) == [(1, "één"), (2, "één")]
