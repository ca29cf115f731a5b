import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from starmart.llm import language

FOLDER = "/root/testdata/sf0.01"


@given(st.text("abc", max_size=40), st.text("abcd", max_size=30))
def test_phrases_are_greedy_longest_matches(learned, text):
    automaton, at, count = language.SuffixAutomaton(learned), 0, 0
    while at < len(text):
        length = 1
        while at + length < len(text) and text[at : at + length + 1] in learned:
            length += 1
        at, count = at + length, count + 1
    assert automaton.phrases(text) == count


@pytest.fixture
def learned(documents):
    rows = [(i, "the cat and the dog went to the house", "en") for i in range(5)]
    rows += [(i, "der hund und die katze gehen nach hause", "de") for i in range(5, 10)]
    rows += [(20, None, "fr"), (21, "123", "fr"), (22, "nobody says", None)]
    return language.learn(documents(rows), F.lit(True))


def test_copies_take_one_place_and_short_languages_cut_no_other(documents):
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}{c}" for c in "abcdefgh") for i in range(100)]
    rows = [(i * 50 + k, ("", "! ")[k % 2] + text, "en") for i, text in enumerate(texts) for k in range(50)]
    rows += [(6000, "kurz", "de")]
    learned = language.learn(documents(rows), F.lit(True))
    assert learned["de"] == " kurz "
    assert sum(text in learned["en"] for text in texts) == 40
    found = language.identify(documents(list(enumerate(texts))), learned).collect()
    assert {r.lang_pred for r in found} == {"en"}


def test_learning_reads_texts_to_their_end(documents):
    """Letters only behind 3,000 blanks and digits, and in the rest of a text."""
    rows = [(1, "1 " * 1500 + "bonjour le monde", "fr"), (2, "hello world " * 130 + "zebra", "en")]
    learned = language.learn(documents(rows), F.lit(True))
    assert "bonjour le monde" in learned["fr"] and "zebra" in learned["en"]


def test_edges(documents, learned):
    assert list(learned) == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 %"), (4, "The DOG!"), (5, "die Katze"), (None, "the house")]
    rows += [(6, "the " * 50_000), (4, "The DOG!")]
    got = [(r.doc_id, r.lang_pred) for r in language.identify(documents(rows), learned).collect()]
    expected = [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (None, "en"), (6, "en"), (4, "en")]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_nothing_learned_and_empty_table(documents, learned):
    rows = language.identify(documents([(1, "text")]), {}).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]
    assert language.identify(documents([]), learned).count() == 0
    assert language.learn(documents([]), F.lit(True)) == {}


def test_rows_with_a_language_stay(documents, learned):
    docs = documents([(1, None), (2, "the cat"), (3, "...")])
    kept = language.keep_identified(docs, learned)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_held_out_accuracy(spark):
    from starmart.llm.queries import QUERIES

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op8_cross_parsing_language"](spark, FOLDER).join(docs, "doc_id")
    rows = found.filter("held_out").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
