"""The prefix table against the library, token pairs against real merging, and decoding of any ids."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfsense.llm import pieces

MODEL = public_tokenizers.path(pieces.MODEL)
HARD = [
    None, "", " ", "  ", " \n ", "▁", "▁▁ a", "Hello  world", "  leading", "trailing   ", "a" * 3_000, " " * 500, "ab" * 5_000,
    "<s></s><unk><0x0A>", "\t\x00\x07", "日本語のテキスト、漢字", "😀😀 é ñ", "12345678901234567890", "naïve\r\ncafé\n\n\n", "\U0010ffff",
    "http://example.org/a?b=c&d=%20", "    indented\n\tcode = {x: [1,2,3]}\n", "ſ ﬁ ①", "word " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.vocabulary(MODEL)


def test_hard_texts(spark, library):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string").repartition(3)
    back = pieces.decode(pieces.encode(docs, MODEL), MODEL)
    got = {r.doc_id: (list(r.ids), r.text) for r in back.collect()}
    for i, text in enumerate(HARD):
        ids = library.encode(text or "")
        assert got[i] == (ids, library.decode(ids)), text


def test_documents(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: list(r.ids) for r in pieces.encode(docs, MODEL).collect()}
    for row in docs.collect():
        assert got[row.doc_id] == library.encode(row.text or "")


def test_random_mixtures(library, vocabulary):
    rng = random.Random(11)
    every = sorted(vocabulary.text.values())
    for _ in range(1_500):
        parts = rng.choices(every, k=rng.randint(1, 8))
        text = "".join(p[rng.randint(0, len(p) - 1) :] for p in parts).replace("▁", " ")
        assert np.frombuffer(vocabulary.encode(text), np.int32).tolist() == library.encode(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ae tion s\n  ▁."), st.characters(blacklist_categories=("Cs",))), max_size=80))
def test_any_text(text):
    library, own = test_any_text.library, pieces.vocabulary(MODEL)
    ids = library.encode(text)
    assert np.frombuffer(own.encode(text), np.int32).tolist() == ids


test_any_text.library = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pairs_agree_with_merging(vocabulary):
    rng = random.Random(3)
    tokens = sorted(vocabulary.parts)
    for _ in range(20_000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        whole = vocabulary.merged(vocabulary.text[a] + vocabulary.text[b])[0]
        assert vocabulary.stay_apart(a, b) == (whole == [vocabulary.text[a], vocabulary.text[b]])


def test_most_pieces_are_in_order(vocabulary):
    assert len(vocabulary.in_order) > 0.99 * len(vocabulary.text)


def test_decoding_of_any_ids(spark, library):
    rng = random.Random(9)
    lists = [[rng.randint(0, 400) for _ in range(rng.randint(0, 30))] for _ in range(300)]
    lists += [[1, 1, 28705, 28705], [259, 5], [3, 28705, 0, 2, 200, 131, 4], [228, 188], []]
    rows = [(i, x) for i, x in enumerate(lists)] + [(len(lists), None), (None, [28705, None, 5])]
    back = pieces.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), MODEL).collect()
    got = {r.doc_id: r.text for r in back}
    for i, ids in enumerate(lists):
        assert got[i] == library.decode(ids), ids
    assert got[len(lists)] == "" and got[None] == library.decode([28705, 5])


def test_empty_table_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([("k", "two rows", 1), ("k", "two rows", 1), (None, "no key", 2)], "doc_id string, text string, ids int")
    encoded = pieces.encode(docs, MODEL)
    assert encoded.columns == ["doc_id", "ids"] and encoded.count() == 3 and encoded.distinct().count() == 2
    assert pieces.decode(pieces.encode(docs.where("false"), MODEL), MODEL).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as source:
        model.ParseFromString(source.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Vocabulary(str(tmp_path / "other.model"))
