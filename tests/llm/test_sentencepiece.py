import random

import public_tokenizers
import pytest
import sentencepiece as library
from hypothesis import given, settings
from hypothesis import strategies as st

from talmir.llm import sentencepiece as own

PATH = public_tokenizers.path("piece_bpe_32k.model")


def as_unigram(data):
    """The same vocabulary with the model type set to unigram."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(data)
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        if piece.type == 1:  # scores in proportion to ranks, as logarithms
            piece.score = -5.0 - (min(-piece.score, 40000.0) ** 0.5) / 20
    return model.SerializeToString()


@pytest.fixture(scope="module", params=["bpe", "unigram"])
def pair(request):
    data = open(PATH, "rb").read()
    if request.param == "unigram":
        data = as_unigram(data)
    return own.parse_model(data), library.SentencePieceProcessor(model_proto=data)


TEXTS = [
    "", " ", "   two  spaces ", "The quick brown fox.", "ünïcödé ça été", "\n\nlines\r\n\ttabs", "1234567 89",
    "日本語のテキスト 漢字", "emoji \U0001f600\U0001f9d1‍\U0001f680 end", "a" * 700, "ab" * 300 + " c",
    "▁ literal", "x\u0000y", "internationalisation unhappiness", "word " * 50, "<s> </s> <0x0A>",
]


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library_encodes(pair, text):
    model, known = pair
    ids = own.Encoder(model).encode([text])[0]
    assert ids == known.encode(text)
    assert own.decode(model, ids) == known.decode(ids)


MODEL, KNOWN = own.read_model(PATH), library.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeéñ the ingß▁.\n12漢😀 "), max_size=60))
def test_any_text(text):
    assert own.Encoder(MODEL).encode([text])[0] == KNOWN.encode(text)


def test_long_words_merge_to_the_same(pair):
    model, _ = pair
    draw = random.Random(1)
    word = "".join(draw.choices("abcdeingthro", k=250))
    assert own._merges_of_long(model, word) == own._merges(model, [word])[0]


def test_columns(spark):
    pieces = own.Pieces(spark, PATH)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (0, "")]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    coded = df.select("doc_id", "text", pieces.encode(df["text"]).alias("ids"))
    found = coded.select("*", pieces.decode(coded["ids"]).alias("back")).collect()
    known = library.SentencePieceProcessor(model_file=PATH)
    assert len(found) == len(rows)
    for row in found:
        assert row.ids == known.encode(row.text or "")
        assert row.back == (row.text or "").replace("▁", " ")
