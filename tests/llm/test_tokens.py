import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starmart.llm.tokens import Encoder, encoder, tokenizer_file
from tokenizers import Tokenizer

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
TEXTS = st.lists(
    st.text(st.sampled_from(list("ab Zz'sé́\n\t   \x1c.,1!ßΣİ<|>中\x85")), max_size=30),
    max_size=6,
)


def plain(file):
    tokenizer = Tokenizer.from_file(tokenizer_file(file))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def encoded(file, texts):
    ids, offsets = encoder(tokenizer_file(file)).encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


@pytest.mark.parametrize("file", FILES)
@given(texts=TEXTS)
@settings(max_examples=80, deadline=None)
def test_same_ids_as_the_library(file, texts):
    assert encoded(file, texts) == [plain(file)(text) for text in texts]


@pytest.mark.parametrize("file", FILES)
def test_edges(file):
    texts = [None, "", " ", "  ", " a", "a ", "a\n", "a \n b", "<|endoftext|>", "it's  it's", "\n"]
    assert encoded(file, texts) == [plain(file)(text) for text in texts]
    assert encoded(file, []) == []


def test_slices_and_small_capacity():
    small = Encoder(tokenizer_file(FILES[1]), capacity=3)
    for text in ("one two three four", "five six seven", "one nine"):
        (row, ids, offsets), = small.documents(pa.array([text]), end_id=2)
        assert (row, ids.tolist()) == (0, plain(FILES[1])(text) + [2])
        assert offsets.tolist() == [0, len(ids)]
