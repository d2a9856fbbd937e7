import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stormgrid.llm.token_counts import PrefixCounter, prefix_counts, tokens_before

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = PrefixCounter(PATH, memo_pieces=50)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def check(text):
    counts = COUNTER.counts(text).tolist()
    assert counts == [library(text[:i + 1]) for i in range(len(text))], text


@pytest.mark.parametrize("text", [
    "", " ", "a", "it's we'll they've 're 'x", "a  b   c\n\n d \t e", "x\n\n\n", "  lead", "12 345  67", "<|endoftext|>",
    "ab <|endoftext|> cd<|endoftext|><|endoftext|>", "<|endof", "漢字 😀 é  x  y", "!!?? --- ***", "a" * 60,
    "The quick brown foxes' tails", "\u0085a \x1c b", "naïve café ²³¼ ªº",
])
def test_every_prefix(text):
    check(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab eé's\n\t1!漢<|>", "ing", "the", " the", "<|endoftext|>"]), max_size=12).map("".join))
def test_every_prefix_of_made_up_texts(text):
    check(text)


def test_table(awkward):
    rows = {(r["id"], r["n_chars"]): r for r in prefix_counts(awkward, PATH, [3, 1024]).collect()}
    source = awkward.collect()
    assert prefix_counts(awkward, PATH).count() == len(source)
    for r in source:
        text = r["text"] or ""
        found = rows[r["doc_id"], len(text)]
        assert found["n_bytes"] == len(text.encode()) and found["n_tokens"] == library(text)
        assert len(found["prefix_tokens"]) == 4 * len(text)
        for limit, fits in zip([3, 1024], found["fits"]):
            counts = [tokens_before(found["prefix_tokens"], i) for i in range(len(text) + 1)]
            assert fits == max(i for i, n in enumerate(counts) if n <= limit)


def test_empty_table(nothing):
    assert prefix_counts(nothing, PATH).count() == 0
