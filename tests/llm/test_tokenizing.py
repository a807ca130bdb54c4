"""What the tokenizer is asked, and what a worker keeps of it."""

import gc
import weakref

import numpy as np
import pytest

from retalia.llm import packing


@pytest.fixture
def asked(monkeypatch):
    """Texts that are handed to the tokenizer one by one, and weak references to the tokenizers loaded."""
    import tokenizers

    class Watched:
        texts, loaded = [], []

        def __init__(self, inner):
            self.inner = inner
            self.loaded.append(weakref.ref(self))

        @classmethod
        def from_file(cls, path):
            return cls(tokenizers_Tokenizer.from_file(path))

        def encode_batch_fast(self, texts, **options):
            self.texts.extend(texts)
            return self.inner.encode_batch_fast(texts, **options)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    tokenizers_Tokenizer = tokenizers.Tokenizer
    monkeypatch.setattr(tokenizers, "Tokenizer", Watched)
    return Watched


def whole(text):
    from tokenizers import Tokenizer

    path = packing.tokenizer_file()
    return Tokenizer.from_file(path).inner.encode(text, add_special_tokens=False).ids


def words(first, number):
    return [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}éx" for i in range(first, first + number)]


def test_new_words_of_plain_letters_are_one_text(asked):
    text = " ".join([*words(0, 300), *(w.title() + "," for w in words(100, 300)), "DON'T", "３x", "Ǆa", "ÉÀÞ×", "ªº"])
    ids = packing._ids_of(packing.tokenizer_file())(text)
    assert len(asked.texts) < 20
    assert np.frombuffer(ids, "<u4").tolist() == whole(text)


def test_stems_of_the_older_generation_are_not_tokenized_again(asked):
    ids = packing._ids_of(packing.tokenizer_file(), words_kept=200)
    ids(" ".join(words(0, 150)))  # more than half of what is kept: a new generation begins
    del asked.texts[:]
    text = " ".join(w + "," for w in words(0, 90))
    assert np.frombuffer(ids(text), "<u4").tolist() == whole(text)
    assert asked.texts == [","]


def test_tokenizer_and_words_go_with_the_task(asked):
    ids = packing._ids_of(packing.tokenizer_file())
    ids("one two")
    assert asked.loaded[0]() is not None
    del ids
    gc.collect()
    assert asked.loaded[0]() is None
