"""The encoder of token records: which words it has to search, and which it forgets."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from ledgerlens.llm import tokens_file

MODEL = tokens_file.model_text(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(found, width):
    return [np.frombuffer(b, f"<u{width}").tolist() for b in found]


def library_ids(texts):
    from tokenizers import Tokenizer

    return [e.ids + [tokens_file.END_ID] for e in Tokenizer.from_str(MODEL).encode_batch(texts, add_special_tokens=False)]


class Unused:
    def findall(self, word):
        raise AssertionError(f"parts of {word!r} were searched for")


def test_words_of_letters_need_no_search_for_parts(monkeypatch):
    texts = ["Plain words, of letters: and signs!", "Ein schöner Tag. Straße\tÜber\x0bº", "", " \n "]
    encoder = tokens_file._Encoder(MODEL)
    monkeypatch.setattr(tokens_file, "_PART", Unused())
    assert ids_of(encoder(texts), encoder.width) == library_ids(texts)


@pytest.mark.parametrize("most", [0, 1, 7, 1000])
def test_words_forgotten_within_a_text_are_right(monkeypatch, most):
    monkeypatch.setattr(tokens_file, "REMEMBERED", most)
    r = np.random.default_rng(2)
    words = ["it's", "We'll", "a1b2", "x\x1cy", "x\x85y", "x\xa0y", "don't.", "İ", "ß.", "<|endoftext|>", "日本", "..", "Q?", "é", "K", "naïve,"]
    texts = [" ".join(words[k] for k in r.integers(0, len(words), 30)) for _ in range(60)]
    encoder = tokens_file._Encoder(MODEL)
    assert ids_of(encoder(texts), encoder.width) == library_ids(texts)
