"""The memo of chunks against the tokenizers library, over changes of its generation, and what plain text isn't searched for."""

from __future__ import annotations

import random
from array import array

from public_tokenizers import path

from pulsegrid.llm import _wordcache


def test_plain_text_is_not_searched_by_patterns(monkeypatch):
    class Never:
        def search(self, text):
            raise AssertionError("a pattern was searched for")

    monkeypatch.setattr(_wordcache, "_RARE_SPACE", Never())
    assert _wordcache.CachedByteBpe.pieces("one two\nthree") == ["\0one", "two", "\nthree"]


def test_ids_equal_the_library_over_generations():
    from tokenizers import Tokenizer

    library, rng = Tokenizer.from_file(path("byte_bpe_50k.json")), random.Random(4)
    spaces = [" "] * 30 + ["\n", "\t", "\r\n", "\x1c", " ", "  ", " \n", " ", "\x85"]
    words = ["".join(rng.choices("abcdeéüß漢1'.,", k=rng.randint(1, 6))) for _ in range(400)]
    texts = ["".join(w + rng.choice(spaces) for w in rng.choices(words, k=rng.randint(0, 30))).strip(" ") for _ in range(600)]
    for most in (40, 2000, 1_000_000):
        memo = _wordcache.CachedByteBpe(path("byte_bpe_50k.json"), most)
        for k in range(0, len(texts), 7):
            for text, ids in zip(texts[k : k + 7], memo.encode_all(texts[k : k + 7])):
                assert ids == array("I", library.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)


def test_equal_chunks_of_a_batch_are_looked_up_once():
    from tokenizers import Tokenizer

    class Counted(dict):
        looked_up = 0

        def get(self, key, default=None):
            Counted.looked_up += 1
            return super().get(key, default)

    library, memo = Tokenizer.from_file(path("byte_bpe_50k.json")), _wordcache.CachedByteBpe(path("byte_bpe_50k.json"))
    memo._memo = Counted()
    texts = ["", "one two\nthree " + "two one " * 300 + "end", "a  b\t\n c", "x\0y", "  ", "é two ü", "\ntwo", "one"] * 2
    assert memo.encode_all(texts) == [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert 5 < Counted.looked_up < 40
    assert memo.encode_all([]) == [] and memo.encode_all(["", ""]) == [b"", b""]
