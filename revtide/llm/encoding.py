"""Token ids of whole texts as the tokenizers library gives them, by way of cached words.

The vocabulary ``word_bpe_49k.json`` drops white space and never joins two words that white
space parts, so a text's ids are the ids of its words one after the other. That holds where the
library's case folding and white space agree with Python's: code points below U+0180 but U+0130,
without the control characters U+001C to U+001F and without the vocabulary's special strings.
Any other text goes through the library whole. Words that the cache does not know are encoded
by the library, so the cache never decides a result.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache

VOCABULARY = "word_bpe_49k.json"
#: Words that one Python worker remembers; beyond it the memory starts anew.
CACHE = 700_000

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are kept as little-endian 32-bit numbers")

#: A text with one of these is encoded whole.
OTHER = re.compile("[^\x00-ſ]|[İ\x1c-\x1f]|<\\|")
#: Punctuation marks that form a pre-token of their own when they end a word of letters.
ENDS = frozenset(".,;:!?")


@lru_cache(maxsize=4)
def library(vocabulary: str):
    """The tokenizer, once per Python worker; each worker has one core."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def whole_ids(vocabulary: str, text: str) -> list[int]:
    return library(vocabulary).encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=4)
def _parts(vocabulary: str):
    """The library's byte alphabet and its model."""
    return library(vocabulary).pre_tokenizer[1].pre_tokenize_str, library(vocabulary).model.tokenize


def letter_ids(vocabulary: str, word: str) -> list[int]:
    """Ids of a lower-case word of letters only: one pre-token, so the model alone decides."""
    alphabet, model = _parts(vocabulary)
    return [t.id for t in model(word if word.isascii() else alphabet(word)[0][0])]


class WordIds(dict):
    """Word -> its ids as little-endian unsigned 32-bit bytes.

    A word with a mark at its end is remembered once its letters were seen before, so that rare
    words take one place each.
    """

    def __init__(self, vocabulary: str):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> bytes:
        stem, mark = word[:-1], word[-1]
        if mark in ENDS and stem.isalpha():
            seen = stem in self
            value = self[stem] + self[mark]
            if not seen:
                return value
        else:
            ids = letter_ids(self.vocabulary, word) if word.isalpha() else whole_ids(self.vocabulary, word)
            value = array("I", ids).tobytes()
        if len(self) >= CACHE:
            self.clear()
        self[word] = value
        return value


@lru_cache(maxsize=4)
def word_ids(vocabulary: str) -> WordIds:
    return WordIds(vocabulary)


def text_ids(vocabulary: str, text: str) -> bytes:
    """All ids of a whole text, without added tokens, as little-endian unsigned 32-bit bytes."""
    if OTHER.search(text):
        return array("I", whole_ids(vocabulary, text)).tobytes()
    return b"".join(map(word_ids(vocabulary).__getitem__, text.lower().split()))
