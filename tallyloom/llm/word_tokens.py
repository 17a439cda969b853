"""Token ids by a vocabulary that drops white space, so that texts encode word by word.

The vocabulary's own rules never join characters across a space or a line feed: its normalizer
only composes, folds case and squeezes white space, and its splitting pattern excludes it. Cutting at
these two characters and joining the ids is therefore exact. The pattern also always cuts between a
letter or digit and a final mark such as a comma, where the letter is still one after folding (one folds to a
letter and a combining dot). Each task encodes a word once while it stays
in a bounded table. Tests compare with encoding whole texts.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np

from tallyloom.llm.common import Known, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
WORDS_KEPT = 600_000
FINAL_MARKS = ".,;:!?*#$%&|"
# Code points below this fold case letter by letter, but for the ones left out.
LATIN_END, FOLDS_ODDLY = "ɐ", "İ"


class WordTokens:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = Known(self._encode)
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x80, ord(LATIN_END))]
        self.level = {ord(c): "".join(x for x, _ in level.pre_tokenize_str(c)) for c in letters if c.isalpha()}

    def _encode(self, word: str, known: Known) -> bytes:
        core = word.rstrip(FINAL_MARKS)
        if len(core) < len(word) and core and core[-1].lower()[-1].isalnum():
            return known[core] + known[word[len(core) :]]
        if word.isalpha() and max(word) < LATIN_END and FOLDS_ODDLY not in word and unicodedata.is_normalized("NFC", word):
            tokens = self.model.tokenize(word.lower().translate(self.level))
            ids = [token.id for token in tokens]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def ids(self, texts: list):
        """For each text its ids as little-endian unsigned 32-bit bytes; none for null."""
        for text in texts:
            self.known = self.known.renewed(WORDS_KEPT)
            words = (text or "").replace("\n", " ").split(" ")
            yield b"".join(map(self.known.__getitem__, words))

    def forget(self) -> None:
        """Drop the words met so far: workers outlive a task and go on to other work."""
        self.known = Known(self._encode)

    def lengths(self, texts: list):
        for ids in self.ids(texts):
            yield len(ids) // 4


@lru_cache(maxsize=4)
def word_tokens(path: str | None = None) -> WordTokens:
    """One encoder per worker process; without a path, the machine's copy of the default vocabulary."""
    return WordTokens(path or vocabulary_path(VOCABULARY))
