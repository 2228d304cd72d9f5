"""Ids of whole texts inside Python workers.

A tokenizer that drops white space and never joins across it gives each word the
same ids in any text, so ids are kept per word and worker, as many as fit in two
stores of a fixed size.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from corpusloom.llm.common import worker_state

WORDS_KEPT = 400_000  # some 150 bytes each, in two stores
_WORDS_A_TEXT = 500
# Runs of these after a letter are tokens of their own in the pattern that is asked for below.
_TRAILING = b".,!?;:#$%&*|"
# Letters up to U+024F, as bytes, but for U+0130, whose lower case has a mark that is no letter.
_LETTER = (
    rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])"
)
_LETTERS, _LETTER_LAST = re.compile(_LETTER + rb"+"), re.compile(_LETTER + rb"\Z")
_LETTERS_APART = (r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+")


class TextIds:
    """Ids of a text as little-endian unsigned bytes, two or four per id as the vocabulary needs."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.words_kept = Tokenizer.from_file(path), words_kept
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        settings = json.loads(self.tokenizer.to_str())
        self.by_word = _splits_at_white_space(settings)
        self.punctuation_apart = self.by_word and set(_LETTERS_APART) <= set(_pattern(settings).split("|"))
        suffix = settings["model"].get("end_of_word_suffix")
        self.last_of_word = None
        if self.punctuation_apart and suffix:
            self.last_of_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.last_of_word[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        # Words of now and of the time before; a word still in use moves over.
        self.now: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype=self.dtype).tobytes() for one in made]

    def _words_encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words; runs of plain letters go in one text, whose ids say where each word ends."""
        together = self.last_of_word is not None
        plain = [word for word in words if together and _LETTERS.fullmatch(word)]
        known = set(plain)
        other = [word for word in words if word not in known]
        made = dict(zip(other, self._encoded([word.decode() for word in other])))
        for at in range(0, len(plain), _WORDS_A_TEXT):
            part = plain[at : at + _WORDS_A_TEXT]
            data = self._encoded([b" ".join(part).decode()])[0]
            ends = (np.flatnonzero(self.last_of_word[np.frombuffer(data, self.dtype)]) + 1) * self.dtype.itemsize
            if len(ends) != len(part):  # some word was not encoded as one
                made.update(zip(part, self._encoded([word.decode() for word in part])))
                continue
            begin = 0
            for word, end in zip(part, ends.tolist()):
                made[word] = data[begin:end]
                begin = end
        return made

    def _core(self, word: bytes) -> bytes:
        """The word without punctuation at its end, where a letter stands before that."""
        core = word.rstrip(_TRAILING)
        return core if core != word and self.punctuation_apart and _LETTER_LAST.search(core) else word

    def _learn(self, words: set[bytes]) -> None:
        now, unknown, cut = self.now, set(), []
        for word in words:
            known = self.before.get(word)
            if known is not None:
                now[word] = known
                continue
            core = self._core(word)
            if core == word:
                unknown.add(word)
            else:
                cut.append((word, core))
                unknown.update(part for part in (core, word[len(core) :]) if part not in now)
        now.update(self._words_encoded(list(unknown)))
        for word, core in cut:
            now[word] = now[core] + now[word[len(core) :]]

    def batch(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text, given as UTF-8; a missing text has none."""
        if not self.by_word:
            return [np.frombuffer(b, self.dtype) for b in self._encoded([(text or b"").decode() for text in texts])]
        # Splits at exactly the six ASCII white-space bytes.
        words = [(text or b"").split() for text in texts]
        if len(self.now) > self.words_kept:
            self.now, self.before = {}, self.now
        ids = [list(map(self.now.get, each)) for each in words]
        gaps = [(at, place) for at, each in enumerate(ids) for place in _places_of_none(each)]
        if gaps:
            self._learn({words[at][place] for at, place in gaps})
            for at, place in gaps:
                ids[at][place] = self.now[words[at][place]]
        return [np.frombuffer(b"".join(each), self.dtype) for each in ids]


def _places_of_none(values: list) -> Iterator[int]:
    place = -1
    try:
        while True:
            place = values.index(None, place + 1)
            yield place
    except ValueError:
        return


def _pattern(settings: dict) -> str:
    steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return steps[0].get("pattern", {}).get("Regex", "")


def _splits_at_white_space(settings: dict) -> bool:
    """Whether the settings are known to treat the words of a text apart: white space is dropped before any merge."""
    steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    first = steps[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    classes = _pattern(settings)
    plain = settings.get("normalizer") or {}
    kinds = {step["type"] for step in plain.get("normalizers", [plain] if plain else [])}
    no_space = all(" " not in part and (r"\s" not in part or r"[^\s" in part) for part in classes.split("|"))
    prefixed = any(step.get("add_prefix_space") for step in steps)
    return drops and no_space and not prefixed and kinds <= {"NFC", "Replace", "Lowercase"} and not settings.get("post_processor")


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def text_ids(path: str, words_kept: int = WORDS_KEPT) -> TextIds:
    """The worker's encoder for a tokenizer file."""
    return worker_state(f"ids:{path}:{words_kept}", lambda: TextIds(path, words_kept))


def with_end(ids: np.ndarray, end_id: int) -> np.ndarray:
    return np.append(ids, np.asarray(end_id, dtype=ids.dtype))
