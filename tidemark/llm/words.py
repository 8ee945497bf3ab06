"""Splitting texts as the two public tokenizers do, with a cache of what each word becomes.

A byte-pair encoder never merges across the words of its splitter, so a text is
the concatenation of its words' encodings. Words repeat; texts do not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa

#: Characters on which Python's classes, case and composition rules equal the
#: originals' ones. Texts with others are encoded by the original itself.
NOT_PLAIN = re.compile(
    "[^\x00-\x1b\x20-\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-˿"
    "Ѐ-ԯ‐-‧‰-⁞₠-₿、-〃ぁ-ゖ]"
)
_PLAIN = NOT_PLAIN.sub("", "".join(map(chr, range(0x3100))))


def _written_out(kind: str) -> str:
    """The PLAIN characters of a class one by one: a set of characters is looked up, classes are tried in turn."""
    return f"[{re.escape(''.join(re.findall(kind, _PLAIN)))}]"


_LETTER, _DIGIT, _OTHER = map(_written_out, (r"[^\W\d_]", r"\d", r"[^\s\w]|_"))

#: The splitters of the two vocabularies, written with Python's
#: own classes. They agree with the originals on PLAIN characters only.
BYTE_LEVEL_WORDS = re.compile(rf" ?{_LETTER}+|'(?:[stmd]|re|ve|ll)| ?{_DIGIT}+| ?{_OTHER}+|\s+(?!\S)|\s+")
WORD_LEVEL_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

_HELD: dict[str, object] = {}


def held(key: str, make: Callable[[], object]):
    """What a worker keeps between tasks. One thing at a time: workers outlive the operator that filled them."""
    if key not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        _HELD[key] = make()
    return _HELD[key]


#: Words a worker remembers for good; beyond it, those of one slice at a time.
CACHE_WORDS = 400_000


class WordCache(dict):
    """What a word becomes, found for all new words of a slice at once.

    ``make`` turns a list of distinct words into as many results. The first
    ``limit`` words stay; later ones are kept until the next slice, so memory
    is bounded and the results are the same.
    """

    def __init__(self, make: Callable[[list[str]], Iterable], limit: int = CACHE_WORDS):
        super().__init__()
        self.make, self.limit, self.passing = make, limit, {}

    def __missing__(self, word: str):
        return self.passing[word]

    def learn(self, texts: Iterable[list[str]]) -> None:
        new = set()
        for words in texts:
            new.update(words)
        # asked word by word: the difference with a mapping would walk all that is held, for every slice
        new = sorted(w for w in new if w not in self)
        found = dict(zip(new, self.make(new), strict=True))
        if len(self) + len(found) <= self.limit:
            self.update(found)
            found = {}
        self.passing = found


def slices(texts: list[str], chars: int = 2_000_000) -> Iterable[tuple[int, int]]:
    """Index ranges of at most so many characters, or one text."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield first, at
            first, held = at, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)
