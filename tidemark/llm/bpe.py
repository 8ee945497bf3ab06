"""Byte-pair encoding by depth-first traversal of a trie of words.

In a byte-pair vocabulary whose tokens all encode to themselves, the encoding
of a string is its only segmentation in which every two neighbours stay apart
when encoded together. So every prefix has one last token, and it follows from
the last token of a shorter prefix: that prefix of the trie is solved once for
all words below it.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.words import NOT_PLAIN, WORD_LEVEL_WORDS, WordCache, held, slices

ENCODED = "doc_id long, ids binary, decoded string"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others follow from U+0100.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Trie:
    """Words by shared prefixes: for each node its parent, its character and whether words end there.

    Nodes are numbered in preorder, so a walk over them is the depth-first walk.
    """

    def __init__(self, words: Iterable[str]):
        self.depth, self.char, self.ends = [0], [""], [False]
        path: list[int] = [0]
        before = ""
        for word in sorted(set(words)):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :]
            for char in word[shared:]:
                path.append(len(self.depth))
                self.depth.append(len(path) - 1)
                self.char.append(char)
                self.ends.append(False)
            self.ends[path[-1]] = True
            before = word


class BytePairs:
    """A vocabulary with its merges; ``suffix`` marks the last character of a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.rank = {tuple(pair): at for at, pair in enumerate(merges)}
        self.parts = {left + right: (left, right) for left, right in merges}
        self.longest = max((len(t.removesuffix(suffix)) if suffix else len(t)) for t in vocab)
        self.apart: dict[tuple[str, str], bool] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, int]]] = {}

    def edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """The symbols at the left (0) or right (1) end of a token while it is built, last first.

        With each comes the rank of the merge that uses it up.
        """
        found = self.edges.get((token, side))
        if found is None:
            found, symbol, used = [], token, len(self.rank)
            while True:
                found.append((symbol, used))
                if symbol not in self.parts:
                    break
                pair = self.parts[symbol]
                symbol, used = pair[side], self.rank[pair]
            self.edges[token, side] = found
        return found

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether two tokens side by side are the encoding of their joined string.

        They are not if some merge across the boundary comes before both of its
        symbols are used up; of equal merges the left one comes first.
        """
        key = (left, right)
        known = self.apart.get(key)
        if known is None:
            known, none, rank = True, len(self.rank), self.rank
            for a, a_used in self.edge(left, 1):
                for b, b_used in self.edge(right, 0):
                    at = rank.get((a, b), none)
                    if at < none and at < a_used and at <= b_used:
                        known = False
            if len(self.apart) > 1_000_000:
                self.apart.clear()
            self.apart[key] = known
        return known

    def last_token(self, text: str, last: list[str], end: str) -> str:
        """The last token of the encoding of ``text + end``; ``last`` has those of all shorter prefixes."""
        size, vocab, apart = len(text), self.vocab, self.apart
        for start in range(max(0, size - self.longest), size):
            token = text[start:] + end
            if token in vocab:
                if not start:
                    return token
                known = apart.get((last[start], token))
                if known or (known is None and self.stay_apart(last[start], token)):
                    return token
        raise ValueError(f"no token ends {text!r}")

    def encode_words(self, words: list[str]) -> list[list[str]]:
        """Tokens of distinct words, which are strings over the byte alphabet."""
        trie, found = Trie(words), {}
        text, last = "", [""]
        for node in range(1, len(trie.depth)):
            depth = trie.depth[node]
            text = text[: depth - 1] + trie.char[node]
            del last[depth:]
            last.append(self.last_token(text, last, ""))
            if trie.ends[node]:
                token = self.last_token(text, last, self.suffix) if self.suffix else last[depth]
                tokens, at = [token], depth - len(token.removesuffix(self.suffix) if self.suffix else token)
                while at:
                    tokens.append(last[at])
                    at -= len(last[at])
                found[text] = tokens[::-1]
        return [found[w] for w in words]


class WordEncoder:
    """Encoding and decoding for a lower-casing byte-pair vocabulary with word ends.

    ``path`` is a tokenizer file. Added tokens are cut out of the raw text first;
    the rest is composed (NFC), lower-cased and split into words.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pairs = BytePairs(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.alphabet = byte_alphabet()
        self.cache = WordCache(self._make)
        self.original = Tokenizer.from_file(path)
        self.original.no_truncation()
        self.original.no_padding()

    def _make(self, words: list[str]) -> Iterator[tuple[bytes, str]]:
        shown = ["".join(map(self.alphabet.__getitem__, w.encode("utf-8"))) for w in words]
        vocab = self.pairs.vocab
        for tokens in self.pairs.encode_words(shown):
            ids = np.array([vocab[t] for t in tokens], "<u4").tobytes()
            yield ids, self.decode(ids)

    def _words(self, text: str) -> list[str]:
        return WORD_LEVEL_WORDS.findall(unicodedata.normalize("NFC", text).lower())

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """Little-endian ids of each text and the text they decode to (tokens joined by spaces)."""
        for first, last in slices(texts):
            split: list[list[str] | None] = []
            for text in texts[first:last]:
                if NOT_PLAIN.search(text):
                    split.append(None)
                elif self.cut and any(a in text for a in self.added):
                    split.append([w for p in self.cut.split(text) for w in ([p] if p in self.added else self._words(p))])
                else:
                    split.append(self._words(text))
            self.cache.learn([w for w in s if w not in self.added] for s in split if s)
            for token, number in self.added.items():
                ids = np.array([number], "<u4").tobytes()
                self.cache[token] = (ids, self.decode(ids))
            for text, words in zip(texts[first:last], split, strict=True):
                if words is None:
                    yield self._encode_by_pieces(text)
                else:
                    found = list(map(self.cache.__getitem__, words))
                    yield b"".join(f[0] for f in found), " ".join(f[1] for f in found)

    def _encode_by_pieces(self, text: str) -> tuple[bytes, str]:
        """The tokenizer's own normalizer and splitter find the words of texts with other characters."""
        out: list[tuple[bytes, str]] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.added:
                ids = np.array([self.added[part]], "<u4").tobytes()
                out.append((ids, self.decode(ids)))
                continue
            shown = self.original.pre_tokenizer.pre_tokenize_str(self.original.normalizer.normalize_str(part))
            for tokens in self._tokens([w for w, _ in shown]):
                ids = np.array([self.pairs.vocab[t] for t in tokens], "<u4").tobytes()
                out.append((ids, self.decode(ids)))
        return b"".join(o[0] for o in out), " ".join(o[1] for o in out)

    def _tokens(self, shown: list[str]) -> list[list[str]]:
        distinct = sorted(set(shown))
        found = dict(zip(distinct, self.pairs.encode_words(distinct), strict=True))
        return [found[w] for w in shown]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces: the vocabulary has no decoder of its own."""
        return " ".join(self.tokens[i] for i in np.frombuffer(ids, "<u4").tolist())


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary, kept between tasks."""
    return held(f"encoding {path}", lambda: WordEncoder(path))


def _over_texts(docs: DataFrame, per_batch: Callable, schema: str, names: list[str], kinds: list) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            columns = per_batch(texts)
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Every text of (doc_id, text) as ids, and the text those ids decode to.

    ``ids`` are little-endian unsigned 32-bit integers. A null or empty text has
    no ids and decodes to the empty text; a null doc_id stays null; repeated
    rows give repeated rows; other columns are ignored.
    """

    def per_batch(texts):
        ids, decoded = [], []
        for i, d in word_encoder(vocabulary).encode(texts):
            ids.append(i)
            decoded.append(d)
        return ids, decoded

    return _over_texts(docs, per_batch, ENCODED, ["doc_id", "ids", "decoded"], [pa.binary(), pa.string()])


def encoding_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of the decoded text, whose bytes never leave the task.

    The decoded text is read back from the ids by ``decode``, distinct words once.
    Nulls, empty texts and repeated rows as in ``encode_documents``.
    """

    def per_batch(texts):
        n, ids_hash, decoded_hash = [], [], []
        for ids, decoded in word_encoder(vocabulary).encode(texts):
            n.append(len(ids) // 4)
            ids_hash.append(hashlib.sha256(ids).hexdigest())
            decoded_hash.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
        return n, ids_hash, decoded_hash

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return _over_texts(docs, per_batch, schema, names, [pa.int64(), pa.string(), pa.string()])
