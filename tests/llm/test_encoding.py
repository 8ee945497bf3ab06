import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing, words
from tidemark.llm.queries import vocabulary

BYTES, WORDS = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def originals():
    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


def check_packed(rows, docs, tokenizer, window=2048):
    want, got, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for doc, text in docs:
        want[doc].append(np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    for r in rows:
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(want) == set(got)
    for doc, encoded in want.items():
        if len(encoded) == 1:
            at = 0
            for r in sorted(got[doc], key=lambda r: r["start"]):
                assert (r["start"], r["doc_tokens"]) == (at, len(encoded[0]))
                assert r["ids_crc32"] == zlib.crc32(encoded[0][at : at + r["length"]].tobytes())
                at += r["length"]
            assert at == len(encoded[0])
        else:
            assert sum(r["length"] for r in got[doc]) == sum(map(len, encoded))
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    padded = sum(window - sum(r["length"] for r in p) for p in sequences.values())
    return padded, len(sequences)


def test_packs_every_id_once(sample, originals):
    docs = [(r.doc_id, r.text) for r in sample.collect()]
    padded, n = check_packed(packing.pack_documents(sample.repartition(5), BYTES).collect(), docs, originals[0])
    assert padded < 2048 + 0.01 * n * 2048


def test_packing_of_odd_rows(edge, empty, originals):
    docs = [(r.doc_id, r.text) for r in edge.collect()]
    check_packed(packing.pack_documents(edge, BYTES).collect(), docs, originals[0])
    assert packing.pack_documents(empty, BYTES).count() == 0


def test_rests_of_many_tasks_merge_in_rounds(sample, originals, monkeypatch):
    monkeypatch.setattr(packing, "MERGE_GROUP", 3)
    docs = [(r.doc_id, r.text) for r in sample.collect()]
    padded, n = check_packed(packing.pack_documents(sample.repartition(11), BYTES).collect(), docs, originals[0])
    assert padded < 2048 + 0.01 * n * 2048


def digests(text, tokenizer):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_word_encoding_is_the_librarys(sample, edge, empty, originals):
    for docs in (sample, edge):
        want = sorted(map(str, ((r.doc_id, *digests(r.text, originals[1])) for r in docs.collect())))
        assert sorted(map(str, map(tuple, bpe.encoding_digests(docs, WORDS).collect()))) == want
    assert bpe.encoding_digests(empty, WORDS).count() == 0


def test_ids_decode_to_the_same_text(sample):
    encoder = bpe.word_encoder(WORDS)
    for r in bpe.encode_documents(sample, WORDS).limit(20).collect():
        assert encoder.decode(r.ids) == r.decoded


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", exclude_categories=["Cn", "Co"]), max_size=40) | st.text("abcdeéİΣ's <|endoftext|>\n12", max_size=60))
def test_any_text(text):
    original = Tokenizer.from_file(WORDS) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = original
    ids, decoded = next(iter(bpe.word_encoder(WORDS).encode([text])))
    want = original.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded == original.decode(want, skip_special_tokens=False)


def test_shared_prefixes_are_walked_once():
    trie = bpe.Trie(["abc", "abd", "ab", "b", "abc"])
    assert len(trie.depth) == 1 + 5
    assert sum(trie.ends) == 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=12), max_size=20))
def test_trie_encoding_equals_plain_merging(words):
    merges = [("a", "b"), ("ab", "c"), ("b", "c"), ("a", "a"), ("aa", "aa"), ("abc", "abc"), ("c", "c"), ("aab", "c")]
    merges = [m for m in merges if m != ("aab", "c")]
    vocab = {t: i for i, t in enumerate(["a", "b", "c", *("".join(m) for m in merges)])}
    pairs = bpe.BytePairs(vocab, merges)

    def plain(word):
        symbols = list(word)
        while True:
            ranks = [pairs.rank.get(p, 99) for p in zip(symbols, symbols[1:], strict=False)]
            if not ranks or min(ranks) == 99:
                return symbols
            at = ranks.index(min(ranks))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    distinct = sorted(set(words))
    assert pairs.encode_words(distinct) == [plain(w) for w in distinct]


def test_decoded_text_is_read_from_the_ids():
    encoder = bpe.WordEncoder(vocabulary("word_bpe_49k.json"))
    first = encoder.original.encode("hello", add_special_tokens=False).ids[0]
    encoder.tokens[first] = "changed"
    assert next(encoder.encode(["hello"]))[1].startswith("changed")


def test_written_out_classes_split_alike():
    """The splitter names its characters; the classes themselves must give the same words of any plain text."""
    classes = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    plain = words.NOT_PLAIN.sub("", "".join(map(chr, range(0x10000))))
    draw = random.Random(3)
    for _ in range(300):
        text = "".join(draw.choice((plain, "ab '_1]^-\\\t\n", "'s't're've'm'll'd  ")[draw.randrange(3)]) for _ in range(200))
        assert words.BYTE_LEVEL_WORDS.findall(text) == classes.findall(text)
    assert words.BYTE_LEVEL_WORDS.findall(plain) == classes.findall(plain)


def test_a_slice_does_not_walk_all_words_held():
    class Watched(words.WordCache):
        def __iter__(self):
            raise AssertionError("walked")

    cache = Watched(lambda new: [w.upper() for w in new])
    cache.learn([["a", "b"], ["b"]])
    cache.learn([["b", "c"]])
    assert [cache[w] for w in "abc"] == ["A", "B", "C"]


def test_the_tokenizer_is_asked_for_few_words_at_once(monkeypatch):
    import tokenizers

    asked, path = [], vocabulary("byte_bpe_50k.json")
    real = tokenizers.Tokenizer.from_file(path)

    class Counted:
        from_file = staticmethod(lambda _: Counted())

        def __getattr__(self, name):
            return getattr(real, name)

        def encode_batch_fast(self, texts, **options):
            asked.append(len(texts))
            return real.encode_batch_fast(texts, **options)

    texts = [f"{k} " + " ".join(f"{''.join(map(chr, (97 + i % 26, 97 + i // 26 % 26, 97 + i // 676 % 26)))}q" for i in range(k, 12_000 + k)) for k in range(3)]
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    found = list(packing.byte_level_encoder(path)(texts))
    assert found == [np.array(real.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert sum(asked) > 2 * max(asked) and max(asked) <= 4000


def test_words_are_asked_many_at_once(monkeypatch):
    """A call of the tokenizer for each word cost most of the packing; joined ones must give the same ids."""
    import tokenizers

    asked, path = [], vocabulary("byte_bpe_50k.json")
    real = tokenizers.Tokenizer.from_file(path)

    class Counted:
        from_file = staticmethod(lambda _: Counted())

        def __getattr__(self, name):
            return getattr(real, name)

        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return real.encode_batch_fast(texts, **options)

    draw = random.Random(5)
    made = ["".join(draw.choice(kind) for _ in range(draw.randint(1, 9))) for kind in ("abcdeé", "абв", "0123", "'-_!?”", "ab1'-") for _ in range(800)]
    texts = [draw.choice(("", "x", "'s")) + draw.choice((" ", "  ", "\n", "\xa0", "")).join(draw.sample(made, 600)) + draw.choice(("", " ", "\n ")) for _ in range(12)]
    texts += ["", " ", "  ", " '", "'s 's", " a\x85b"]
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    found = list(packing.byte_level_encoder(path)(texts))
    assert found == [np.array(real.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    spaced = {w for t in texts for w in words.BYTE_LEVEL_WORDS.findall(t) if re.fullmatch(r" \S+", w)}
    assert len(spaced) > 500 and not spaced & set(asked)
    assert len([a for a in asked if a.startswith(" ") and a.strip()]) < len(spaced) / 20


def test_words_that_do_not_split_as_counted_are_asked_alone(monkeypatch):
    monkeypatch.setattr(packing, "BYTE_LEVEL_WORDS", re.compile(r" ?[^ ]"))
    path = vocabulary("byte_bpe_50k.json")
    original = Tokenizer.from_file(path)
    alone = [original.encode(w, add_special_tokens=False).ids for w in (" a", "b", " c", "d")]
    (found,) = packing.byte_level_encoder(path)([" ab cd"])
    assert np.frombuffer(found, "<u4").tolist() == sum(alone, [])
