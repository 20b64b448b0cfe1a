"""Word vocabularies against the tokenizers library and against plain merging."""

import random

import brute
import numpy as np
import pytest
from test_operators import DOCS, docs, hard, none, plain  # noqa: F401
from tokenizers import Tokenizer

from offerloom.llm import queries, word_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.word_vocabulary())


@pytest.fixture(scope="module")
def own():
    with open(queries.word_vocabulary(), "rb") as file:
        return word_bpe.WordBpe(file.read())


def same(own, library, texts):
    coded = own.encode(texts)
    ids = np.frombuffer(b"".join(coded), np.int32)
    ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])])
    for text, i, j, decoded in zip(texts, ends, ends[1:], own.decode_all(ids, ends).to_pylist()):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[i:j].tolist() == want, text
        assert decoded == library.decode(want, skip_special_tokens=False), text


def test_tokens_equal_the_library(docs, plain, hard, library):  # noqa: F811
    for frame, rows in ((docs, plain), (hard, [(r["doc_id"], r["text"]) for r in hard.collect()])):
        out = word_bpe.encode(frame, queries.word_vocabulary())
        assert out.schema["doc_id"].dataType == frame.schema["doc_id"].dataType
        got = out.collect()
        assert len(got) == len(rows)
        by_id = {r["doc_id"]: (r["ids"], r["decoded"]) for r in got if r["doc_id"] != 4}
        for doc, text in rows:
            if doc != 4:  # two rows
                ids = library.encode(text or "", add_special_tokens=False).ids
                assert by_id[doc] == (ids, library.decode(ids, skip_special_tokens=False))


def test_digests(spark, library):
    rows = [(1, "Hello WORLD, hello!"), (2, None), (3, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in word_bpe.report(word_bpe.encode(frame, queries.word_vocabulary())).collect()}
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[doc] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(decoded))


def test_random_texts(own, library):
    rng = random.Random(5)
    letters = "ab the ing\x00\n\té汉字😀́<|endoftext|><s>., ​ΣσςİǅÉ²½Ⅷ٣\x1c\x85 'sreve"
    same(own, library, ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(2000)])
    same(own, library, ["".join(rng.choices("aeht", k=rng.randint(1, 30))) for _ in range(5000)])
    planes = [0x250, 0x3000, 0xD800]
    same(own, library, ["".join(chr(rng.randrange(rng.choice(planes))) for _ in range(20)) for _ in range(3000)])


def test_special_tokens_and_long_words(own, library):
    same(own, library, ["<|endoftext|>a<|startoftext|>", "x<|ENDOFTEXT|>", "a" * 20000, "abab" * 5000, "'s's''s ΑΣ ΑΣΑ", "", " "])


def test_memory_is_bounded(own, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "REMEMBERED", 20_000)
    monkeypatch.setattr(word_bpe, "PAIRS", 10)
    rng = random.Random(7)
    for _ in range(20):
        same(own, library, ["".join(rng.choices("abcdefgh ", k=200)) for _ in range(5)])
        assert len(own.young) * word_bpe.ENTRY <= 2 * 20_000 and len(own.merges.table) <= 10


def merged(symbols, merges):
    """Plain merging: the first merge of the list that fits anywhere, leftmost first."""
    rank = {(a, b): (k, t) for k, (a, b, t) in enumerate(merges)}
    out = list(symbols)
    while True:
        found = [(rank[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in rank]
        if not found:
            return out
        _, i = min(found)
        out[i : i + 2] = [rank[out[i], out[i + 1]][1]]


def test_random_merges_equal_plain_merging():
    rng = random.Random(11)
    for _ in range(60):
        base = list(range(rng.randint(1, 3)))
        merges, texts = [], {b: (b,) for b in base}
        while len(merges) < rng.randint(2, 14):
            a, b = rng.choice(list(texts)), rng.choice(list(texts))
            if texts[a] + texts[b] in texts.values():
                if len(merges) > 1:
                    break
                continue
            token = len(texts)
            merges.append((a, b, token))
            texts[token] = texts[a] + texts[b]
        built = word_bpe.Merges(base, merges, len(texts))
        for _ in range(60):
            word = rng.choices(base, k=rng.randint(1, 24))
            assert built.tokens("".join(chr(b + 1) for b in word)) == merged(word, merges)


def test_another_kind_is_refused():
    with open(queries.word_vocabulary(), "rb") as file:
        data = file.read().replace(b'"NFC"', b'"NFD"')
    with pytest.raises(ValueError, match="another kind"):
        word_bpe.WordBpe(data)


def test_empty_table(none):  # noqa: F811
    out = word_bpe.report(word_bpe.encode(none, queries.word_vocabulary()))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0
