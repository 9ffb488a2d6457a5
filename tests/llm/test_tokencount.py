"""Token counts against the library's own encoding of whole texts."""

import random

import pytest

from monthmill.llm import tokencount
from monthmill.llm.queries import op13_token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

SIGNS = ["a", "B", "s", "t", "re", "'", "''", "'s", " ", "  ", "\n", "\t", " ", " ", "1", "²", "½", "-", "<|endoftext|>", "<|", "|>", "é", "é", "́", "̇", "İ", "ß", "Σ", "ς",
         "中", "。", "あ", "が", "゙", "가", "ᄀ", "ᅡ", "ᆨ", "ﬁ", "K", "Å", "̸", "=", "≠", "😀", "‍", "̈́", "\x1c", "\x85", " ", "ो", "क", "़", "ड", "don't", "word", ";", "`", "क़", "\U00010400", "ǅ"]


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return tokencount.Counter(file.read())


@pytest.fixture(scope="module")
def whole():
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def texts(seed, count, top):
    rng = random.Random(seed)
    for _ in range(count):
        some = rng.sample(SIGNS, rng.randint(1, 12))
        yield "".join(rng.choices(some, k=rng.randint(0, top)))


def test_pairs_are_stable(counter, whole):
    """Wherever two characters are said to part, the parts' counts add up, in any surroundings."""
    rng = random.Random(1)
    sure = 0
    for text in texts(2, 6000, 12):
        for at in range(1, len(text)):
            if tokencount.stable(text[at - 1], text[at]) and not counter._in_special(text, at):
                sure += 1
                assert whole(text) == whole(text[:at]) + whole(text[at:]), (text, at)
    assert sure > 5000 and rng


@pytest.mark.parametrize("chunk, overlap", [(16, 4), (40, 8), (64, 2)])
def test_huge(counter, whole, monkeypatch, chunk, overlap):
    monkeypatch.setattr(tokencount, "CHUNK", chunk)
    monkeypatch.setattr(tokencount, "OVERLAP", overlap)
    for text in [*texts(chunk, 700, 200), "a" * 500, "a" * 300 + " " + "b" * 300, "中" * 200, "'" * 90 + "s" * 90, " " * 300, "<|endoftext|>" * 30, "<|endoftext|" * 30, "é" * 100]:
        assert counter.huge(text) == whole(text), text


def test_widening(counter, whole):
    """A run of letters longer than any overlap, and than a chunk, is one word."""
    text = "start " + "abcdefghij" * 9000 + " then " + "plain words here " * 6000 + "z" * 70_000
    assert len(text) > 3 * tokencount.CHUNK
    assert counter.huge(text) == whole(text)


def test_pieces(counter, whole, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tokencount, "WINDOW", 50)
    monkeypatch.setattr(tokencount, "REMEMBERED", 40)
    some = [None, "", " ", *texts(9, 500, 30), None]
    assert counter.pieces(pa.array(some)).tolist() == [whole(t) for t in some]


def test_rows(spark, whole):
    rows = [(1, None), (1, ""), (None, "Two words"), (2, "x y " * 40_000), (2, "Two words"), (3, "<|startoftext|>É")]
    frame = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, n_tokens int, key int")
    found = tokencount.count_tokens(frame, PATH)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((k, len((t or "").encode()), whole(t)) for k, t in rows), key=repr)
    assert tokencount.count_tokens(frame.limit(0), PATH).collect() == []
    with pytest.raises(ValueError):
        tokencount.count_tokens(frame, public_tokenizers.path("byte_bpe_50k.json"))


def test_given_documents(spark, folder, whole):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op13_token_counts(spark, folder).collect()
    assert len(found) == len(docs)
    for r in found:
        assert r.n_tokens == whole(docs[r.doc_id]) and r.over_limit == (r.n_tokens > 2048) and r.n_bytes == len((docs[r.doc_id] or "").encode())
