import hashlib
import random

import pytest
from tokenizers import Tokenizer

from monthmill.llm import bpe
from monthmill.llm.queries import op8_bpe, tokenizer_path

PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "ñ", "1", "23", ".", "'s", "'", "<|endoftext|>", " ", "日本", "\U0001f600", "!!", "\r\n", "\x1c", "\x85", "_", "²", "Ⅷ", "x" * 90, " and", " ", "Ᲊ", "՘", "ab" * 200]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(tokenizer_path())


def ids(text):
    return [int(x) for x in text.split(",")] if text else []


def test_random_texts(reference):
    rnd = random.Random(3)
    enc = bpe.Encoder(tokenizer_path())
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(0, 25))) for _ in range(3000)]
    for text, got in zip(texts, enc.encode_texts(texts), strict=True):
        want = reference.encode(text, add_special_tokens=False).ids
        assert ids(got) == want, text
        assert enc.vocabulary.decode(want) == reference.decode(want, skip_special_tokens=False)


def test_short_and_long_merges_agree():
    rnd = random.Random(4)
    v = bpe.Vocabulary(tokenizer_path())
    words = ["".join(rnd.choice("ab the ing é ñ Th ion 日".split(" ")) for _ in range(rnd.randrange(1, 20))).encode()[:64] for _ in range(2000)]
    words = [w for w in words if w]
    assert v.merge_short(words) == [v.merge_long(w) for w in words]


def test_decode_of_broken_ids(reference):
    v = bpe.Vocabulary(tokenizer_path())
    for raw in ([447], [447, 99], [12, 447, 247], [50256, 13]):
        assert v.decode(raw) == reference.decode(raw, skip_special_tokens=False)
    assert v.decode([999_999]) == ""


def test_query(spark, sf, reference):
    got = {r.doc_id: r for r in op8_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        want = reference.encode(r.text or "", add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(want)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(reference.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_edges(spark, odd_docs, no_docs, reference):
    out = bpe.bpe_round_trip(odd_docs, tokenizer_path(), keep=["doc_id", "score"]).collect()
    assert len(out) == odd_docs.count()
    assert all(r.decoded == (t or "") for r, t in zip(out, [r.text for r in odd_docs.collect()], strict=True))
    assert bpe.bpe_round_trip(no_docs, tokenizer_path()).count() == 0
    back = bpe.bpe_decode(spark.createDataFrame([(1, [31373, 995]), (2, None), (3, [])], "doc_id int, token_ids array<int>"), tokenizer_path()).collect()
    assert [r.text for r in back] == ["hello world", None, ""]
    with pytest.raises(ValueError):
        bpe.bpe_round_trip(odd_docs, tokenizer_path(), keep=["n_tokens"]) if "n_tokens" in odd_docs.columns else bpe.bpe_round_trip(odd_docs, tokenizer_path(), outputs=["nonsense"])


def test_clearing_the_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    enc = bpe.Encoder(tokenizer_path())
    one = enc.encode_texts(["a few words here", "and more words"])
    assert one == enc.encode_texts(["a few words here", "and more words"]) == [enc.encode_text("a few words here"), enc.encode_text("and more words")]
