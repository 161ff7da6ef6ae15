import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from workpulse.llm import tokens as T
from workpulse.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counts():
    return T.PieceCounts(T.read_vocabulary(PATH), kept=50)


def test_random_texts_match_the_library(library, counts):
    rng = random.Random(3)
    parts = ["the", " of", "ing", "é", "😀", "\n", "  ", "\t", "'s", "'LL", "123", "!?", "<|endoftext|>", " ", "ß", "x" * 40, "aaaa", "\x1c", "中文"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 25)))
        assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_every_kind_of_character(library, counts):
    for code in [*range(0x3000), *range(0x3000, 0x110000, 997)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)} {chr(code) * 2}  b"
            assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids), hex(code)


def test_long_pieces(library, counts):
    for text in ("x" * 20_000, "ab" * 9_000, " " * 5_000, "é" * 7_000):
        assert counts.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_vocabulary_bound(tmp_path, monkeypatch):
    monkeypatch.setattr(T, "VOCABULARY_BYTES", 5)
    (tmp_path / "v").write_text("123456")
    with pytest.raises(ValueError):
        T.read_vocabulary(str(tmp_path / "v"))


def test_query_and_awkward_tables(spark, library, awkward, empty):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op7_tokens"](spark, sf).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 1024)
    got = T.token_counts(awkward, PATH)
    assert all(r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in got.collect())
    assert T.token_counts(empty, PATH).count() == 0
