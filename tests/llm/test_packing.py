import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from workpulse.llm import packing as K
from workpulse.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def first_fit_plain(sizes, length):
    """First-fit decreasing by looking at every sequence."""
    filled, out = [], []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = next((b for b, f in enumerate(filled) if f + sizes[item] <= length), len(filled))
        if at == len(filled):
            filled.append(0)
            out.append([])
        filled[at] += sizes[item]
        out[at].append((item, 0, sizes[item]))
    return out


def holds(rows, library, texts, length=K.LENGTH):
    """Every id lies in one piece, in order, and sequences are gapless, and full or a power of two."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        want = ids_of(library, texts[doc])
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(want))
            cut = np.array(want[at : at + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(cut)
            at += r["length"]
        assert at == len(want)
    sizes = []
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        sizes.append(at)
    assert all(s == length or (s < length and s & (s - 1) == 0) for s in sizes)
    return sizes


def test_word_ids_match_the_library(library):
    encode = K.encoder(K.read_vocabulary(PATH))
    assert isinstance(encode, K.WordIds)
    encode.kept = 40
    rng = random.Random(5)
    parts = ["the", "The", "ÉTÉ", "ing,", "é", "😀", "\n", "  ", "\t", "'s", "'LL", "123", "!?", "<|endoftext|>", "<|startoftext|>", " ", "ß",
             "x" * 70, "\x1c", "中文", "é", " ́", "Σ", "ΑΣ", "ﬁ", "İ", "²", "a.b", "don't", "\r\n", "\x85", "<|", "\x0b", "ªº"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 12)))
        assert np.frombuffer(encode.encode(text), encode.kind).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_word_reaches_the_tokenizer_once(library):
    told = K.read_vocabulary(PATH)
    seen = []

    class Counted:
        def tokenize(self, word):
            seen.append(word)
            return library.model.tokenize(word)

    encode = K.WordIds(library, K.id_kind(told))
    encode.model = Counted()
    text = "Thernted, thernted. THERNTED thernted.. thernted, été. Été,"
    assert np.frombuffer(encode.encode(text), encode.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(seen) == len(set(seen)) == 5  # two words, three runs of punctuation


def test_parts_are_forgotten_at_their_bound(library):
    encode = K.WordIds(library, "<u4", kept=3)
    text = " ".join(f"{a}{b}{m}" for a in "xyzé" for b in ("ab", "CD") for m in (",", "!?", ""))
    assert np.frombuffer(encode.encode(text), encode.kind).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encode.parts) <= 3 and len(encode) <= 3


def test_other_vocabularies_are_read_whole():
    other = public_tokenizers.path("byte_bpe_50k.json")
    encode, library = K.encoder(K.read_vocabulary(other)), Tokenizer.from_file(other)
    assert isinstance(encode, K.TextIds)
    text = "the  cat\n sat <|endoftext|> é"
    assert np.frombuffer(encode.encode(text), encode.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def test_tree_places_as_a_plain_first_fit():
    rng = random.Random(7)
    for n in (1, 2, 3, 17, 400):
        for most in (2048, 300, 40):
            sizes = [rng.randrange(1, most + 1) for _ in range(n)]
            assert K.first_fit_decreasing(sizes, 2048) == first_fit_plain(sizes, 2048)
    assert K.first_fit_decreasing([], 2048) == []


def test_gaps_close_and_first_fit_decides():
    rng = random.Random(8)
    for n in (1, 2, 30, 600):
        sizes = [rng.randrange(1, 2048) for _ in range(n)]
        placed = K.first_fit_decreasing(sizes, 2048)
        out = K.close_gaps(placed, 2048)
        held = collections.defaultdict(list)
        for sequence in out:
            filled = sum(p[2] for p in sequence)
            assert filled == 2048 or filled & (filled - 1) == 0
            for item, start, size in sequence:
                held[item].append((start, size))
        for item, size in enumerate(sizes):
            at = 0
            for start, length in sorted(held[item]):
                assert start == at and length > 0
                at += length
            assert at == size


def test_first_fit_decides():
    """Without it (one document a sequence, gaps closed by cutting alone) far more documents are cut."""
    rng = random.Random(8)
    sizes = [1 + min(2046, int(rng.expovariate(1 / 300))) for _ in range(2000)]
    cuts = lambda placed: sum(len(s) for s in K.close_gaps(placed, 2048)) - len(sizes)
    assert cuts(K.first_fit_decreasing(sizes, 2048)) < cuts([[(i, 0, s)] for i, s in enumerate(sizes)]) / 10


@pytest.mark.parametrize("group_docs", [K.GROUP_DOCS, 40])
def test_round_trip(spark, library, group_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    pieces = K.pack(docs, PATH, group_docs=group_docs)
    rows = pieces.withColumn("ids_crc32", F.crc32("ids")).collect()
    sizes = holds(rows, library, texts)
    whole = {r["sequence_id"]: r for r in K.sequences(pieces).collect()}
    assert sorted(r["length"] for r in whole.values()) == sorted(sizes)
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole.values())
    one = rows[0]
    start = 4 * one["offset"]
    assert bytes(whole[one["sequence_id"]]["ids"][start : start + 4 * one["length"]]) == bytes(one["ids"])


def test_query(spark, library):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op11_packing"](spark, sf)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    holds(got.collect(), library, texts)


def test_awkward_tables(spark, library, awkward, empty):
    numbered = awkward.withColumn("doc_id", F.monotonically_increasing_id())
    texts = {r["doc_id"]: r["text"] for r in numbered.collect()}
    holds(K.pack(numbered, PATH).withColumn("ids_crc32", F.crc32("ids")).collect(), library, texts)
    repeated = K.pack(awkward, PATH).collect()  # null and repeated ids are documents of their own
    assert sum(r["length"] for r in repeated) == sum(len(ids_of(library, t)) for t in texts.values())
    assert K.pack(empty, PATH).count() == 0
    clashing = spark.createDataFrame([("a b", "k", 5)], "text string, offset string, start int")
    assert [r["length"] for r in K.pack(clashing, PATH, id_col="offset").select("length").collect()] == [2, 1]
