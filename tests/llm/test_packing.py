import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from snapfacet.llm import packing as K
from snapfacet.llm import words as W

from .conftest import SF_SMALL

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")
FILE = vocabularies.path("word_bpe_49k.json")

HARD = [
    "Hello WORLD it's 2020, a.b<|endoftext|>c d0 0", "", None, "don't 'tis rock'n'roll x'sy", "é, «q»—dash… İstanbul ΑΣ ΣΑΣ. ß ﬁ",
    "áb é. ≠ a≠b ,́x", "日本語 text 😀!!! 😀a  nbsp", "x|y|z <<|a|>> <|x <|startoftext|>z", "'s 're'll I'LL we'Ve 'M' ''s", "100% $5.00 #t @m a_b-c",
    "\x01 a\x7fb\x1f c\x1cd\x85e", "0 00 0a a0 0.0",
]


def test_words_give_the_tokens_of_whole_texts(small):
    whole, mine = tokenizers.Tokenizer.from_file(FILE), K.WordTokenizer(FILE)
    texts = HARD + [r["text"] for r in small.limit(60).collect()]
    for _ in range(2):  # the second time all units are known
        data, offsets = W.text_bytes(pa.array(texts, pa.string()))
        ids, at = mine(data, offsets)
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("turn", [1, -1])
def test_special_tokens_are_known_by_their_case(turn):
    """Whatever a worker has met before, in one text or in texts before it."""
    units = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "x<|endoftext|>Y", "X<|ENDOFTEXT|>y", "Word", "WORD", "word"]
    whole, mine = tokenizers.Tokenizer.from_file(FILE), K.WordTokenizer(FILE)
    assert whole.encode("<|ENDOFTEXT|> <|endoftext|>", add_special_tokens=False).ids == [27, 347, 40786, 4160, 91, 285, 49407]
    for text in [" ".join(units[::turn]), *units[::turn], " ".join(units)]:
        ids, _ = mine(*W.text_bytes(pa.array([text])))
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("capacity", [16, 256, 2048])
def test_classes_fill_sequences(capacity):
    """A full sequence of class k: k whole pieces of the class, and one beginning of a piece of it at most; hardly any padding."""
    rng = np.random.default_rng(capacity)
    lengths = [int(n) for n in np.exp(rng.uniform(0, np.log(3 * capacity), 4000))]
    filling, made, rows = K._Filling(3, capacity), [], pa.array(range(len(lengths)))
    for lo in range(0, len(lengths), 700):
        pieces = []
        for i, n in enumerate(lengths[lo : lo + 700]):
            ids = np.arange(n, dtype="<u4").tobytes()
            pieces += [K._Piece(i, s, n, ids[4 * s : 4 * (s + capacity)]) for s in range(0, n, capacity)]
        table = filling.add(rows.slice(lo, 700), pieces)
        made += table.to_pylist() if table is not None else []
    open_ = filling.left().to_pylist()
    got, sequences = defaultdict(list), defaultdict(list)
    for r in made + open_:
        got[r["row"]].append((r["start"], r["length"]))
        assert r["doc_tokens"] == lengths[r["row"]] and r["ids_crc32"] == zlib.crc32(np.arange(r["start"], r["start"] + r["length"], dtype="<u4").tobytes())
    for i, n in enumerate(lengths):
        place = 0
        for start, length in sorted(got[i]):
            assert start == place
            place += length
        assert place == n
    for r in made:
        sequences[r["sequence_id"]].append(r)
    for held in sequences.values():
        used, k = sum(r["length"] for r in held), held[0]["class"]
        assert capacity - capacity // K.SMALL <= used <= capacity and {r["class"] for r in held} == {k}
        assert sum(K.class_of(r["length"], capacity) == k for r in held) >= k
        assert len(held) <= k + 1
    # nearly every document that fits is in one or two pieces
    short = [len(got[i]) for i, n in enumerate(lengths) if n <= capacity]
    assert sum(short) < 1.8 * len(short)
    assert len(open_) < sum(K.class_of(r["length"], capacity) + 1 for r in {r["class"]: r for r in open_}.values()) + 1


def test_documents_stay_whole(small):
    """Fewer than two pieces a document, over all documents."""
    out = K.pack(small.coalesce(1))
    assert out.count() < 2 * small.count()


@pytest.mark.parametrize("parts", [1, 6])
def test_every_id_is_in_one_piece(small, odd, parts):
    whole = tokenizers.Tokenizer.from_file(FILE)
    for docs in (small, odd):
        docs = docs.repartition(parts)
        out = K.pack(docs, capacity=256, fold=2).select("row.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
        sequences = defaultdict(list)
        for r in out:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for pieces in sequences.values():
            place = 0
            for offset, length in sorted(pieces):
                assert offset == place
                place += length
            assert place <= 256
        want = defaultdict(list)
        for r in docs.select("doc_id", "text").collect():
            ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
            want[r["doc_id"]].append(ids)
        got = defaultdict(list)
        for r in out:
            got[r["doc_id"]].append(r)
        assert got.keys() == want.keys()
        for key, texts in want.items():
            assert sum(r["length"] for r in got[key]) == sum(map(len, texts))
            assert {r["doc_tokens"] for r in got[key]} == {len(t) for t in texts}
            for r in got[key]:
                part = slice(r["start"], r["start"] + r["length"])
                assert any(zlib.crc32(t[part].tobytes()) == r["ids_crc32"] for t in texts if len(t) == r["doc_tokens"])


def test_little_padding(small):
    out = K.pack(small.repartition(8)).groupBy("sequence_id").sum("length").collect()
    lengths = [r[1] for r in out]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths)
    assert padding < 0.03 * sum(lengths)


def test_empty_table(odd):
    assert K.pack(odd.where("false")).count() == 0


def test_contract_columns(spark):
    assert K.op4_harmonic_packing(spark, SF_SMALL).columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
