import pyarrow as pa
import pytest

from snapfacet.llm import blocks as B
from snapfacet.llm import words as W
from snapfacet.llm.substring_dedup import lengths, op1_substring_dedup, substring_dedup
from snapfacet.llm.suffix_dedup import op8_suffix_array_dedup, suffix_dedup

from . import brute
from .conftest import SF_SMALL


def spans(gone):
    out, start = [], None
    for i, g in enumerate([*gone, False]):
        if g and start is None:
            start = i
        if not g and start is not None:
            out.append((start, i))
            start = None
    return out


def test_lengths_double():
    assert lengths(13, 6) == [7, 13]
    assert lengths(13, 2) == [2, 4, 7, 13]
    assert lengths(50, 6) == [7, 13, 25, 50]


@pytest.mark.parametrize("small_parts", [False, True])
@pytest.mark.parametrize("k", [3, 13])
def test_substring_dedup_is_brute_force(spark, small, odd, k, small_parts):
    parts = dict(chunk=20_000, per_bucket=5_000, first_words=2) if small_parts else {}
    for docs in (small, odd):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        want = sorted(
            (str(i), len(w), sum(g), spans(g), " ".join(x for x, y in zip(w, g) if not y)) for (i, _), (w, g) in zip(rows, brute.removed(rows, k))
        )
        out = substring_dedup(docs, min_words=k, **parts).select("row.doc_id", "n_words", "n_removed", "removed", "kept").collect()
        got = sorted((str(r[0]), r[1], r[2], [tuple(s) for s in r[3]], r[4]) for r in out)
        assert got == want


@pytest.mark.parametrize("k,prefix", [(4, 2), (8, 8), (50, 25)])
def test_suffix_dedup_is_brute_force(spark, small, odd, k, prefix):
    for docs in (small, odd):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        want = sorted(
            (str(i), len(w), sum(g), [x for x, y in zip(w, g) if not y]) for (i, _), (w, g) in zip(rows, brute.removed(rows, k))
        )
        out = suffix_dedup(docs, min_words=k, prefix_words=prefix, chunk=50_000, per_bucket=5_000)
        got = sorted((str(r[0]), r[1], r[2], brute.WORD.findall(r[3] or "")) for r in out.select("row.doc_id", "n_words", "n_removed", "text").collect())
        assert got == want


def test_texts_without_repeats_are_unchanged(spark, odd):
    out = suffix_dedup(odd, min_words=2000).select("row.kept", "text").collect()
    before = {r["kept"]: r["text"] for r in odd.collect()}
    assert {r["kept"]: r["text"] for r in out} == before


def test_blocks_keep_their_size():
    """Keys in a block, for inputs of up to 100 TB of text."""
    for total in (10**8, 10**9, 10**11, 10**13, 10**14):
        layout = B.Layout(total)
        assert layout.words / layout.chunks / layout.buckets > (100 if total <= 10**13 else 10)
        assert layout.words / layout.buckets <= B.LARGEST_BUCKET and total / layout.chunks <= B.LARGEST_CHUNK


def test_empty_tables(spark, odd):
    none = odd.where("false")
    assert substring_dedup(none).count() == 0
    assert suffix_dedup(none).count() == 0


def test_a_common_passage_sends_one_key_a_chunk(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"a{i} {passage} b{i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = {r[0]: r[1] for r in substring_dedup(docs, chunk=4_000).select("row.doc_id", "n_removed").collect()}
    assert out[0] == 0 and all(out[i] == 60 for i in range(1, 500))
    out = {r[0]: r[1] for r in suffix_dedup(docs, chunk=4_000).select("row.doc_id", "text").collect()}
    assert out[0] == rows[0][1] and all(out[i].split() == [f"a{i}", f"b{i}"] for i in range(1, 500))


def test_long_texts_are_cut_between_words(monkeypatch):
    import pyarrow as pa

    texts = ["ab  cd " * 100, None, "", "x" * 1000 + " y", " z"]
    data, offsets = W.text_bytes(pa.array(texts))
    whole = W.words(data, offsets)
    monkeypatch.setattr(W, "SLICE", 32)
    cut = W.words(data, offsets)
    assert all((a == b).all() for a, b in zip(whole, cut))
    assert [bytes(data[s:e]).decode() for s, e in zip(whole[1], whole[2])] == [w for t in texts for w in brute.WORD.findall(t or "")]


def test_contract_columns(spark):
    q = op1_substring_dedup(spark, SF_SMALL)
    assert q.columns[:4] == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert q.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert op8_suffix_array_dedup(spark, SF_SMALL).columns[0] == "doc_id"


def test_word_hashes_do_not_collide_by_construction():
    """Words in Thue-Morse order are equal under every polynomial modulo 2**64."""
    order = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    swapped = order.translate(str.maketrans("ab", "ba"))
    for text in (f"{order} {swapped}", f"{order[:200]} {swapped[:200]}", f"a{chr(0)} a", f"{'x' * 256} {'x' * 257}", f"{'x' * 8} {'x' * 9}"):
        data, offsets = W.text_bytes(pa.array([text]))
        h = W.words(data, offsets)[3]
        assert len(h) == 2 and h[0] != h[1]
        again = W.words(*W.text_bytes(pa.array(["z " + text])))[3]
        assert again[1:].tolist() == h.tolist()
