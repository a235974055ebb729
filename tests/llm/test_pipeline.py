"""The pipeline against the same stages in plain Python (the toxicity scores are the operator's)."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from snapfacet.llm import toxicity

from . import brute
from .conftest import SF_SMALL

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")


def kept_near(rows):
    label = brute.components([brute.fingerprint(r["text"]) for r in rows], 4)
    best = {}
    for r, x in zip(rows, label):
        if x not in best or r["doc_id"] < best[x]["doc_id"]:
            best[x] = r
    return list(best.values())


def test_run_is_the_stages_in_plain_python(spark):
    import numpy as np

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").where(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).where(F.col("score") < 0.3)
    rows = [{"doc_id": r[0], "text": r[1]} for r in scored.select("row.doc_id", "text").collect()]
    rows = kept_near(rows)
    cut = brute.removed([(r["doc_id"], r["text"]) for r in rows], 50)
    words = {r["doc_id"]: [w for w, g in zip(*c) if not g] for r, c in zip(rows, cut)}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [(i, " ".join(w)) for i, w in words.items()]
    clean = {i for (i, _), (n, hit, _) in zip(texts, brute.contamination(texts, items)) if not (hit and 20 * hit >= n)}
    tokenizer = tokenizers.Tokenizer.from_file(vocabularies.path("word_bpe_49k.json"))
    want = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts if i in clean}

    got, sequences = defaultdict(list), defaultdict(int)
    for r in C.run(spark, SF_SMALL).collect():
        got[r["doc_id"]].append(r)
        sequences[r["sequence_id"]] += r["length"]
    assert set(got) == set(want) and max(sequences.values()) <= 2048
    for i, ids in want.items():
        place = 0
        for r in sorted(got[i], key=lambda r: r["start"]):
            assert r["start"] == place and r["ids_crc32"] == zlib.crc32(ids[place : place + r["length"]].tobytes())
            place += r["length"]
        assert place == len(ids)


def test_stages_on_odd_rows(spark, odd):
    """Nulls, equal rows, clashing names: every stage keeps the columns and loses no clean row."""
    docs = odd.withColumn("n_chars", F.char_length("text"))
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.count() > 0
        assert stage(spark, docs.where("false"), SF_SMALL).count() == 0
    near = C.drop_near_copies(spark, docs, SF_SMALL).collect()
    # empty texts are one component, as are the equal rows; a null id stays only where it is alone
    assert sorted(str(r["doc_id"]) for r in near if not (r["text"] or "").strip()) == ["2"]
    assert sum(r["doc_id"] == 6 for r in near) == 1 and any(r["doc_id"] is None for r in near)
    assert C.pack_sequences(spark, docs, SF_SMALL).where("start = 0").count() == docs.count()


def test_unchanged_texts_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    changed = 0
    for r in C.cut_repeats(spark, docs, SF_SMALL).collect():
        if r["text"] == before[r["doc_id"]]["text"]:
            assert r == before[r["doc_id"]]
        else:
            changed += 1
            assert r["n_chars"] == len(r["text"])
    assert 0 < changed < len(before)


def test_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] and "pipeline" not in entry.oracle_sql()
    assert [n for n, _ in C.STAGES][0] == "toxicity" and len(C.STAGES) == 5
